"""Evaluation texts leaking into training text.

Spaced seeds: fixed masks over token positions, most of which ignore some positions inside their
span, so a replaced or misspelt word leaves other seeds intact. Hashes of the test items' seeds
meet those of the documents; where two seeds of an item begin ``NEAREST`` to ``WINDOW`` words apart
in a document, shifted against the item by about as much, the two texts are compared word by word,
and a document leaks an item when a run of at least ``MIN_WORDS`` of the item's words, with at most
``MAX_ERRORS`` of them replaced, misspelt or left out, stands in it in order.

Runs of ``SHARED_RUN`` words that several items share (instruction sentences) are no evidence, and
seeds within them find nothing; items are told apart by their words, not by their layout. Ordinary
short phrases that many items have are still seeds: what they bring is verified, not dropped.

The test side is a benchmark: as long as its seeds number at most ``BROADCAST_SEEDS`` and its words
fill at most ``BROADCAST_BYTES``, both are sent to the tasks, which verify on the spot, and no
document is shuffled; a larger benchmark is joined by hash instead, with the same result.

Defined results: NULL and empty texts leak nothing; a document repeated under several ids is
reported under each; item texts repeated under several ids are all reported, and their common
words still count as evidence between them.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut

#: Positions that a seed looks at.
MASKS = ((0, 1, 2, 3), (0, 1, 3, 4), (0, 2, 3, 5), (0, 1, 4, 6))
MIN_WORDS = 15
MAX_ERRORS = 0.2
#: Right words that an error costs when the best end of a run is looked for.
ERROR_COST = 3
#: A run of so many words in more different items than this, and than this share of all items, is
#: part of an instruction.
SHARED_RUN = 6
SHARED_ITEMS, SHARED_SHARE = 2, 0.001
#: Seeds of test items (12 bytes each, 48 MB) and bytes of their words up to which they are broadcast.
BROADCAST_SEEDS = 4_000_000
BROADCAST_BYTES = 64_000_000
#: Words of a document between two seeds of an item, and difference of their places in the item from
#: those in the document up to which they belong together. With two of fifteen words replaced or
#: left out, however placed, seeds that lie so remain; equal six words bring none.
NEAREST, WINDOW = 3, 25
DRIFT = 8

_TOKEN = re.compile(r"[^\W_]+")
_PRIMES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)


def tokens(text: str) -> list[str]:
    return _TOKEN.findall(text.lower())


def _mixed(codes: np.ndarray, mask: tuple[int, ...], number: int) -> np.ndarray:
    """Hashes of the words under a mask at every place."""
    n = max(0, len(codes) - mask[-1])
    h = np.full(n, number + 1, np.uint64)
    for k, shift in enumerate(mask):
        h = (h ^ codes[shift : shift + n]) * _PRIMES[k % len(_PRIMES)]
        h ^= h >> np.uint64(29)
    return h


def seed_hashes(codes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per mask (positions, hashes) of a text given as codes of its words."""
    found = [_mixed(codes, mask, number) for number, mask in enumerate(MASKS)]
    return [(np.arange(len(h)), h) for h in found if len(h)]


def run_hashes(codes: np.ndarray) -> np.ndarray:
    """Hashes of the runs of SHARED_RUN words."""
    return _mixed(codes, tuple(range(SHARED_RUN)), len(MASKS)).view(np.int64)


class Coder:
    """Words to 64-bit codes, remembered for one task up to a bound."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def __call__(self, words: list[str]) -> np.ndarray:
        known, out = self.known, np.empty(len(words), np.uint64)
        for i, w in enumerate(words):
            code = known.get(w)
            if code is None:
                code = xxhash.xxh3_64_intdigest(w)
                if len(known) < 200_000:
                    known[w] = code
            out[i] = code
        return out


def batch_seeds(lists: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of the text, place in it, seed) of all seeds of texts given as words, each different word hashed once."""
    coded = pa.array([w for words in lists for w in words], pa.string()).dictionary_encode()
    codes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    codes = codes[coded.indices.to_numpy(zero_copy_only=False)] if len(codes) else codes
    lengths = np.array([len(words) for words in lists], np.int64)
    of = np.repeat(np.arange(len(lists)), lengths)
    at = np.arange(len(of)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    texts, places, seeds = [], [], []
    for number, mask in enumerate(MASKS):
        h = _mixed(codes, mask, number)
        inside = of[: len(h)] == of[mask[-1] : mask[-1] + len(h)]  # a seed lies in one text
        texts.append(of[: len(h)][inside])
        places.append(at[: len(h)][inside])
        seeds.append(h[inside])
    return np.concatenate(texts), np.concatenate(places), np.concatenate(seeds).view(np.int64)


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item_id, item): the words of an item joined by spaces."""
    for batch in batches:
        words = pa.array([" ".join(tokens(t)) for t in batch.column("text").to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays([batch.column("item_id"), words], names=["item_id", "item"])


def _item_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    coder = Coder()
    for batch in batches:
        ids, runs = [], []
        for i, item in zip(batch.column("item_id").to_pylist(), batch.column("item").to_pylist()):
            h = np.unique(run_hashes(coder(item.split(" "))))
            ids += [i] * len(h)
            runs += h.tolist()
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(runs, pa.int64())], names=["item_id", "run"])


def item_seeds(words: list[str], told: list[bool], coder: Coder) -> dict[int, int]:
    """Seeds that hold at least one word of evidence with their place, -1 where they recur."""
    codes, evidence, own = coder(words), np.array(told), {}
    for number, mask in enumerate(MASKS):
        h = _mixed(codes, mask, number).view(np.int64)
        some = np.zeros(len(h), bool)
        for shift in mask:
            some |= evidence[shift : shift + len(h)]
        for place in np.flatnonzero(some).tolist():
            seed = int(h[place])
            own[seed] = -1 if seed in own else place
    return own


def _item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    coder = Coder()
    for batch in batches:
        ids, seeds, places = [], [], []
        for i, item, common in zip(*(batch.column(c).to_pylist() for c in ("item_id", "item", "common"))):
            words = item.split(" ")
            own = item_seeds(words, evidence_of(words, set(common or ()), coder), coder)
            ids += [i] * len(own)
            seeds += list(own)
            places += list(own.values())
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (ids, seeds, places)], names=["item_id", "seed", "place"])


def _text_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, seed) of the documents' seeds, each once a document."""
    for batch in batches:
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        of, _, seeds = batch_seeds([tokens(t) for t in batch.column("text").to_pylist()])
        order = np.lexsort((seeds, of))
        of, seeds = of[order], seeds[order]
        new = np.ones(len(of), bool)
        new[1:] = (of[1:] != of[:-1]) | (seeds[1:] != seeds[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(ids[of[new]], pa.int64()), pa.array(seeds[new], pa.int64())], names=["id", "seed"])


class Items:
    """The sorted seeds of the test items, each with its place or -1 where it recurs in the item, and their words."""

    def __init__(self, seeds: np.ndarray, owners: np.ndarray, places: np.ndarray, ids: list[int], words: list[str], shared: list[list[int] | None]):
        order = np.argsort(seeds, kind="stable")
        number = {i: n for n, i in enumerate(ids)}
        self.seeds, self.places, self.owners = seeds[order], places[order], np.array([number[i] for i in owners[order].tolist()], np.int64)
        self.ids, self.words, self.shared = ids, words, shared
        self.read: dict[int, tuple[list[str], list[bool]]] = {}

    def item(self, n: int, coder: Coder) -> tuple[list[str], list[bool]]:
        if n not in self.read:
            own = self.words[n].split(" ")
            self.read[n] = own, evidence_of(own, set(self.shared[n] or ()), coder)
        return self.read[n]

    def met(self, lists: list[list[str]]) -> np.ndarray:
        """(number of the text, number of the item) of the places worth a comparison."""
        of, at, seeds = batch_seeds(lists)
        first = np.searchsorted(self.seeds, seeds, "left")
        found = (first < len(self.seeds)) & (self.seeds[np.minimum(first, len(self.seeds) - 1)] == seeds)
        of, at, seeds, first = of[found], at[found], seeds[found], first[found]
        number = np.searchsorted(self.seeds, seeds, "right") - first
        each = np.repeat(np.arange(len(of)), number)
        entry = first[each] + np.arange(len(each)) - np.repeat(np.cumsum(number) - number, number)
        at, place = at[each], self.places[entry]
        pair = of[each] * len(self.ids) + self.owners[entry]
        free = np.isin(pair, pair[place < 0])  # recurring seeds tell no shift
        shift = np.where(free, 0, at - place)
        kept = np.concatenate([pair[self._near(pair, (shift + move) // (2 * DRIFT), at)] for move in (0, DRIFT)])
        kept = np.unique(kept)
        return np.stack([kept // len(self.ids), kept % len(self.ids)], 1) if len(kept) else np.empty((0, 2), np.int64)

    @staticmethod
    def _near(pair: np.ndarray, band: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Indices of hits after which another of the pair and band begins NEAREST to WINDOW words later."""
        order = np.lexsort((at, band, pair))
        pair, band, at = pair[order], band[order], at[order]
        new = np.ones(len(pair), bool)
        new[1:] = (pair[1:] != pair[:-1]) | (band[1:] != band[:-1])
        key = np.cumsum(new) * (int(at.max(initial=0)) + 2 * WINDOW) + at
        after = np.searchsorted(key, key + NEAREST)
        return order[(after < len(key)) & (key[np.minimum(after, len(key) - 1)] <= key + WINDOW)]


def _on_the_spot(items: Items, least: int, errors: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder()
        for batch in batches:
            ids, lists = batch.column("doc_id").to_pylist(), [tokens(t) for t in batch.column("text").to_pylist()]
            docs, found = [], []
            for d, n in items.met(lists).tolist():
                words, evidence = items.item(n, coder)
                if leaked(words, lists[d], evidence, coder, least, errors):
                    docs.append(ids[d])
                    found.append(items.ids[n])
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(found, pa.int64())], names=["doc_id", "item_id"])

    return run


def align(item: list[str], doc: list[str], evidence: list[bool], i: int, j: int, least: int, most: float) -> tuple[bool, int, int]:
    """Extends the equal words item[i] = doc[j] both ways, word by word.

    Returns (whether a run of ``least`` words, as many of them evidence, has no more errors than ``most`` a word,
    words of the item covered by the best run, those of them before i). At a difference
    the next step is the one after which most of the following words agree: replace, leave out in
    the document, or inserted in the document. An extension stops where the errors of its last ten
    words reach four. Every end at a right word is tried for the run; the best one is where right
    words less weighted errors were most.
    """

    def walk(a: int, b: int, step: int) -> tuple[int, list[tuple[int, int, int]]]:
        covered = errors = told = 0
        best, top = 0, 0
        ends = {0: (0, 0)}  # errors -> the farthest end with so many (covered, evidence)
        recent: list[int] = []
        while 0 <= a < len(item) and 0 <= b < len(doc):
            if item[a] == doc[b]:
                covered, told = covered + 1, told + evidence[a]
                recent.append(0)
                a, b = a + step, b + step
                ends[errors] = covered, told
                if covered - ERROR_COST * errors >= top:
                    best, top = covered, covered - ERROR_COST * errors
            else:
                gains = []
                for da, db in ((1, 1), (1, 0), (0, 1), (2, 2), (2, 1), (1, 2), (2, 0), (0, 2)):
                    x, y, same = a + da * step, b + db * step, 0
                    for k in range(4):
                        u, v = x + k * step, y + k * step
                        if not (0 <= u < len(item) and 0 <= v < len(doc)):
                            break
                        if item[u] != doc[v]:
                            break
                        same += 1
                    gains.append((same - max(da, db), -max(da, db), da, db))
                gain = max(gains)
                da, db = (gain[2], gain[3]) if gain[0] > -1 else (1, 1)
                covered, errors = covered + da, errors + max(da, db)
                told += sum(evidence[a + k * step] for k in range(da) if 0 <= a + k * step < len(item))
                recent.extend([1] * max(da, db))
                a, b = a + da * step, b + db * step
            if sum(recent[-10:]) >= 4:
                break
        return best, [(c, e, t) for e, (c, t) in ends.items()]

    (before, backs), (after, aheads) = walk(i - 1, j - 1, -1), walk(i, j, 1)
    found = any(c + d >= least and t + u >= least and e + f <= most * (c + d) for c, e, t in backs for d, f, u in aheads)
    return found, before + after, before


def meeting_places(item: np.ndarray, doc: np.ndarray) -> Iterator[tuple[int, int]]:
    """(place in the item, place in the document) where equal seeds begin, those aside that only
    go on with the one before."""
    for (at_i, seeds_i), (_, seeds_d) in zip(seed_hashes(item), seed_hashes(doc)):
        places: dict[int, list[int]] = defaultdict(list)
        for p, h in zip(at_i.tolist(), seeds_i.tolist()):
            places[h].append(p)
        known = np.fromiter(places, np.uint64, len(places))
        before: set[int] = set()
        last = -2
        for j in np.flatnonzero(np.isin(seeds_d, known)).tolist():
            here = places[int(seeds_d[j])]
            follows = before if last == j - 1 else set()
            for i in here:
                if i - 1 not in follows:
                    yield i, j
            before, last = set(here), j


def leaked(item: list[str], doc: list[str], evidence: list[bool], coder: Coder, least: int, errors: float) -> bool:
    """Does any place where the texts meet grow into a long enough run?"""
    spans: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for i, j in meeting_places(coder(item), coder(doc)):
        if any(a <= j <= b for d in (j - i - 1, j - i, j - i + 1) for a, b in spans[d]):
            continue
        found, covered, back = align(item, doc, evidence, i, j, least, errors)
        if found:
            return True
        if covered >= 8:
            spans[j - i].append((j - back, j - back + covered))
    return False


def evidence_of(item: list[str], shared: set[int], coder: Coder) -> list[bool]:
    """False for the words that lie within a run shared by several items."""
    told = [True] * len(item)
    if shared:
        for p, h in enumerate(run_hashes(coder(item)).tolist()):
            if h in shared:
                told[p : p + SHARED_RUN] = [False] * SHARED_RUN
    return told


def _verify(least: int, errors: float):
    """The same on rows of (document, item) that share seeds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder()
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("id", "item_id", "text", "item", "common")]
            own = {i: (item, common) for _, i, _, item, common in zip(*columns)}
            tables = [(i, item_seeds(words := item.split(" "), evidence_of(words, set(common or ()), coder), coder)) for i, (item, common) in own.items()]
            seeds, places = (np.array([x for _, t in tables for x in side(t)], np.int64) for side in (list, dict.values))
            owners = np.array([i for i, t in tables for _ in t], np.int64)
            known = Items(seeds, owners, places, list(own), [v[0] for v in own.values()], [v[1] for v in own.values()])
            lists = [tokens(t) for t in columns[2]]
            rows = [(d, n) for d, n in known.met(lists).tolist() if known.ids[n] == columns[1][d]]
            hits = [(columns[0][d], columns[1][d]) for d, n in rows if leaked(known.item(n, coder)[0], lists[d], known.item(n, coder)[1], coder, least, errors)]
            yield pa.RecordBatch.from_arrays([pa.array([h[k] for h in hits], pa.int64()) for k in (0, 1)], names=["doc_id", "item_id"])

    return run


def leaks(
    documents: DataFrame,
    benchmark: DataFrame,
    least: int = MIN_WORDS,
    errors: float = MAX_ERRORS,
    shared_items: int = SHARED_ITEMS,
    broadcast_seeds: int = BROADCAST_SEEDS,
) -> DataFrame:
    """(doc_id, item_id) of every document that contains a passage of an item."""
    rows = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").where("item_id is not null and text is not null")
    items = cut(rows.mapInArrow(_item_words, "item_id bigint, item string").where("item <> ''").distinct())
    different = cut(items.groupBy("item").agg(F.min("item_id").alias("item_id")))
    several = max(float(shared_items), SHARED_SHARE * different.count())
    runs = different.mapInArrow(_item_runs, "item_id bigint, run bigint")
    often = runs.groupBy("run").agg(F.count("*").alias("n")).where(F.col("n") > several).select("run")
    common = runs.join(often, "run", "left_semi").groupBy("item_id").agg(F.collect_set("run").alias("common"))  # of one item's words
    told = cut(different.join(common, "item_id", "left"))
    seeds = cut(told.mapInArrow(_item_seeds, "item_id bigint, seed bigint, place bigint"))
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("doc_id is not null and text is not null")
    found_in = "doc_id bigint, item_id bigint"
    size = told.agg(F.coalesce(F.sum(F.length("item")), F.lit(0))).first()[0]
    few = seeds.limit(broadcast_seeds + 1).toArrow() if size <= BROADCAST_BYTES else None
    if few is not None and few.num_rows == 0:
        return items.where("false").select(F.col("item_id").alias("doc_id"), "item_id")
    if few is not None and few.num_rows <= broadcast_seeds:
        own = told.collect()  # no more words than BROADCAST_BYTES
        known = Items(*(few.column(c).to_numpy() for c in ("seed", "item_id", "place")), [r.item_id for r in own], [r.item for r in own], [r.common for r in own])
        found = texts.mapInArrow(_on_the_spot(known, least, errors), found_in).distinct()
    else:
        hit = texts.mapInArrow(_text_seeds, "id bigint, seed bigint")
        pairs = hit.join(seeds, "seed").groupBy("id", "item_id").agg(F.count("*").alias("n")).where("n >= 2").select("id", "item_id")
        whole = pairs.join(told, "item_id").join(texts.withColumnRenamed("doc_id", "id"), "id").select("id", "item_id", "text", "item", "common")
        found = whole.mapInArrow(_verify(least, errors), found_in).distinct()
    same = items.join(different.withColumnRenamed("item_id", "head"), "item").select("head", F.col("item_id").alias("every"))
    return found.join(same, F.col("item_id") == F.col("head")).select("doc_id", F.col("every").alias("item_id")).distinct()
