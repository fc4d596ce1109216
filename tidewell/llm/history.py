"""Deduplicating new batches against all history.

Accepted records leave two kinds of hashes: one of the whole normalised content (title and DOI)
and one for each piece of the title, a piece being three of its content words as picked by fixed
position patterns. Both are stored as tables bucketed by their hash, so a new batch meets history
bucket by bucket, without a shuffle of history: the content hash finds full copies, common pieces
and an alignment of the words find near copies. Then the batch's hashes are appended.

``publications`` writes the two tables once for all batches of a table and lets every pair of
batches meet in the bucket of a hash; ``HistoryIndex`` keeps the tables between batches.

The same publication: word by word equal titles after the wording that editors vary is levelled
(case, punctuation, function words, frames such as "a note on"), up to ``MOST_COST`` of
misspellings, and equal DOIs or one missing. Which words stand for one another, and which come and
go, is learned from the table: from titles under one DOI that differ in little else. Numbers,
parts, seasons, corrections, comments and replies must agree exactly.

Defined results: rows without a title are compared by DOI alone, rows without title and DOI repeat
nothing; NULL batches count as batch 0.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterable, Iterator
from difflib import SequenceMatcher
from itertools import combinations

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut, shared_dir
from .format_duplicates import canonical_doi, canonical_text
from .graph import least_labels

#: Words that carry no content, and those of the frames of titles.
FUNCTION_WORDS = frozenset("a an and amp at by during for from in near of on or the throughout to under upon with within &".split())
FRAME_WORDS = frozenset("abstract case communication note notes preliminary results short study update".split())
#: A wording is learned from at least so many DOIs, and this share of those with differing titles.
LEAST_DOIS, LEAST_SHARE = 3, 0.001
MARKERS = frozenset(
    "i ii iii iv v vi vii viii ix x part reply comment correction corrigendum erratum addendum retraction first second third fourth fifth "
    "winter summer spring autumn season year".split()
)
#: Positions of the words of a piece, by the number of content words. Two titles whose words differ
#: by at most two changes (replaced, inserted, left out) share a piece if the longer has five
#: words or more: with nine, three of the equal words stand in a row; with fewer, three of them
#: stand in one of these patterns in both titles.
PATTERNS = {
    5: ((0, 1, 2), (0, 1, 3), (0, 2, 3), (0, 1, 4), (0, 3, 4), (0, 2, 4)),
    6: ((0, 1, 2), (0, 1, 3), (0, 2, 3), (0, 1, 4)),
    7: ((0, 1, 2), (0, 1, 3)),
    8: ((0, 1, 2), (0, 1, 3)),
    9: ((0, 1, 2),),
}
MOST_COST = 2.6
#: A word of this share of all titles is wording rather than content and picks no pieces.
COMMON_SHARE = 0.04

_MARKUP = re.compile(r"</?[A-Za-z][^<>]*>|\\[a-zA-Z]+\*?(?=\{)|&(?:[a-z]+|#\d+);")
_WORD = re.compile(r"\w+|&")
_NUMBERED = re.compile(r"[:,(\-–]\s*part\s+\w+\W*$|\bpart\s+(?:[ivx]+|\d+)\b")


def features(title: str | None) -> tuple[list[str], list[str]]:
    """(content words in their order, markers) of a title; function words are left out."""
    text = _MARKUP.sub(" ", (title or "").lower())
    numbered = "part" in text and bool(_NUMBERED.search(text))
    words, marks = [], []
    for w in _WORD.findall(text):
        if w in MARKERS or w.isdigit():
            (words if w == "part" and not numbered else marks).append(w)
        elif w not in FUNCTION_WORDS:
            words.append(w)
    return words, sorted(marks)


def distance(a: str, b: str, most: int) -> int:
    """Edits between two words (insert, delete, replace, swap neighbours), or most + 1 if more."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, last = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            cost = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
            if before is not None and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cost = min(cost, before[j - 2] + 1)
            row.append(cost)
        if min(row) > most:
            return most + 1
        before, last = last, row
    return min(last[-1], most + 1)


def _deletions(word: str) -> list[str]:
    return [word, *(word[:i] + word[i + 1 :] for i in range(len(word)))]


def _by_deletions(words: Iterable[str]) -> dict[str, list[str]]:
    """Words by themselves less one letter; words one edit apart share such a form."""
    out: dict[str, list[str]] = {}
    for w in sorted(words):
        for d in _deletions(w):
            out.setdefault(d, []).append(w)
    return out


def _sharing(word: str, table: dict[str, list[str]]) -> list[str]:
    return sorted({w for d in _deletions(word) for w in table.get(d, ())}) if table else []


class Wording:
    """Words that stand for one another, words that come and go, and what differences cost."""

    def __init__(self, levelled: dict[str, str] | None = None, frames: frozenset[str] = frozenset(), pairs: frozenset[tuple[str, str]] = frozenset()):
        self.levelled, self.frames, self.pairs = levelled or {}, FRAME_WORDS | frames, pairs
        self.small, self.forms = _by_deletions(self.frames | FUNCTION_WORDS), _by_deletions(w for w in self.levelled if len(w) > 3)
        self.costs: dict[str, float] = {}
        self.changes: dict[tuple[str, str], float] = {}

    def level(self, words: list[str]) -> list[str]:
        return [self.levelled.get(w, w) for w in words]

    def light(self, word: str) -> float:
        """Cost of a word that the other title lacks: small for frames and misspelt function words."""
        cost = self.costs.get(word)
        if cost is None:
            cost = self._light(word)
            if len(self.costs) < 100_000:
                self.costs[word] = cost
        return cost

    def _light(self, word: str) -> float:
        if word in self.frames:
            return 0.25
        if len(word) <= 3:
            return 0.5
        if any(distance(word, f, 1) <= 1 for f in _sharing(word, self.small)):
            return 0.5
        return 9.0

    def replaced(self, x: str, y: str) -> float:
        """Cost of one word in the place of the other."""
        cost = self.changes.get((x, y))
        if cost is None:
            cost = self._replaced(x, y)
            if len(self.changes) < 500_000:
                self.changes[x, y] = cost
        return cost

    def _replaced(self, x: str, y: str) -> float:
        if (min(x, y), max(x, y)) in self.pairs:
            return 0.25
        d = distance(x, y, 2)
        if d == 1:
            return 1.0
        if d == 2 and min(len(x), len(y)) >= 7:
            return 1.5
        for w, v in ((x, y), (y, x)):
            for near in self.meant(w):
                if self.levelled[near] == v:
                    return 1.0
        return 9.0

    def meant(self, word: str) -> list[str]:
        """Words with a levelled form of which the word may be a misspelling."""
        return [near for near in _sharing(word, self.forms) if distance(word, near, 1) <= 1]


PLAIN = Wording()


def same_title(a: list[str], b: list[str], most: float = MOST_COST, wording: Wording = PLAIN) -> bool:
    """Can the words of a be aligned with those of b in their order at no more than ``most``?"""
    if a == b:
        return True
    light, replaced = wording.light, wording.replaced
    # Words that the other title has not settle most pairs before any alignment: each costs at
    # least 1 unless it may come and go.
    in_a, in_b = set(a), set(b)
    only_a, only_b = [w for w in a if w not in in_b], [w for w in b if w not in in_a]
    for mine, other in ((only_a, only_b), (only_b, only_a)):
        heavy = [w for w in mine if light(w) > most]
        if len(heavy) > most or any(not any(replaced(w, v) < 9.0 for v in other) for w in heavy):
            return False
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[start : len(a) - end], b[start : len(b) - end]
    last = [0.0]
    for y in b:
        last.append(last[-1] + light(y))
    for x in a:
        lx = light(x)
        row = [last[0] + lx]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + lx, row[j - 1] + light(y), last[j - 1] + (0.0 if x == y else replaced(x, y))))
        last = row
        if min(row) > most:
            return False
    return last[-1] <= most


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def pieces(words: list[str], marks: list[str], common: frozenset[str] = frozenset(), wording: Wording = PLAIN) -> list[int]:
    """Hashes of the pieces of a title.

    Words that may come and go at little cost (frames, short words) belong to no piece, so titles
    that align within MOST_COST differ by two content words at most. ``common`` words, those of a
    fixed share of all titles, are left out where five others remain; with three or four others
    the pieces of these are added, as a misspelt common word makes five of them.
    """
    core, tail = [w for w in words if wording.light(w) > MOST_COST], "|" + " ".join(marks)
    rare = [w for w in core if w not in common]
    out = _pieces(rare if len(rare) >= 5 else core, wording)
    if 3 <= len(rare) < 5:
        out |= {" ".join(x) for x in combinations(rare, 3)}
    return [_hash(x + tail) for x in out]


def _pieces(core: list[str], wording: Wording) -> set[str]:
    n = len(core)
    if n >= 5:
        return {" ".join(core[i + k] for k in p) for p in PATTERNS[min(n, 9)] for i in range(n - p[2])}
    # Of shorter titles all that two errors may leave: all words but two, one and none.
    out = {" ".join(x) for m in range(max(1, n - 2), n + 1) for x in combinations(core, m)}
    if n <= 2:
        # Both words may be misspelt, one of them by one edit: the words without one or two letters.
        for w in core:
            for v in {w} | {wording.levelled[near] for near in wording.meant(w)}:
                for m in range(3 if len(v) >= 7 and n == 1 else 2):
                    out |= {"~" + "".join(x) for x in combinations(v, len(v) - m)}
    return out or {""}


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        told = [features(t) for t in batch.column("title").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("doi", "seq", "rid")), pa.array([" ".join(w) if t else None for (w, _), t in zip(told, batch.column("title"))], pa.string()), pa.array([" ".join(m) for _, m in told], pa.string())],
            names=["doi", "seq", "rid", "words", "marks"],
        )


def titles_read(rows: DataFrame) -> DataFrame:
    """doi, seq, rid, words (content words joined by spaces, NULL without a title) and marks of each row."""
    return rows.select("title", "doi", "seq", "rid").mapInArrow(_read, "doi string, seq bigint, rid string, words string, marks string")


def _describe(common: frozenset[str], wording: Wording):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, parts, whole = [], [], []
            for title, marks, doi in zip(*(batch.column(c).to_pylist() for c in ("words", "marks", "doi"))):
                w, m = wording.level((title or "").split()), marks.split()
                words.append(" ".join(w))
                parts.append(pieces(w, m, common, wording) if title is not None else [])
                whole.append(_hash(" ".join(x for x in w if x not in wording.frames) + "|" + marks if title is not None else f"\x1f{doi}"))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doi", "seq", "rid")), pa.array(words, pa.string()), batch.column("marks"), pa.array(parts, pa.list_(pa.int64())), pa.array(whole, pa.int64())],
                names=["doi", "seq", "rid", "words", "marks", "parts", "whole"],
            )

    return run


_DESCRIBED = "doi string, seq bigint, rid string, words string, marks string, parts array<bigint>, whole bigint"


_PIECES = "part bigint, seq bigint, doi bigint"


def pieces_of(told: DataFrame) -> DataFrame:
    """The rows of the piece table; the DOI as its hash, NULL where there is none."""
    return told.select(F.explode("parts").alias("part"), "seq", _doi_hash(F.col("doi")))


def _doi_hash(doi: Column) -> Column:
    return F.when(doi.isNotNull(), F.xxhash64(doi)).alias("doi")


def describe(read: DataFrame, common: frozenset[str], wording: Wording) -> DataFrame:
    """Words, markers, piece hashes and the hash of the whole content of each title read."""
    return read.mapInArrow(_describe(common, wording), _DESCRIBED)


def common_words(read: DataFrame, share: float = COMMON_SHARE) -> frozenset[str]:
    """Words of at least ``share`` of all titles; at most (words a title / share) of them."""
    total = read.where("words is not null").count()
    words = read.select(F.explode(F.array_distinct(F.split("words", " "))).alias("w"))
    often = words.groupBy("w").count().where(F.col("count") >= max(20, share * total))
    return frozenset(r.w for r in often.collect())


def _differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, doi): words that stand for one another in two titles of a DOI, or b empty for a word
    that one of them lacks; titles of which less than half agrees tell nothing."""
    for batch in batches:
        out: set[tuple[str, str, str]] = set()
        for doi, x, y in zip(*(batch.column(c).to_pylist() for c in ("doi", "words", "head"))):
            x, y = x.split(), y.split()
            steps = SequenceMatcher(None, x, y, False).get_opcodes()
            same = sum(j - i for kind, i, j, _, _ in steps if kind == "equal")
            if 2 * same < max(len(x), len(y)):
                continue
            for kind, i, j, k, n in steps:
                if kind == "replace" and j - i == n - k == 1 and distance(x[i], y[k], 2) > 2:
                    out.add((min(x[i], y[k]), max(x[i], y[k]), doi))
                elif kind in ("insert", "delete") and j - i + n - k <= 3:
                    out |= {(w, "", doi) for w in x[i:j] + y[k:n]}
        rows = sorted(out)
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(3)], names=["a", "b", "doi"])


def learned_wording(read: DataFrame) -> Wording:
    """Wording that titles of one DOI vary in enough DOIs; each title is compared with its DOI's first.

    What is collected is bounded by the shares: at most (words a title / LEAST_SHARE) wordings.
    """
    known = read.where("doi is not null and words is not null")
    heads = known.groupBy("doi", "marks").agg(F.min_by("words", "seq").alias("head"), F.count("*").alias("n")).where("n > 1").drop("n")
    differ = known.join(heads, ["doi", "marks"]).where("words <> head").select("doi", "words", "head")
    seen = cut(differ.mapInArrow(_differences, "a string, b string, doi string").distinct())
    least = max(LEAST_DOIS, LEAST_SHARE * seen.select("doi").distinct().count())
    often = seen.groupBy("a", "b").agg(F.count("*").alias("n")).where(F.col("n") >= least).collect()
    frames = frozenset(r.a for r in often if not r.b)
    head: dict[str, str] = {}

    def top(w: str) -> str:
        while head.get(w, w) != w:
            w = head[w]
        return w

    # A word that also comes and goes is not levelled, as others would then do so too.
    alone = sorted((r.a, r.b) for r in often if r.b and r.a not in frames and r.b not in frames)
    for pair in alone:
        x, y = sorted(map(top, pair))
        head[y] = x
        head.setdefault(x, x)
    return Wording({w: top(w) for w in head if top(w) != w}, frames, frozenset((r.a, r.b) for r in often if r.b and (r.a in frames or r.b in frames)))


def _verify(wording: Wording):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("wa").to_pylist(), batch.column("wb").to_pylist()
            keep = pa.array([same_title(x.split(), y.split(), MOST_COST, wording) for x, y in zip(a, b)], pa.bool_())
            kept = [c for c in batch.schema.names if c not in ("wa", "wb")]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept], names=kept).filter(keep)

    return run


def normalised(records: DataFrame) -> DataFrame:
    """seq, batch, rid, title, doi and key (title in canonical form) of every row: title and DOI told
    apart, DOI canonical."""
    told = records.select(
        F.col("record_sequence").cast("bigint").alias("seq"), F.coalesce(F.col("batch_id").cast("int"), F.lit(0)).alias("batch"), F.col("record_id").alias("rid"),
        "title", "doi", canonical_doi(F.col("title")).alias("in_title"), canonical_doi(F.col("doi")).alias("in_doi"),
    )
    swapped = F.col("in_title").isNotNull() & F.col("in_doi").isNull()
    told = told.select("seq", "batch", "rid", F.when(swapped, F.col("doi")).otherwise(F.col("title")).alias("title"), F.when(swapped, F.col("in_title")).otherwise(F.col("in_doi")).alias("doi"))
    told = told.withColumn("key", canonical_text(F.col("title")))
    return told.withColumn("title", F.when(F.col("key").isNotNull(), F.col("title")))


def described(rows: DataFrame) -> DataFrame:
    """One node per content (canonical title and DOI): full copies are one."""
    exact = rows.where("title is not null or doi is not null").groupBy("key", "doi")
    return exact.agg(F.min("seq").alias("seq"), F.min("title").alias("title"), F.min("rid").alias("rid")).drop("key")


class Bucketed:
    """A table of the shared folder, bucketed by ``key``; joins by the key need no exchange.

    The catalog of a session only holds its description, which is declared anew over the files of
    an earlier session.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, schema: str, buckets: int):
        self.spark, self.path, self.key, self.schema, self.buckets = spark, path, key, schema, buckets
        self.name = "tidewell_" + hashlib.md5(path.encode()).hexdigest()

    def _folder(self):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def exists(self) -> bool:
        files, where = self._folder()
        return files.exists(where)

    def _declare(self) -> None:
        if not self.spark.catalog.tableExists(self.name):
            self.spark.sql(f"CREATE TABLE {self.name} ({self.schema}) USING parquet CLUSTERED BY ({self.key}) SORTED BY ({self.key}) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")

    def read(self) -> DataFrame:
        self._declare()
        return self.spark.table(self.name)

    def append(self, df: DataFrame) -> None:
        """One file a bucket: the shuffle before the write hashes as the buckets do."""
        self._declare()
        columns = [c.split()[0] for c in self.schema.split(", ")]
        out = df.select(*columns).repartition(self.buckets, self.key).write.mode("append").format("parquet")
        out.bucketBy(self.buckets, self.key).sortBy(self.key).saveAsTable(self.name)
        self.spark.catalog.refreshTable(self.name)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        files, where = self._folder()
        files.delete(where, True)


def near_pairs(left: DataFrame, right: DataFrame, same_doi: bool = False) -> DataFrame:
    """Pairs (a < b by sequence) of rows of the piece table that share a piece, bucket by bucket."""
    met = right.join(left.select("part"), "part", "left_semi")
    pairs = left.select("part", F.col("seq").alias("x"), F.col("doi").alias("dx")).join(met.select("part", F.col("seq").alias("y"), F.col("doi").alias("dy")), "part").where("x <> y")
    if same_doi:
        pairs = pairs.where("dx ^ dy = 0")  # not a second key of the join, which would shuffle the buckets
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def buckets_for(rows: int) -> int:
    """A power of two by which a bucket has some 50,000 titles, at least 8."""
    return max(8, 1 << (rows // 50_000).bit_length())


def publications(rows: DataFrame) -> DataFrame:
    """(seq, batch, publication): publication is the least sequence of all rows of the publication."""
    keyed = rows.withColumn("k", F.xxhash64(F.concat(F.coalesce("key", F.lit("")), F.lit("\x1f"), F.coalesce("doi", F.lit(""))))).drop("key")
    exact = cut(keyed).where("title is not null or doi is not null")  # pushed below the patterns, it would run them twice
    copies = exact.groupBy("k", "doi").agg(F.min("seq").alias("seq"), F.min("title").alias("title"), F.min("rid").alias("rid"))
    read = cut(titles_read(copies))
    wording = learned_wording(read)
    spark, root, buckets = rows.sparkSession, f"{shared_dir(rows.sparkSession).rstrip('/')}/history-{uuid.uuid4().hex}", buckets_for(read.count())
    content, hashes = Bucketed(spark, root + "/content", "whole", _DESCRIBED, buckets), Bucketed(spark, root + "/pieces", "part", _PIECES, buckets)
    content.append(describe(read, common_words(read), wording))
    # Full copies by content hash, bucket by bucket: within a DOI, and among rows without one.
    nodes = cut(content.read().withColumn("node", F.min("seq").over(_by("whole", F.coalesce("doi", F.lit(""))))))
    content.drop()
    heads = nodes.where("seq = node").select("seq", "doi", "rid", "words", "marks", "parts")
    hashes.append(pieces_of(heads))
    known, unknown = hashes.read().where("doi is not null"), hashes.read().where("doi is null")
    # Rows of one DOI meet in their pieces and at its first row, rows of one record at its first row,
    # whatever pieces they share; rows without a DOI meet one another and all others in their pieces.
    named = heads.where("words <> ''").select("seq", "doi", "marks", "rid")
    pairs = near_pairs(unknown, unknown).union(near_pairs(unknown, known)).union(near_pairs(known, known, same_doi=True))
    pairs = pairs.union(_with_first(named.where("doi is not null"), "doi", "marks")).union(_with_first(named.where("rid is not null"), "rid", F.coalesce("doi", F.lit("")), "marks"))
    words = heads.select("seq", "words", _doi_hash(F.col("doi")))
    both = pairs.distinct().join(words.select(F.col("seq").alias("a"), F.col("words").alias("wa"), F.col("doi").alias("da")), "a")
    both = both.join(words.select(F.col("seq").alias("b"), F.col("words").alias("wb"), F.col("doi").alias("db")), "b")
    aligned = cut(both.select("a", "b", "da", "db", "wa", "wb").mapInArrow(_verify(wording), "a bigint, b bigint, da bigint, db bigint"))
    hashes.drop()
    labels = least_labels(aligned.where("da <=> db").select("a", "b"))
    placed = heads.select("seq", "doi").join(labels.withColumnRenamed("node", "seq"), "seq", "left")
    placed = cut(placed.select("seq", F.col("doi").isNull().alias("bare"), F.coalesce("label", "seq").alias("label")))
    # A group without DOI belongs to the earliest publication with a DOI whose title it repeats.
    mixed = aligned.where("not (da <=> db)").select(F.when(F.col("da").isNull(), F.col("a")).otherwise(F.col("b")).alias("x"), F.when(F.col("da").isNull(), F.col("b")).otherwise(F.col("a")).alias("y"))
    joined = mixed.join(placed.select(F.col("seq").alias("x"), "label"), "x").join(placed.select(F.col("seq").alias("y"), F.col("label").alias("to")), "y")
    moved = joined.groupBy("label").agg(F.min("to").alias("to"))
    final = placed.join(moved, "label", "left").select("seq", F.coalesce("to", "label").alias("label"))
    heads_of = nodes.select(F.col("seq").alias("head"), "node").join(final.select(F.col("seq").alias("node"), "label"), "node")
    member = exact.select("seq", "batch", "k").join(exact.groupBy("k", "doi").agg(F.min("seq").alias("head")).select("k", "head"), "k").join(heads_of.select("head", "label"), "head")
    member = cut(member.select("seq", "batch", "label"))
    least = member.groupBy("label").agg(F.min("seq").alias("publication"), F.min("batch").alias("first_batch"))
    return member.join(least, "label").select("seq", "batch", "publication", "first_batch")


def _with_first(rows: DataFrame, *keys: str | Column) -> DataFrame:
    """Pairs (a, b) of each row with the first row of its group."""
    keyed = rows.select(F.xxhash64(*keys).alias("g"), "seq")
    first = keyed.groupBy("g").agg(F.min("seq").alias("a"), F.count("*").alias("n")).where("n > 1").select("g", "a")
    return keyed.join(first, "g").where("seq <> a").select("a", F.col("seq").alias("b"))


def _by(*keys: str | Column):
    from pyspark.sql import Window

    return Window.partitionBy(*keys)


def repeated_rows(screening: DataFrame) -> DataFrame:
    """Rows of which an earlier batch holds the same publication."""
    found = publications(normalised(screening)).where("batch > first_batch")
    return found.select(F.col("publication").cast("int").alias("accepted_sequence"), F.col("seq").cast("int").alias("new_sequence"))


class HistoryIndex:
    """The hash tables of all accepted records, bucketed on disk.

    ``root`` is a folder in the shared directory; ``buckets`` stays the same for the life of the
    index. ``check`` reads history in its buckets and never the history's records.
    """

    def __init__(self, spark: SparkSession, root: str | None = None, buckets: int = 64):
        self.spark, self.root = spark, (root or shared_dir(spark) + "/history").rstrip("/")
        node = "whole bigint, seq bigint, doi string, words string, publication bigint"
        self.content = Bucketed(spark, self.root + "/content", "whole", node, buckets)
        self.nodes = Bucketed(spark, self.root + "/nodes", "seq", node, buckets)
        self.hashes = Bucketed(spark, self.root + "/pieces", "part", _PIECES, buckets)

    def wording(self, read: DataFrame) -> tuple[frozenset[str], Wording]:
        """Common words and wording, learned from the first batch for the life of the index."""
        path = f"{self.root}/wording"
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        if not where.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(where):
            told = learned_wording(read)
            rows = [("common", w, "") for w in sorted(common_words(read))] + [("frame", w, "") for w in sorted(told.frames)] + [("level", w, to) for w, to in sorted(told.levelled.items())] + [("pair", *p) for p in sorted(told.pairs)]
            self.spark.createDataFrame(rows, "kind string, word string, to string").coalesce(1).write.parquet(path)
        rows = self.spark.read.parquet(path).collect()
        of = lambda kind: {r.word: r.to for r in rows if r.kind == kind}
        return frozenset(of("common")), Wording(of("level"), frozenset(of("frame")), frozenset((r.word, r.to) for r in rows if r.kind == "pair"))

    def _found(self, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(described rows, (seq, accepted) of those that repeat an accepted publication); a row
        stands for its exact copies in the batch."""
        read = cut(titles_read(described(normalised(batch))))
        common, wording = self.wording(read)
        new = cut(describe(read, common, wording))
        if not self.content.exists():
            return new, new.where("false").select("seq", F.col("seq").alias("accepted"))
        same_doi = "doi = old_doi or doi is null or old_doi is null"
        # Full copies: the new content hashes against those of history.
        old = self.content.read().select("whole", F.col("doi").alias("old_doi"), F.col("publication").alias("accepted"))
        copies = new.select("seq", "doi", "whole").join(old, "whole").where(same_doi).select("seq", "accepted")
        # Near copies: history's pieces that the batch has too, then an alignment.
        mine = new.select("seq", _doi_hash(F.col("doi")), "words", F.explode("parts").alias("part"))
        met = self.hashes.read().join(mine.select("part"), "part", "left_semi").select("part", F.col("seq").alias("old"), F.col("doi").alias("old_doi"))
        pairs = mine.join(met, "part").where(same_doi).select("seq", "old", F.col("words").alias("wa")).distinct()
        told = self.nodes.read().select(F.col("seq").alias("old"), F.col("words").alias("wb"), F.col("publication").alias("accepted"))
        near = pairs.join(told, "old").select("seq", "accepted", "wa", "wb").mapInArrow(_verify(wording), "seq bigint, accepted bigint")
        return new, copies.union(near).groupBy("seq").agg(F.min("accepted").alias("accepted"))

    def check(self, batch: DataFrame) -> DataFrame:
        """(new_sequence, accepted_sequence) of all rows that repeat an accepted publication."""
        _, found = self._found(batch)
        rows = normalised(batch).where("title is not null or doi is not null").select(F.col("key").alias("k"), "doi", "seq")
        heads = rows.groupBy("k", "doi").agg(F.min("seq").alias("head"))
        same = F.col("r.k").eqNullSafe(F.col("h.k")) & F.col("r.doi").eqNullSafe(F.col("h.doi"))
        member = rows.alias("r").join(heads.alias("h"), same).select("r.seq", "h.head")
        return member.join(found.withColumnRenamed("seq", "head"), "head").select(F.col("seq").alias("new_sequence"), F.col("accepted").alias("accepted_sequence"))

    def append(self, batch: DataFrame) -> None:
        """Adds the batch's hashes under the publications they repeat; call it after ``check``."""
        new, found = self._found(batch)
        new = cut(new.join(found, "seq", "left").withColumn("publication", F.coalesce("accepted", "seq")))
        self.content.append(new)
        self.nodes.append(new)
        self.hashes.append(pieces_of(new))
