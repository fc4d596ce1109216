"""Record linkage: pairs within a corpus, new records against a master, and what follows from them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as t
from ..session import cut, written

#: Least title similarity of a fuzzy match, of a probable one, and of an equal DOI.
FUZZY, PROBABLE, SAME_DOI = 0.965, 0.985, 0.90


def jaro_winkler(a: str, b: str) -> float:
    """Jaro-Winkler similarity, prefix scale 0.1 over at most four characters; empty texts give 0."""
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    la, lb = len(a), len(b)
    reach = max(la, lb) // 2 - 1
    used = bytearray(lb)
    hits: list[str] = []
    for i, c in enumerate(a):
        start, stop = max(0, i - reach), min(lb, i + reach + 1)
        j = b.find(c, start, stop)
        while j >= 0 and used[j]:
            j = b.find(c, j + 1, stop)
        if j >= 0:
            used[j] = 1
            hits.append(c)
    m = len(hits)
    if not m:
        return 0.0
    swapped = sum(x != b[j] for x, j in zip(hits, (j for j in range(lb) if used[j]))) // 2
    jaro = (m / la + m / lb + (m - swapped) / m) / 3
    prefix = 0
    while prefix < min(4, la, lb) and a[prefix] == b[prefix]:
        prefix += 1
    return jaro + prefix * 0.1 * (1 - jaro)


def _letters(texts: list[str]) -> np.ndarray:
    """Counts of the characters of each text in 64 buckets; two that share one only overlap more."""
    out = np.zeros((len(texts), 64), np.int16)
    for i, text in enumerate(texts):
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32) & 63
        out[i] = np.bincount(codes, minlength=64)
    return out


def _similar(least: float):
    """Similarities of a batch. Pairs whose letters cannot reach ``least`` are dropped first: with m
    letters in common, Jaro is at most (m / la + m / lb + 1) / 3, and at least (least - 0.4) / 0.6 of
    it is needed under the longest common prefix."""
    jaro = (least - 0.4) / 0.6

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if jaro > 0:
                columns = [batch.column(c).dictionary_encode() for c in ("a", "b")]
                counts = [_letters(c.dictionary.to_pylist()) for c in columns]
                i, j = (c.indices.to_numpy() for c in columns)
                size = [c.sum(1).astype(np.float64) for c in counts]
                common = np.minimum(counts[0][i], counts[1][j]).sum(1)
                reach = (common / np.maximum(size[0][i], 1) + common / np.maximum(size[1][j], 1) + 1) / 3
                batch = batch.filter(pa.array(reach >= jaro - 1e-9))
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            values = pa.array([jaro_winkler(x, y) for x, y in zip(a, b)], pa.float64())
            kept = [(n, batch.column(n)) for n in batch.schema.names if n not in ("a", "b")]
            out = pa.RecordBatch.from_arrays([*(c for _, c in kept), values], names=[*(n for n, _ in kept), "similarity"])
            yield out.filter(pa.compute.greater_equal(values, least))

    return run


def with_similarity(pairs: DataFrame, least: float) -> DataFrame:
    """Pairs whose title keys a and b have similarity >= least, with it in the place of the keys.

    Nothing is shuffled: pairs go from the join straight into Arrow batches. Lengths rule a pair
    out before: with a common prefix of at most four the Jaro similarity J must reach
    (least - 0.4) / 0.6, so the shorter title has at least 3 J - 2 of the longer one's length. Both
    this bound and the one on letters are exact.
    """
    share = max(0.0, 3 * (least - 0.4) / 0.6 - 2)
    long, short = F.greatest(F.length("a"), F.length("b")), F.least(F.length("a"), F.length("b"))
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in pairs.schema.fields if f.name not in ("a", "b")]
    return pairs.where(short >= share * long).mapInArrow(_similar(least), ", ".join([*kept, "similarity double"]))


#: Bits of the two words of a signature: per letter the counts from and below which "more than this many"
#: has a bit, in the first word those that tell most titles of some 80 characters apart, in the second
#: the others of ``WHOLE``. Any choice is exact, a bad one lets more pass.
FIRST = {
    "a": (3, 7), "b": (0, 1), "c": (1, 3), "d": (2, 4), "e": (5, 9), "f": (1, 4), "g": (0, 3), "h": (0, 3), "i": (3, 6), "k": (0, 1), "l": (2, 5), "m": (1, 3),
    "n": (3, 7), "o": (3, 7), "p": (0, 3), "r": (3, 7), "s": (2, 6), "t": (3, 6), "u": (1, 4), "v": (0, 2), "w": (0, 1), "y": (0, 2), " ": (9, 12),
}
WHOLE = {
    "a": (2, 9), "b": (0, 3), "c": (0, 5), "d": (1, 5), "e": (3, 12), "f": (0, 6), "g": (0, 4), "h": (0, 4), "i": (1, 9), "j": (0, 1), "k": (0, 2), "l": (1, 7), "m": (0, 5),
    "n": (2, 10), "o": (2, 9), "p": (0, 4), "r": (2, 10), "s": (1, 9), "t": (1, 8), "u": (0, 5), "v": (0, 3), "w": (0, 2), "x": (0, 1), "y": (0, 3), "z": (0, 1), " ": (7, 14),
}
_BITS = [{(c, n) for c, (low, high) in counts.items() for n in range(low, high)} for counts in (FIRST, WHOLE)]
WORDS = sorted(_BITS[0]), sorted(_BITS[1] - _BITS[0])
#: Titles of one tile on either side.
TILE = 32_768


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with signatures s1 and s2 of the title key: the count of each letter in unary, so that two
    titles differ in at least as many letters as their words in bits."""
    for batch in batches:
        texts = [x.encode() for x in batch.column("title_key").to_pylist()]
        codes = np.frombuffer(b"".join(texts), np.uint8) & 127
        rows = np.repeat(np.arange(len(texts)), [len(x) for x in texts])
        counts = np.bincount(rows * 128 + codes, minlength=len(texts) * 128).reshape(-1, 128)
        words = []
        for told in WORDS:
            word = np.zeros(len(texts), np.uint64)
            for bit, (letter, n) in enumerate(told):
                word |= (counts[:, ord(letter)] > n).astype(np.uint64) << np.uint64(bit)
            words.append(pa.array(word.view(np.int64)))
        yield pa.RecordBatch.from_arrays([*batch.columns, *words], names=[*batch.schema.names, "s1", "s2"])


def with_signatures(keyed: DataFrame) -> DataFrame:
    """Keyed records with the signatures s1 and s2 of their title keys."""
    have = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keyed.schema.fields)
    return keyed.mapInArrow(_signatures, f"{have}, s1 bigint, s2 bigint")


def _differing(la, lb, least: float):
    """Most letters in which titles of la and lb characters may differ: (m / la + m / lb + 1) / 3 must
    reach (least - 0.4) / 0.6 for the m letters in common, and la + lb - 2 m are not. Numbers or columns."""
    return la + lb - 2 * ((least - 0.4) / 0.2 - 1) * la * lb / (la + lb) + 1e-6


def near(l: str, r: str, least: float) -> Column:  # noqa: E741
    """Whether the signatures of two sides of a join leave open that their titles reach ``least``."""
    bits = sum(F.bit_count(F.col(f"{l}.{s}").bitwiseXOR(F.col(f"{r}.{s}"))) for s in ("s1", "s2"))
    return bits <= _differing(F.length(f"{l}.title_key"), F.length(f"{r}.title_key"), least)


def _near_pairs(a: pa.Table, b: pa.Table, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of the pairs of titles that the signatures leave open, by length, a few rows at a time."""
    share = max(0.0, 3 * (least - 0.4) / 0.6 - 2)
    sides = []
    for side in (a, b):
        size = pa.compute.utf8_length(side.column("title_key")).to_numpy()
        order = np.argsort(size, kind="stable")
        sides.append((order, size[order], *(side.column(s).to_numpy().view(np.uint64)[order] for s in ("s1", "s2"))))
    (ia, la, *wa), (ib, lb, *wb) = sides
    for size in np.unique(la):
        first, last = np.searchsorted(la, [size, size + 1])
        low, high = np.searchsorted(lb, [np.floor(size * share - 1e-9), np.ceil(size / share + 1e-9) + 1 if share else lb.max() + 1])
        if low == high:
            continue
        most = np.clip(_differing(float(size), lb[low:high].astype(float), least), 0, 200).astype(np.uint8)
        step = max(1, 32_768 // (high - low))  # stays in the cache
        for at in range(first, last, step):
            bits = np.bitwise_count(wa[0][at : min(at + step, last), None] ^ wb[0][low:high])
            i, j = np.divmod(np.flatnonzero(bits <= most), high - low)
            kept = bits[i, j] + np.bitwise_count(wa[1][at + i] ^ wb[1][low + j]) <= most[j]
            if kept.any():
                yield ia[at + i[kept]], ib[low + j[kept]]


def _tile(least: float, *keys: str):
    """Similar titles of one tile: the pairs its signatures leave open, in batches as ``_similar`` takes them."""

    def run(key: tuple, a: pa.Table, b: pa.Table) -> pa.Table:
        titles = [x.column("title_key").combine_chunks() for x in (a, b)]

        def batch(pairs: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
            x, y = (t.take(pa.array(np.concatenate(at))) for t, at in zip(titles, zip(*pairs)))
            return pa.RecordBatch.from_arrays([*(pa.array([k.as_py()] * len(x), k.type) for k in key[: len(keys)]), x, y, x, y], names=[*keys, "x", "y", "a", "b"])

        def batches() -> Iterator[pa.RecordBatch]:
            open_, size = [], 0
            for pair in _near_pairs(a, b, least) if len(a) and len(b) else ():
                open_.append(pair)
                size += len(pair[0])
                if size >= 10_000:
                    yield batch(open_)
                    open_, size = [], 0
            if open_:
                yield batch(open_)

        named = [(n, k.type) for n, k in zip(keys, key)]
        return pa.Table.from_batches(_similar(least)(batches()), pa.schema([*named, ("x", pa.string()), ("y", pa.string()), ("similarity", pa.float64())]))

    return run


def similar_in_tiles(new: DataFrame, master: DataFrame, least: float, *keys: str) -> DataFrame:
    """keys, x, y and similarity: the different titles that agree in keys, x new and y of the master, that reach ``least``.

    All pairs of a key are looked at, but as two words of bits each: a key is cut into tiles of at
    most about ``TILE`` titles a side, so no key is one task, and only what the words leave open is compared.
    """
    cols = (*keys, "title_key", "s1", "s2")
    a, b = (x.where(" and ".join([*(f"{k} is not null" for k in keys), "title_key != ''"])).select(*cols).distinct() for x in (new, master))
    count = lambda df, name: df.groupBy(*keys).agg(F.ceil(F.count("*") / TILE).cast("int").alias(name))
    tiles = F.broadcast(count(a, "rows").join(count(b, "columns"), [*keys]))  # one row a key

    def placed(df: DataFrame, own: str, other: str) -> DataFrame:
        at, every = F.pmod(F.xxhash64("title_key"), F.col(own)).cast("int"), F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        named = [F.col(c).alias(c) for c in cols]  # columns of its own, as both sides may come from one table
        return df.join(tiles, [*keys]).select(*named, at.alias(f"{own}_at"), every.alias(f"{other}_at")).groupBy(*keys, "rows_at", "columns_at")

    schema = ", ".join([*(f"{k} {new.schema[k].dataType.simpleString()}" for k in keys), "x string, y string, similarity double"])
    return placed(a, "rows", "columns").cogroup(placed(b, "columns", "rows")).applyInArrow(_tile(least, *keys), schema)


def similar_in_year(new: DataFrame, master: DataFrame, least: float) -> DataFrame:
    """``similar_in_tiles`` of the titles of one year."""
    return similar_in_tiles(new, master, least, "year")


#: The seven passes: name, status and the fields that have to agree.
PASSES = (
    ("A_author_year_title_journal", "duplicate", ("authors", "year", "title", "journal")),
    ("B_author_year_title_pages", "duplicate", ("authors", "year", "title", "pages")),
    ("C_title_volume_pages", "review", ("title", "volume", "pages")),
    ("D_author_volume_pages", "review", ("authors", "volume", "pages")),
    ("E_year_volume_issue_pages", "review", ("year", "volume", "issue", "pages")),
    ("F_title", "review", ("title",)),
    ("G_author_year", "review", ("authors", "year")),
)


def dedup_fields(records: DataFrame, index: str) -> DataFrame:
    """row_index and the normalised fields that the passes compare; columns that are absent are NULL."""
    have = set(records.columns)

    def col(name: str) -> Column:
        return F.col(name).cast("string") if name in have else F.lit(None).cast("string")

    return records.select(
        F.col(index).cast("bigint").alias("row_index"),
        *[t.bibliographic_text(col(c)).alias(c) for c in ("title", "authors", "journal")],
        *[F.coalesce(F.trim(col(c)), F.lit("")).alias(c) for c in ("year", "volume", "issue")],
        t.page_key(col("pages")).alias("pages"),
    )


def duplicate_candidates(records: DataFrame, index: str = "record_sequence", existing: Column | None = None) -> DataFrame:
    """(record_i, record_j, method, status): every record with the first one of each class it is in.

    A class is what agrees in a pass; its first record is an existing one if there is any, else the
    earliest. The class and its first record give all of its pairs, so they are not written out: a
    key shared by many records costs one row each. Of several passes the first names the pair.
    """
    old = F.lit(False) if existing is None else existing
    fields = dedup_fields(records, index).join(records.select(F.col(index).cast("bigint").alias("row_index"), old.alias("old")), "row_index")
    keys = F.array(
        *[
            F.struct(F.lit(n).alias("pass"), t.dedup_key(*[F.col(f) for f in names]).alias("key"))
            for n, (_, _, names) in enumerate(PASSES)
        ]
    )
    keyed = fields.select("row_index", "old", F.explode(keys).alias("k")).select("row_index", "old", "k.pass", "k.key").where("key is not null")
    classes = keyed.groupBy("pass", "key").agg(F.min(F.struct((~F.col("old")).alias("new"), "row_index")).alias("first"), F.count("*").alias("n")).where("n > 1")
    star = keyed.join(classes, ["pass", "key"]).where(F.col("row_index") != F.col("first.row_index"))
    pairs = star.groupBy(F.col("first.row_index").alias("record_i"), F.col("row_index").alias("record_j")).agg(F.min("pass").alias("pass"))
    names, states = F.array(*[F.lit(p[0]) for p in PASSES]), F.array(*[F.lit(p[1]) for p in PASSES])
    return pairs.select("record_i", "record_j", F.get(names, F.col("pass")).alias("method"), F.get(states, F.col("pass")).alias("status"))


def canonical_pairs(records: DataFrame, existing: Column, index: str = "record_sequence", name: str = "record_id") -> DataFrame:
    """Candidates with the ids of their canonical and duplicate record; cross_corpus: one is existing, one new."""
    side = records.select(F.col(index).cast("bigint").alias("ix"), F.col(name).alias("name"), existing.alias("old"))
    pairs = duplicate_candidates(records, index, existing)
    i = side.select(F.col("ix").alias("record_i"), F.col("name").alias("canonical_id"), F.col("old").alias("oi"))
    j = side.select(F.col("ix").alias("record_j"), F.col("name").alias("duplicate_id"), F.col("old").alias("oj"))
    both = pairs.join(i, "record_i").join(j, "record_j")
    return both.select("record_i", "record_j", "method", "status", (F.col("oi") != F.col("oj")).alias("cross_corpus"), "canonical_id", "duplicate_id")


def deduplicated(records: DataFrame, existing: Column, index: str = "record_sequence", name: str = "record_id") -> dict[str, DataFrame]:
    """records, candidates, automatic_duplicates and review_candidates; no row is dropped."""
    pairs = canonical_pairs(records, existing, index, name)
    return {"records": records, "candidates": pairs, "automatic_duplicates": pairs.where("status = 'duplicate'"), "review_candidates": pairs.where("status = 'review'")}


def with_keys(records: DataFrame, row: str) -> DataFrame:
    """row, id, year and the keys by which records are compared."""
    key = t.screening_title(F.col("title"))
    return records.select(
        F.col(row).cast("bigint").alias("row"), F.col("record_id").alias("id"), F.col("year").cast("int").alias("year"), key.alias("title_key"),
        t.screening_doi(F.col("doi")).alias("doi_key"), t.first_author_key(F.col("authors")).alias("author_key"), F.substring(key, 1, 24).alias("prefix"), t.token_key(key).alias("tokens"),
    )


#: Fuzzy blocks in their order: the first in which a pair meets names its basis.
BLOCKS = (("same year", "year"), ("same first author", "author_key"), ("same title prefix", "prefix"), ("same title tokens", "tokens"))
#: Pairs of records of one key from which they are not joined but compared in tiles.
MANY = 100_000


def _block_keys(side: DataFrame, *cols: str) -> DataFrame:
    """cols with block, key and the key's hash h: a row for each block that a titled record is in."""
    keys = F.array(*[F.struct(F.lit(n).alias("block"), F.col(k).cast("string").alias("key")) for n, (_, k) in enumerate(BLOCKS)])
    return side.where("title_key != ''").select(*cols, F.inline(keys)).where("key != ''").withColumn("h", F.xxhash64("key"))


def crowded_keys(keyed: DataFrame) -> DataFrame:
    """block and hash h of the keys that ``MANY`` pairs of a new and a known record share."""
    known = F.col("known").cast("int")
    counted = _block_keys(keyed, "known").groupBy("block", "h").agg(F.sum(known).alias("m"), F.sum(1 - known).alias("n"))
    return counted.where(F.col("m") * F.col("n") >= MANY).select("block", "h")


def link_new_records(new: DataFrame, master: DataFrame, row: str = "record_sequence") -> DataFrame:
    """One row per new record: duplicate_status, duplicate_basis, the matched record and similarity.

    Priority: equal title (1), equal DOI with alike title (2), fuzzy probable (3) and possible (4),
    equal DOI with a blank title (5), equal DOI with another title (6); then the more alike, then
    the earlier master row. Records with an equal title are not matched fuzzily.
    """
    sides = with_keys(new, row).withColumn("known", F.lit(False)).unionByName(with_keys(master, row).withColumn("known", F.lit(True)))
    keyed, remove = written(with_signatures(sides))  # read by every block
    n, m = keyed.where("not known"), keyed.where("known")
    n_ = n.alias("l")
    pick = [F.col("l.row").alias("row"), F.col("r.row").alias("master_row"), F.col("r.id").alias("match_id")]
    # Of equal titles the earliest master row is the best match, so a title many rows share joins once.
    earliest = m.where("title_key != ''").groupBy("title_key").agg(F.min("row").alias("row"), F.min_by("id", "row").alias("id")).alias("r")
    exact = n_.where("title_key != ''").join(earliest, F.col("l.title_key") == F.col("r.title_key")).select(*pick, F.lit(1).alias("priority"), F.lit(1.0).alias("similarity"), F.lit("exact normalised title").alias("basis"))
    titled = m.where("doi_key is not null").groupBy("doi_key", "title_key").agg(F.min("row").alias("row"), F.min_by("id", "row").alias("id")).alias("r")
    by_doi = n_.where("doi_key is not null").join(titled, F.col("l.doi_key") == F.col("r.doi_key")).select(*pick, F.col("l.title_key").alias("a"), F.col("r.title_key").alias("b"))
    doi = with_similarity(by_doi.withColumn("blank", (F.col("a") == "") | (F.col("b") == "")), 0.0).select(
        "row", "master_row", "match_id", F.when(F.col("blank"), 5).when(F.col("similarity") >= SAME_DOI, 2).otherwise(6).alias("priority"),
        "similarity", F.lit("doi").alias("basis"),
    )
    # A record with an equal title keeps that match, which comes first, so it needs not be left out of the
    # blocks; only pairs of equal titles are.
    titled_new, titled_master = n.where("title_key != ''"), m.where("title_key != ''")
    # A year, or a name that many share, has too many pairs to be joined in one task: its titles are
    # compared in tiles first, rows follow the similar ones. Keys of few pairs are joined.
    crowded = F.broadcast(cut(crowded_keys(keyed)))
    l, r = (_block_keys(x, "row", "id", "title_key", "s1", "s2").join(crowded, ["block", "h"]) for x in (titled_new, titled_master))  # noqa: E741
    same = similar_in_tiles(l, r, FUZZY, "block", "key").where("x != y").alias("p")
    for side, title in (("l", "x"), ("r", "y")):
        of = (l if side == "l" else r).alias(side)
        same = same.join(of, (F.col(f"{side}.block") == F.col("p.block")) & (F.col(f"{side}.key") == F.col("p.key")) & (F.col(f"{side}.title_key") == F.col(title)))
    met = same.select(*pick, F.col("p.block").alias("block"), "similarity")
    blocks = None
    for order, (_, key) in enumerate(BLOCKS):
        own = F.broadcast(crowded.where(F.col("block") == order).select("h"))
        l, r = (x.where(F.col(key).cast("string") != "").join(own, F.xxhash64(F.col(key).cast("string")) == F.col("h"), "left_anti") for x in (titled_new, titled_master))  # noqa: E741
        part = l.alias("l").join(r.alias("r"), (F.col(f"l.{key}") == F.col(f"r.{key}")) & (F.col("l.title_key") != F.col("r.title_key")) & near("l", "r", FUZZY))
        part = part.select(*pick, F.lit(order).alias("block"), F.col("l.title_key").alias("a"), F.col("r.title_key").alias("b"))
        blocks = part if blocks is None else blocks.unionByName(part)
    met = met.unionByName(with_similarity(blocks, FUZZY)).groupBy("row", "match_id").agg(F.min_by(F.struct("block", "master_row", "similarity"), F.struct("block", "master_row")).alias("s"))
    probable = (F.col("s.similarity") >= PROBABLE) & (F.col("s.block") != 0)
    names = F.array(*[F.lit(b[0]) for b in BLOCKS])
    fuzzy = met.select("row", F.col("s.master_row").alias("master_row"), "match_id", F.when(probable, 3).otherwise(4).alias("priority"), F.col("s.similarity").alias("similarity"), F.get(names, F.col("s.block")).alias("basis"))
    every = exact.unionByName(doi).unionByName(fuzzy)
    best = every.groupBy("row").agg(F.min(F.struct("priority", (-F.col("similarity")).alias("less"), "master_row", "match_id", "basis")).alias("s"))
    status = (
        F.when(F.col("s.priority").isin(1, 2), "duplicate").when(F.col("s.priority") == 3, "probable_duplicate")
        .when(F.col("s.priority").isin(4, 5), "possible_duplicate").when(F.col("s.priority") == 6, "doi_conflict_review").otherwise("new")
    )
    linked = cut(n.select("row").join(best, "row", "left").select(
        "row", status.alias("duplicate_status"), F.coalesce("s.basis", F.lit("")).alias("duplicate_basis"), F.col("s.match_id").alias("matched_id"),
        F.col("s.master_row").alias("matched_row"), F.round(-F.col("s.less"), 6).alias("similarity"),
    ))
    remove()
    return linked


def label_conflicts(records: DataFrame, label: str = "eligibility") -> DataFrame:
    """(basis, key, records, labels) of equal titles or DOIs whose labels differ."""
    keyed = with_keys(records, "record_sequence").join(records.select(F.col("record_sequence").cast("bigint").alias("row"), label), "row").where(F.col(label).isNotNull())
    parts = []
    for basis, key in (("title", "title_key"), ("doi", "doi_key")):
        parts.append(keyed.where(f"{key} != ''").groupBy(F.col(key).alias("key")).agg(F.count("*").alias("records"), F.count_distinct(label).alias("labels")).where("labels > 1").withColumn("basis", F.lit(basis)))
    return parts[0].unionByName(parts[1]).select("basis", "key", "records", "labels")


def collapse_training(records: DataFrame, label: str = "eligibility") -> DataFrame:
    """The best row per (title key, label): with an abstract, then the longest abstract, title, first row."""
    key = t.screening_title(F.col("title"))
    size = lambda c: F.length(F.coalesce(F.col(c), F.lit("")))
    rows = records.where(F.col(label).isNotNull()).select(key.alias("duplicate_group"), label, "record_sequence", size("abstract").alias("abstract_chars"), size("title").alias("title_chars"))
    rank = F.struct((F.col("abstract_chars") > 0).alias("has"), "abstract_chars", "title_chars", (-F.col("record_sequence")).alias("first"))
    return rows.groupBy("duplicate_group", label).agg(F.max(rank).alias("m")).select("duplicate_group", label, (-F.col("m.first")).cast("int").alias("record_sequence"), F.col("m.abstract_chars").alias("abstract_chars"))


def stratified_split(records: DataFrame, label: str = "eligibility", share: float = 0.2) -> DataFrame:
    """record_sequence, label and whether it is for validation: the first share of each label's rows.

    The rank within a label comes from counts per range of the sequence, so a label is never sorted
    in one task.
    """
    rows = records.where(F.col(label).isNotNull()).select("record_sequence", label, F.floor(F.col("record_sequence") / 10_000).alias("b"))
    counts = rows.groupBy(label, "b").agg(F.count("*").alias("n"))
    before = Window.partitionBy(label).orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(label, "b", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"), F.sum("n").over(Window.partitionBy(label)).alias("all"))
    ranked = rows.withColumn("r", F.row_number().over(Window.partitionBy(label, "b").orderBy("record_sequence"))).join(offsets, [label, "b"])
    return ranked.select("record_sequence", label, (F.col("before") + F.col("r") <= F.ceil(F.col("all") * share)).alias("validation"))


def identity_key(identifier: Column, doi: Column, title: Column) -> Column:
    """lens:, else doi:, else title: with the normalised value; NULL where all are blank."""
    norm = lambda c: F.nullif(F.lower(t.squish(F.coalesce(c, F.lit("")))), F.lit(""))
    return F.coalesce(F.concat(F.lit("lens:"), norm(identifier)), F.concat(F.lit("doi:"), norm(doi)), F.concat(F.lit("title:"), norm(title)))


def first_of_identity(rows: DataFrame, key: Column, order: str) -> DataFrame:
    """The first row of each identity; rows without one all stay."""
    keyed = rows.withColumn("_key", key)
    first = keyed.where("_key is not null").groupBy("_key").agg(F.min(order).alias("_first"))
    return keyed.join(first, "_key", "left").where(F.col("_key").isNull() | (F.col(order) == F.col("_first"))).drop("_key", "_first")


def duplicate_count(rows: DataFrame, key: Column) -> DataFrame:
    """One row: records with a key, different keys, and the records beyond the first of each."""
    k = rows.select(key.alias("k"))
    return k.agg(F.count("k").alias("records"), F.count_distinct("k").alias("identities"), (F.count("k") - F.count_distinct("k")).alias("duplicates"))
