"""Duplicates hidden by formatting differences.

Canonical records are range-partitioned, sorted within their partitions (Spark's external sort)
and scanned for adjacent runs of equal full keys. The sort order is (key, order column), so a run
of any length is spread over as many partitions as its size asks for; a run that crosses the
border of a partition is put together from one row per partition.

Defined results: fields that are NULL, empty or placeholders are missing, and missing equals
missing; records of which every field is missing are no copies of one another; equal order values
are ordered by nothing else and count as rows of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut, written

PLACEHOLDERS = ("na", "n/a", "-", "nan", "null", "none", "")


def canonical_text(text: Column) -> Column:
    """Lower case, letters, digits, marks and "&" only; NULL where nothing is left.

    "&" stays because it stands for a word: "x & y" is neither "x and y" nor "x y".
    """
    bare = F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}\p{M}&]+", "")
    return F.when(~F.lower(F.trim(text)).isin(list(PLACEHOLDERS)), F.nullif(bare, F.lit("")))


def canonical_doi(text: Column) -> Column:
    """Prefix and suffix in lower case of a DOI in any writing; NULL where the text is no DOI."""
    bare = F.regexp_replace(F.lower(text), r"%2f", "/")
    bare = F.regexp_replace(bare, r"^[\s\p{Z}]*(?:https?:/+)?(?:(?:dx\.|www\.)?doi\.org/+)?(?:doi[\s\p{Z}]*:?[\s\p{Z}]*)?", "")
    found = F.nullif(F.regexp_extract(bare, r"^(10\.\d{3,9}/[^\s\p{Z}]*[\p{L}\p{N})])[\p{P}\s\p{Z}]*$", 1), F.lit(""))
    return F.when(F.contains(text, F.lit("10.")), found)  # spares most titles the patterns


def title_and_doi(title: Column, doi: Column, in_title: Column, in_doi: Column) -> tuple[Column, Column]:
    """Which of two columns holds the DOI is told by their DOIs ``in_title`` and ``in_doi``; both are returned canonical."""
    swapped = in_title.isNotNull() & in_doi.isNull()
    return canonical_text(F.when(swapped, doi).otherwise(title)), F.when(swapped, in_title).otherwise(in_doi)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adjacent runs of one sorted partition: the head of each row's run and the run's number."""
    part = head = key = None
    run = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        keys, order = batch.column("_key"), batch.column("_order").to_numpy()
        part = batch.column("_part")
        starts = np.ones(batch.num_rows, bool)
        if batch.num_rows > 1:
            starts[1:] = ~np.asarray(pa.compute.equal(keys.slice(1), keys.slice(0, batch.num_rows - 1)))
        starts[0] = key is None or keys[0].as_py() != key
        at = np.maximum.accumulate(np.where(starts, np.arange(batch.num_rows), -1))
        heads = np.where(at >= 0, order[at], head if head is not None else 0)
        runs = run + np.cumsum(starts)
        run, head, key = int(runs[-1]), heads[-1], keys[-1].as_py()
        yield pa.RecordBatch.from_arrays(
            [part, batch.column("_order"), pa.array(heads, pa.int64()), pa.array(runs, pa.int64()), keys],
            names=["_part", "_order", "_head", "_run", "_key"],
        )


def adjacent_runs(records: DataFrame, key: Column, order: Column) -> DataFrame:
    """Columns ``key``, ``order_value`` and ``first``: of each record the least order value among
    the records with an equal full key. Records with a NULL key are left out."""
    # The key is computed once: sampling and shuffle, and a filter pushed below it, read it again.
    keyed, remove = written(records.select(key.alias("_key"), order.cast("bigint").alias("_order")))
    keyed = keyed.where("_key is not null")
    placed = keyed.repartitionByRange(F.col("_key"), F.col("_order")).withColumn("_part", F.spark_partition_id())
    ordered = placed.sortWithinPartitions("_key", "_order")
    scanned = cut(
        ordered.select("_key", "_order", "_part").mapInArrow(_scan, "_part int, _order bigint, _head bigint, _run bigint, _key string")
    )
    remove()
    # Only the first run of a partition can have begun in another: at most one row per partition.
    opening = scanned.where("_run = 1").groupBy("_part").agg(F.first("_key").alias("_key"))
    begun = scanned.join(F.broadcast(opening.select("_key").distinct()), "_key", "left_semi")
    begun = begun.groupBy("_key").agg(F.min("_order").alias("_start"))
    whole = scanned.join(F.broadcast(begun), "_key", "left")
    return whole.select(
        F.col("_key").alias("key"), F.col("_order").alias("order_value"), F.coalesce("_start", "_head").alias("first")
    )


def collapse(records: DataFrame, key: Column, order: Column) -> DataFrame:
    """One row per group of copies: ``first``, the full ``key`` and the exact number of ``copies``."""
    return adjacent_runs(records, key, order).groupBy("first").agg(F.first("key").alias("key"), F.count("*").alias("copies"))


def record_key(title: Column, doi: Column, in_title: Column | None = None, in_doi: Column | None = None) -> Column:
    """Full key of title and DOI in canonical form; NULL where both are missing. ``in_title`` and
    ``in_doi`` may give the DOIs found in the columns, so that they are not looked for repeatedly."""
    name, number = title_and_doi(title, doi, canonical_doi(title) if in_title is None else in_title, canonical_doi(doi) if in_doi is None else in_doi)
    whole = F.concat(F.coalesce(name, F.lit("")), F.lit("\x1f"), F.coalesce(number, F.lit("")))
    return F.nullif(whole, F.lit("\x1f"))


def keyed_records(screening: DataFrame) -> DataFrame:
    """record_sequence and the key of each record."""
    told = screening.select("record_sequence", "title", "doi", canonical_doi(F.col("title")).alias("in_title"), canonical_doi(F.col("doi")).alias("in_doi"))
    return told.select("record_sequence", record_key(*(F.col(c) for c in ("title", "doi", "in_title", "in_doi"))).alias("key"))


def copies_of_records(screening: DataFrame) -> DataFrame:
    """The smallest sequence of each group of copies with each other one."""
    runs = adjacent_runs(keyed_records(screening), F.col("key"), F.col("record_sequence"))
    return runs.where("first < order_value").select(
        F.col("first").cast("int").alias("first_sequence"), F.col("order_value").cast("int").alias("copy_sequence")
    )


def collapsed_records(screening: DataFrame) -> DataFrame:
    """One row per different record with its number of copies: first_sequence, copies."""
    groups = collapse(keyed_records(screening), F.col("key"), F.col("record_sequence"))
    return groups.select(F.col("first").cast("int").alias("first_sequence"), "copies")
