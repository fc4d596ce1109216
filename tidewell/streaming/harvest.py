"""Incremental harvests as Structured Streaming, and the same in batches.

A weekly run reads again the days before the last success; what was seen is dropped by identity
within the watermark, so state is bounded by the overlap, and the checkpoint moves only after the
batch was written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OVERLAP = "7 days"


def window_of(rows: DataFrame, created: str, last: Column, now: Column, days: int = 7) -> DataFrame:
    """Rows created from ``days`` before the last success until now; without one, of the last days."""
    start = F.coalesce(last, now) - F.expr(f"INTERVAL {days} DAYS")
    return rows.where((F.col(created) >= start) & (F.col(created) <= now))


def first_seen(rows: DataFrame, identity: list[str], created: str, overlap: str = OVERLAP) -> DataFrame:
    """Streaming: the first row of each identity within the watermark."""
    return rows.withWatermark(created, overlap).dropDuplicatesWithinWatermark(identity)


def first_seen_batch(rows: DataFrame, identity: list[str], order: list[str]) -> DataFrame:
    """Batch: the first row of each identity by the order columns."""
    rest = [c for c in rows.columns if c not in identity]
    first = rows.groupBy(*identity).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return first.select(*identity, *[F.col(f"_r.{c}").alias(c) for c in rest])


def weekly_counts(rows: DataFrame, created: str, identity: list[str], overlap: str = OVERLAP) -> DataFrame:
    """Rows and identities per week; as a stream, late rows within the overlap are counted."""
    source = rows.withWatermark(created, overlap) if rows.isStreaming else rows
    key = F.xxhash64(*identity)
    unique = F.approx_count_distinct(key) if rows.isStreaming else F.count_distinct(*identity)
    weeks = source.groupBy(F.window(created, "7 days")).agg(F.count("*").alias("raw_records"), unique.alias("unique_records"))
    return weeks.select(F.col("window.start").alias("week"), "raw_records", "unique_records")


def run_harvest(stream: DataFrame, out: str, history: str, checkpoint: str, identity: list[str], created: str):
    """Writes new rows and a history row per batch, once for all that is there (availableNow).

    Rows and history are kept by batch number and that part is overwritten, so a batch that is run
    again after a failure is not there twice.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        keep = lambda df, path: df.withColumn("batch", F.lit(number)).write.mode("overwrite").partitionBy("batch").option("partitionOverwriteMode", "dynamic").parquet(path)
        keep(batch, out)
        audit = batch.agg(F.lit(number).alias("run"), F.count("*").alias("candidate_results"), F.max(created).alias("last_created"))
        keep(audit.withColumn("status", F.when(F.col("candidate_results") > 0, "records_found").otherwise("no_records")), history)
        batch.unpersist()

    return first_seen(stream, identity, created).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
