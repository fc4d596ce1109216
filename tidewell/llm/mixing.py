"""Mixing sources to target weights.

Weighted fair queueing: the documents of a source stand in shuffled order, pass after pass up to
the source's cap; each (document, pass) gets the virtual finish time

    tokens of its source up to and including it / target weight of the source

and the global order of finish times, cut where the total budget is spent, is a mix in which at
any moment every source has had its share. Both running sums (within a source, and over all) are
taken in two levels, sums of bounded buckets first, so no source is ever one task; the buckets of
the global order are ranges of about as many rows each, found by sampling.

Sources without documents, and documents of sources that are not listed, take no part; the shares
of the others are taken relative to one another. Without a budget the largest total is used at
which every source can still give its share within its cap.

Defined results: NULL and empty texts have no tokens and are never used; a NULL source is not
listed; max_repeats below 1 excludes the source; the last document that would pass the budget is
left out, so the total is at most the budget and short of it by less than one document.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut

#: Vocabulary file of the public tokenizer; a parameter of every function that counts tokens.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pattern that splits text before byte-pair merging for that vocabulary.
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
#: Rows of one bucket of a running sum within a source, and of one range of the global order.
BUCKET_ROWS = 20_000
RANGE_ROWS = 200_000
#: Listed sources up to which their few numbers are broadcast.
MOST_SOURCES = 100_000


def _counter(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(word): int(rank) for word, rank in (line.split() for line in lines if line.strip())}
        coder = tiktoken.Encoding("public", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        for batch in batches:
            counts = [len(coder.encode_ordinary(t)) if t else 0 for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("source"), pa.array(counts, pa.int64())], names=["doc_id", "source", "tokens"])

    return run


def token_counts(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, source, tokens) of every document."""
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "source", "text")
    return rows.mapInArrow(_counter(vocabulary), "doc_id bigint, source string, tokens bigint")


def running_sum(rows: DataFrame, group: list[str], bucket: Column, order: list[str | Column], value: str, name: str) -> DataFrame:
    """Adds the sum of ``value`` up to each row in the order (bucket, order) within ``group``.

    ``bucket`` must not fall as the order rises; only a bucket, not a group, is sorted in one task.
    """
    placed = rows.withColumn("_bucket", bucket)
    sums = placed.groupBy(*group, "_bucket").agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*group, "_bucket", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*group, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    joined = placed.withColumn("_inside", F.sum(value).over(inside)).join(offsets, [*group, "_bucket"])
    return joined.withColumn(name, F.col("_before") + F.col("_inside")).drop("_bucket", "_before", "_inside")


def plan_shares(counted: DataFrame, targets: DataFrame, budget: int | None = None) -> DataFrame:
    """One row per listed source: weight, what it has, its cap, the budget of the whole mix, the
    passes it may need and the virtual time by which the budget is spent.

    Until time t a source gives weight * t tokens or all it may; the sum over the sources rises
    piecewise, so its pieces, one per source, tell when it reaches the budget. A source lags behind
    by less than its largest document, hence these are added to the budget.
    """
    have = counted.where("tokens > 0").groupBy("source").agg(F.sum("tokens").alias("has_tokens"), F.count("*").alias("has_documents"), F.max("tokens").alias("largest"))
    listed = targets.where("source is not null and target_share > 0").groupBy("source").agg(
        F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats")
    )
    known = listed.join(have, "source", "left").withColumn("usable", (F.coalesce("has_tokens", F.lit(0)) > 0) & (F.coalesce("max_repeats", F.lit(0)) >= 1))
    whole = Window.partitionBy(F.lit(1))  # the list of sources, not the documents
    share = F.when(F.col("usable"), F.col("target_share"))
    known = known.withColumn("weight", share / F.sum(share).over(whole)).withColumn("most", F.when(F.col("usable"), F.col("has_tokens") * F.col("max_repeats")))
    known = known.withColumn("spent", F.col("most") / F.col("weight"))
    total = F.lit(budget).cast("double") if budget is not None else F.floor(F.min("spent").over(whole)).cast("double")
    known = known.withColumn("budget", total).withColumn("wanted", F.col("budget") + F.sum("largest").over(whole))
    first = whole.orderBy(F.col("spent").asc_nulls_last(), "source")
    before, after = first.rowsBetween(Window.unboundedPreceding, -1), first.rowsBetween(0, Window.unboundedFollowing)
    reached = (F.col("wanted") - F.coalesce(F.sum("most").over(before), F.lit(0))) / F.sum("weight").over(after)
    known = known.withColumn("reached", F.when(reached <= F.col("spent"), reached))
    known = known.withColumn("until", F.coalesce(F.max("reached").over(whole), F.max("spent").over(whole)))
    passes = F.least(F.col("max_repeats").cast("bigint"), F.ceil(F.col("until") * F.col("weight") / F.col("has_tokens")).cast("bigint") + 1)
    return known.withColumn("passes", F.greatest(passes, F.lit(1))).drop("most", "spent", "wanted", "reached", "largest")


def mixed(documents: DataFrame, targets: DataFrame, budget: int | None = None, seed: int = 17, vocabulary: str = VOCABULARY) -> tuple[DataFrame, DataFrame]:
    """(used, report): used has doc_id, source, tokens and copies of every document in the mix;
    report has the target and the reached share of every source, listed or not."""
    counted = cut(token_counts(documents, vocabulary))
    plan = cut(plan_shares(counted, targets, budget))
    ready = plan.where("usable").select("source", "weight", "budget", "until", "passes", F.ceil(F.col("has_documents") / F.lit(BUCKET_ROWS)).cast("bigint").alias("buckets"))
    ready = F.broadcast(ready) if plan.count() <= MOST_SOURCES else ready
    queue = counted.where("tokens > 0").join(ready, "source")
    place = F.xxhash64(F.lit(seed), "doc_id")
    passes = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("passes") - 1)).alias("pass")
    queue = queue.select("doc_id", "source", "tokens", "weight", "budget", "until", "buckets", place.alias("place"), passes)
    part = F.pmod("place", "buckets").cast("bigint")
    timed = running_sum(queue, ["source"], F.col("pass") * F.col("buckets") + part, ["place", "doc_id"], "tokens", "source_tokens")
    timed = timed.withColumn("finish", F.col("source_tokens") / F.col("weight")).where("finish <= until + 1e-6 * until + 1")
    timed = cut(timed.select("doc_id", "source", "tokens", "pass", "budget", "finish"))
    # Ranges by sampling hold about as many rows each, however unevenly documents finish.
    ranges = max(1, -(-timed.count() // RANGE_ROWS))
    order = ["finish", "source", "doc_id", "pass"]
    ranged = cut(timed.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()))
    ranked = running_sum(ranged, [], F.col("_range"), order, "tokens", "total")
    chosen = cut(ranked.where("total <= budget").groupBy("doc_id", "source", "tokens").agg(F.count("*").cast("int").alias("copies")))
    used = chosen.groupBy("source").agg(F.count("*").alias("documents"), F.sum(F.col("tokens") * F.col("copies")).alias("mixed_tokens"), F.max("copies").alias("most_copies"))
    whole = Window.partitionBy(F.lit(1))
    seen = counted.groupBy("source").agg(F.sum("tokens").alias("available_tokens"))
    report = (
        seen.join(plan.select(F.col("source").alias("listed"), "target_share", "max_repeats", "weight"), F.expr("source = listed"), "full")
        .select(F.coalesce("source", "listed").alias("source"), "target_share", "max_repeats", "weight", F.coalesce("available_tokens", F.lit(0)).alias("available_tokens"))
        .alias("p")
        .join(used.alias("u"), F.expr("p.source = u.source"), "left")
        .select("p.*", F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("mixed_tokens", F.lit(0)).alias("mixed_tokens"), F.coalesce("most_copies", F.lit(0)).alias("most_copies"))
    )
    report = report.withColumn("actual_share", F.col("mixed_tokens") / F.sum("mixed_tokens").over(whole))
    return chosen, report.withColumn(
        "state",
        F.when(F.col("target_share").isNull(), "not listed")
        .when(F.col("weight").isNull(), "no documents")
        .when(F.abs(F.col("actual_share") - F.col("weight")) <= 0.01, "reached")
        .otherwise("missed"),
    )
