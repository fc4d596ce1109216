"""Keeping the master: publication status, outside decisions, adjudication, merges and caches.

Functions that ask something outside (a lookup, a language model) take it as a callable and run it
in Arrow batches; the result should be written before it is used twice.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t
from ..functions import values as v

LOOKUP = "doi_for_lookup string, openalex_id string, openalex_title string, openalex_is_retracted boolean, openalex_lookup_status string, openalex_error string"


def lookup_dois(dois: DataFrame, fetch: Callable[[list[str]], dict[str, dict]], size: int = 100) -> DataFrame:
    """Asks for distinct non-empty DOIs in batches; absent ones are not_found, a failing batch failed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = batch.column("doi").to_pylist()
            rows = []
            for i in range(0, len(every), size):
                part = every[i : i + size]
                try:
                    got, state, error = fetch(part), "found", None
                except Exception as problem:  # noqa: BLE001 - whatever fails outside fails this batch only
                    got, state, error = {}, "failed", str(problem)[:500]
                for doi in part:
                    hit = got.get(doi)
                    rows.append((doi, hit and hit.get("id"), hit and hit.get("title"), bool(hit and hit.get("is_retracted")), state if hit or error else "not_found", error))
            columns = list(zip(*rows)) if rows else [()] * 6
            types = (pa.string(), pa.string(), pa.string(), pa.bool_(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, types)], names=[c.split()[0] for c in LOOKUP.split(", ")])

    return dois.select("doi").where("doi is not null and doi <> ''").distinct().mapInArrow(run, LOOKUP)


def publication_status(records: DataFrame, lookup: DataFrame) -> DataFrame:
    """Audit of every record: notices are removed without a lookup, retracted originals by it."""
    keyed = records.withColumn("notice_type", t.notice_type(F.col("title"))).withColumn("doi_for_lookup", t.lookup_doi(F.col("doi")))
    joined = keyed.join(lookup, "doi_for_lookup", "left")
    retracted = F.coalesce("openalex_is_retracted", F.lit(False)) & F.col("notice_type").isNull()
    status = F.when(F.col("notice_type").isNotNull(), "not_queried_notice").when(F.col("doi_for_lookup") == "", "not_queried_no_doi").otherwise(F.coalesce("openalex_lookup_status", F.lit("not_found")))
    return joined.withColumn("openalex_lookup_status", status).withColumns(
        {
            "remove_publication_status": F.col("notice_type").isNotNull() | retracted,
            "removal_reason": F.when(F.col("notice_type").isNotNull(), F.col("notice_type")).when(retracted, "retracted_original"),
        }
    )


def due_lookups(cache: DataFrame, as_of: Column, most: int = 500) -> DataFrame:
    """Not known to be retracted and never or no longer checked: never checked ones first, then the oldest."""
    due = cache.where(~F.coalesce("openalex_is_retracted", F.lit(False)) & (F.col("next_check_at").isNull() | (F.col("next_check_at") <= as_of)))
    return due.orderBy(F.col("next_check_at").asc_nulls_first(), "doi_for_lookup").limit(most)


def next_check(as_of: Column, status: Column, retracted: Column) -> Column:
    """A day after a failure, ninety days after an answer, never once retracted."""
    return F.when(F.coalesce(retracted, F.lit(False)), F.lit(None).cast("timestamp")).when(status == "failed", as_of + F.expr("INTERVAL 1 DAY")).otherwise(as_of + F.expr("INTERVAL 90 DAYS"))


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` in the place of those of ``old`` with their key, columns aligned by name."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new, allowMissingColumns=True)


def final_decision(automatic: Column, asked: Column, failed: Column) -> Column:
    """retain / exclude by the model's thresholds, else by the answer where it did not fail, else uncertain."""
    good = ~F.coalesce(failed, F.lit(True))
    return (
        F.when(automatic == "automatic_retain", "retain").when(automatic == "automatic_exclude", "exclude")
        .when(good & asked.isin("retain", "exclude"), asked).otherwise("uncertain")
    )


def adjudication_queue(records: DataFrame, species: DataFrame, summary: DataFrame, ranking: DataFrame) -> DataFrame:
    """Records whose species or geography is to be decided, with what was found so far."""
    found = species.groupBy("id").agg(
        v.joined_distinct(F.col("farmed_species")).alias("deterministic_species"), v.joined_distinct(F.col("farmed_species_id")).alias("deterministic_species_ids"),
        v.joined_distinct(F.col("assignment_reason")).alias("species_reasons"), v.joined_distinct(F.col("non_target_species")).alias("non_target_species"),
        F.bool_or("review_required").alias("species_review_required"),
    )
    each = F.struct("best_tier", F.col("iso3c").alias("k"), F.concat("country_name", F.lit(" ["), "iso3c", F.lit("]; tier "), F.col("best_tier").cast("string")).alias("text"))
    places = ranking.groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_set(each)), lambda s: s["text"]), " | ").alias("geography_candidates"))
    geo = summary.select("id", F.col("review_required").alias("geography_review_required"), F.col("review_reason").alias("geography_review_reason"), F.col("primary_countries").alias("deterministic_primary_countries"))
    joined = records.join(found, "id", "left").join(geo, "id", "left").join(places, "id", "left")
    flags = {c: F.coalesce(c, F.lit(False)) for c in ("species_review_required", "geography_review_required")}
    return joined.withColumns(flags).where("species_review_required or geography_review_required")


def ask(queue: DataFrame, model: Callable[[list[dict]], list[dict]], key: str, answer: dict[str, str], size: int = 25) -> DataFrame:
    """Answers of ``model`` to batches of rows: key, the fields of ``answer`` (name: value when it
    fails), llm_failed, llm_error. Ids that do not come back exactly fail their batch."""
    names = queue.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, out = batch.to_pylist(), []
            for i in range(0, len(rows), size):
                part = rows[i : i + size]
                try:
                    got = {str(a[key]): a for a in model([{n: r[n] for n in names} for r in part])}
                    if set(got) != {str(r[key]) for r in part}:
                        raise ValueError("the answer's ids are not those asked")
                    out += [(str(r[key]), *[str(got[str(r[key])].get(f)) for f in answer], False, None) for r in part]
                except Exception as problem:  # noqa: BLE001
                    out += [(str(r[key]), *answer.values(), True, str(problem)[:500]) for r in part]
            columns = list(zip(*out)) if out else [()] * (len(answer) + 3)
            types = [pa.string()] * (len(answer) + 1) + [pa.bool_(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, types)], names=[key, *answer, "llm_failed", "llm_error"])

    fields = ", ".join(f"{f} string" for f in answer)
    return queue.mapInArrow(run, f"{key} string, {fields}, llm_failed boolean, llm_error string")


def structured_answer(response: str) -> dict:
    """The JSON in the first text of the first message of a response envelope."""
    for item in json.loads(response).get("output", []):
        if item.get("type") == "message":
            for part in item.get("content", []):
                if part.get("type") == "output_text":
                    return json.loads(part["text"])
    raise ValueError("the response holds no text")


def pending(records: DataFrame, done: DataFrame, key: str, state: str = "completed") -> DataFrame:
    """Records without a finished row in a checkpoint table."""
    return records.join(done.where(F.col("status") == state).select(key).distinct(), key, "left_anti")


def topic_map(assignments: DataFrame) -> DataFrame:
    """Per record the sorted distinct ids and paths, whether any is to be reviewed, and the reasons."""
    return assignments.groupBy("record_id").agg(
        v.joined_distinct(F.col("path_id")).alias("topic_path_ids"), v.joined_distinct(F.col("hierarchy_path")).alias("topic_hierarchy_paths"),
        F.bool_or(F.lower(F.coalesce(F.col("review_required").cast("string"), F.lit(""))).isin("true", "1", "yes")).alias("topic_review_required"),
        v.joined_distinct(F.col("review_reason")).alias("topic_review_reason"),
    )


def merge_checks(master: DataFrame, update: DataFrame, key: Column) -> DataFrame:
    """One row of what a merge must have as zero: empty update, duplicates, overlap."""
    u, m = update.select(key.alias("k")), master.select(key.alias("k"))
    counts = u.agg(F.count("*").alias("update_records"), (F.count("k") - F.count_distinct("k")).alias("update_duplicates"))
    common = u.where("k is not null").distinct().join(m.distinct(), "k", "left_semi").agg(F.count("*").alias("overlap"))
    old = m.agg(F.count("*").alias("master_records"), (F.count("k") - F.count_distinct("k")).alias("master_duplicates"))
    return counts.crossJoin(common).crossJoin(old)  # tables of one row


def candidate_master(master: DataFrame, update: DataFrame, topics: DataFrame) -> DataFrame:
    """Master and update with the update's topics; columns are the union of all, absent ones NULL."""
    own = [c for c in ("topic_path_ids", "topic_hierarchy_paths", "topic_review_required", "topic_review_reason") if c in update.columns]
    told = update.drop(*own).join(topics, "record_id", "left")
    both = {c: F.col(c).cast("string") for c in ("topic_review_required",)}
    return master.withColumns({k: c for k, c in both.items() if k in master.columns}).unionByName(told.withColumns(both), allowMissingColumns=True)


def manifest(records: DataFrame, name: str) -> DataFrame:
    """One row: the table's name, records, least and greatest sequence."""
    return records.agg(F.lit(name).alias("target_name"), F.count("*").alias("n_records"), F.min("record_sequence").alias("min_sequence"), F.max("record_sequence").alias("max_sequence"))


def key_problems(records: DataFrame, keys: list[str]) -> DataFrame:
    """(key, problem, rows): keys that are NULL, empty or not unique."""
    parts = []
    for k in keys:
        text = F.col(k).cast("string")
        empty = records.agg(F.lit(k).alias("key"), F.lit("missing").alias("problem"), F.count_if(text.isNull() | (text == "")).alias("rows"))
        twice = records.where(text.isNotNull()).groupBy(text.alias("t")).agg(F.count("*").alias("n")).where("n > 1").agg(F.lit(k).alias("key"), F.lit("repeated").alias("problem"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))
        parts += [empty, twice]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return whole
