"""An update put together, and repairs of the master: adjudicated duplicates, annotation, topics,
exclusions, country and taxon confusions, known duplicates, replacement with an archive."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import values as v
from .maintenance import topic_map

RESIDUAL = ("probable_duplicate", "possible_duplicate", "doi_conflict_review")
DECISIONS = ("duplicate", "not_duplicate", "uncertain")


def merge_adjudication(audit: DataFrame, answers: DataFrame, key: str = "incoming_row") -> DataFrame:
    """The audit with api_decision, api_confidence, api_rationale and final_duplicate_status.

    ``answers`` has the key, decision, confidence and rationale of residual rows. A residual row
    ends as a duplicate or new by its answer and stays ``uncertain`` without a usable one.
    """
    told = answers.select(key, F.col("decision").alias("api_decision"), F.col("confidence").alias("api_confidence"), F.col("rationale").alias("api_rationale"))
    residual = F.col("duplicate_status").isin(*RESIDUAL)
    answered = F.when(F.col("api_decision") == "duplicate", "duplicate").when(F.col("api_decision") == "not_duplicate", "new").otherwise("uncertain")
    return audit.join(told, key, "left").withColumn("final_duplicate_status", F.when(residual, answered).otherwise(F.col("duplicate_status")))


def adjudication_problems(audit: DataFrame, answers: DataFrame, key: str = "incoming_row") -> DataFrame:
    """One row of what must be zero before an update goes on: repeated, unasked, unanswered and
    invalid answers, and uncertain ones."""
    asked = audit.where(F.col("duplicate_status").isin(*RESIDUAL)).select(key).distinct()
    valid = F.coalesce(F.col("decision").isin(*DECISIONS) & F.col("confidence").between(0, 1) & (F.trim("rationale") != ""), F.lit(False))
    counts = answers.agg(
        (F.count(key) - F.count_distinct(key)).alias("repeated"), F.count_if(~valid).alias("invalid"), F.count_if(F.col("decision") == "uncertain").alias("uncertain")
    )
    unasked = answers.select(key).distinct().join(asked, key, "left_anti").agg(F.count("*").alias("unasked"))
    unanswered = asked.join(answers, key, "left_anti").agg(F.count("*").alias("unanswered"))
    return counts.crossJoin(unasked).crossJoin(unanswered)  # tables of one row


def enforce(problems: DataFrame, what: str) -> None:
    """ValueError if any number of a one-row table is not zero."""
    found = {k: n for k, n in problems.first().asDict().items() if n}
    if found:
        raise ValueError(f"{what}: " + ", ".join(f"{k} {n}" for k, n in sorted(found.items())))


def new_records(incoming: DataFrame, merged: DataFrame, key: str = "incoming_row") -> DataFrame:
    """Incoming rows whose final status is new."""
    return incoming.join(merged.where("final_duplicate_status = 'new'").select(key), key, "left_semi")


def update_summary(incoming: DataFrame, existing: DataFrame, merged: DataFrame) -> DataFrame:
    """One row of counts of an update."""
    said = lambda d: F.count_if(F.col("api_decision") == d)
    counts = merged.agg(
        F.count_if(F.col("duplicate_status") == "duplicate").alias("automatic_duplicates"), F.count_if(F.col("duplicate_status").isin(*RESIDUAL)).alias("residual_candidates"),
        said("duplicate").alias("api_duplicates"), said("not_duplicate").alias("api_not_duplicates"), said("uncertain").alias("api_uncertain"),
        F.count_if(F.col("final_duplicate_status") == "new").alias("new_records_after_deduplication"),
    )
    sizes = incoming.agg(F.count("*").alias("incoming_records")).crossJoin(existing.agg(F.count("*").alias("existing_records")))
    return sizes.crossJoin(counts)  # tables of one row


def screening_summary(records: DataFrame, decision: str = "final_screening_decision") -> DataFrame:
    """Records per final decision."""
    return records.groupBy(decision).agg(F.count("*").alias("records"))


def lookup_unique(wanted: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """``wanted`` with the columns of ``table``, which must have each wanted key exactly once."""
    met = wanted.select(key).distinct().join(table.groupBy(key).agg(F.count("*").alias("n")), key, "left")
    bad = met.where("n is null or n <> 1").count()
    if bad:
        raise ValueError(f"{bad} {key} value(s) do not stand exactly once in the table")
    return wanted.join(table, key)


def annotated(records: DataFrame, species: DataFrame, places: DataFrame, answers: DataFrame, key: str = "id") -> DataFrame:
    """Records with their final species and countries: the answer where one was given, else what was found.

    ``species`` has a row per assignment, ``places`` a row per record; ``answers`` may decide either
    and says ACCEPT, a value or UNRESOLVED.
    """
    found = species.groupBy(key).agg(v.joined_distinct(F.col("farmed_species")).alias("species_found"), F.bool_or("review_required").alias("species_review"))
    where = places.select(key, F.col("primary_countries").alias("countries_found"), F.col("review_required").alias("country_review"))
    joined = records.join(found, key, "left").join(where, key, "left").join(answers, key, "left")
    pick = lambda told, has: F.when(F.coalesce(told, F.lit("ACCEPT")) == "ACCEPT", has).when(told != "UNRESOLVED", told)
    return joined.withColumns({"final_species": pick(F.col("species_decision"), F.col("species_found")), "final_countries": pick(F.col("country_decision"), F.col("countries_found"))})


def assignment_totals(assignments: DataFrame) -> DataFrame:
    """One row: assignments, records with any, failed rows and records to be reviewed."""
    review = F.coalesce(F.col("review_required"), F.lit(False)) | (F.coalesce("status", F.lit("")) == "failed")
    return assignments.agg(
        F.count("path_id").alias("assignments"), F.count_distinct(F.when(F.col("path_id").isNotNull(), F.col("record_id"))).alias("records"),
        F.count_if(F.col("status") == "failed").alias("failed"), F.count_distinct(F.when(review, F.col("record_id"))).alias("to_review"),
    )


def sweep_counts(audit: DataFrame) -> DataFrame:
    """One row about a sweep for retractions: DOIs, checked, retracted, failed."""
    return audit.agg(
        F.count_distinct(F.nullif("doi_for_lookup", F.lit(""))).alias("dois"), F.count_if(F.col("openalex_lookup_status") == "found").alias("checked"),
        F.count_if(F.col("removal_reason") == "retracted_original").alias("retracted"), F.count_if(F.col("openalex_lookup_status") == "failed").alias("failed"),
    )


def specific_assignments(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Four-level assignments without "General > General" where the same topic and subtopic of the
    record have a more specific one."""
    specific = (F.col("feature") != "General") | (F.col("component") != "General")
    any_ = F.bool_or(specific).over(Window.partitionBy(*keys, "broad_topic", "subtopic"))
    return rows.withColumn("_any", any_).where(specific | ~F.col("_any")).drop("_any")


def split_assignment(path: Column) -> list[Column]:
    """The four levels of an assignment, absent ones empty."""
    parts = F.split(path, r"\s*>\s*", 4)
    return [F.coalesce(F.get(parts, F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(("broad_topic", "subtopic", "feature", "component"))]


def valid_assignments(answers: DataFrame, paths: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(answers whose path the list has, the keys of answers with others): a record with any path
    outside the list has failed as a whole."""
    outside = answers.join(paths.select("hierarchy_path").distinct(), "hierarchy_path", "left_anti").select(key).distinct()
    return answers.join(outside, key, "left_anti"), outside


def recover_topics(master: DataFrame, assignments: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(master, counts): the four topic columns filled from assignments where a record has none.

    Complete records are kept as they are. Counts are one row: ids not in the master and records
    without a path (both must be zero), repaired and already complete records.
    """
    topics = topic_map(assignments).select("record_id", *[F.col(c).alias("_" + c) for c in ("topic_path_ids", "topic_hierarchy_paths", "topic_review_required", "topic_review_reason")])
    absent = topics.join(master.select("record_id").distinct(), "record_id", "left_anti").agg(F.count("*").alias("absent"))
    has = (F.trim(F.coalesce("topic_hierarchy_paths", F.lit(""))) != "") & (F.trim(F.coalesce("topic_path_ids", F.lit(""))) != "")
    joined = master.join(topics.withColumn("_told", F.lit(True)), "record_id", "left").withColumn("_complete", has)
    fill = F.coalesce("_told", F.lit(False)) & ~F.col("_complete") & F.col("_topic_hierarchy_paths").isNotNull()
    counts = joined.agg(F.count_if(F.col("_told") & F.col("_topic_hierarchy_paths").isNull()).alias("without_path"), F.count_if(fill).alias("repaired"), F.count_if(F.col("_told") & F.col("_complete")).alias("already_complete"))
    told = {c: F.col("_" + c) for c in ("topic_path_ids", "topic_hierarchy_paths", "topic_review_reason")} | {"topic_review_required": F.upper(F.col("_topic_review_required").cast("string"))}
    filled = joined.withColumns({c: F.when(fill, x).otherwise(F.col(c)) for c, x in told.items()}).select(*master.columns)
    return filled, counts.crossJoin(absent)  # tables of one row


def excluded(master: DataFrame, decisions: DataFrame, absent_ok: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """remaining, removed and problems: records whose ``human_decision`` is to exclude leave the master.

    problems has the ids to exclude that the master lacks, those of ``absent_ok`` apart.
    """
    ids = decisions.where(F.lower(F.trim("human_decision")) == "exclude").select(F.trim(F.col("record_id").cast("string")).alias("_id")).where("_id <> ''").distinct()
    own = F.trim(F.col("record_id").cast("string"))
    rows = master.withColumn("_id", own)
    missing = ids.join(rows.select("_id").distinct(), "_id", "left_anti").where(~F.col("_id").isin(*absent_ok) if absent_ok else F.lit(True))
    return {"remaining": rows.join(ids, "_id", "left_anti").drop("_id"), "removed": rows.join(ids, "_id", "left_semi").drop("_id"), "problems": missing.select(F.col("_id").alias("record_id"))}


def wanted_records(ids: DataFrame, master: DataFrame, key: str = "record_id") -> DataFrame:
    """The master's rows of the ids; ValueError if any is not there."""
    absent = ids.select(key).distinct().join(master.select(key), key, "left_anti").count()
    if absent:
        raise ValueError(f"{absent} {key} value(s) are not in the master")
    return master.join(ids.select(key).distinct(), key, "left_semi")


def repair_confusions(master: DataFrame, genus: str, iso: list[str], names: list[str], texts: tuple[str, ...] = ("title", "abstract"), species: tuple[str, ...] = ("final_species",), codes: str = "final_primary_country_iso3c", countries: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(master, audit): territories named like a genus are taken out where the record is about the genus.

    A record is about it if a species column has its name, or any text its name with an epithet.
    Codes and names are compared case apart; audit has the old and new values of changed records.
    """
    about = F.concat_ws(" ", *species).rlike(rf"(?i)\b{genus}\b") | F.concat_ws(" ", *species, *texts).rlike(rf"(?i)\b{genus}\s+[a-z][a-z-]+\b")
    gone = {codes: iso} | ({countries: names} if countries else {})

    def without(column: str, values: list[str]) -> Column:
        has = F.exists(v.split_values(F.col(column)), lambda x: F.lower(x).isin([y.lower() for y in values]))
        return F.when(about & has, v.drop_values(F.col(column), values)).otherwise(F.col(column))

    new = {c: without(c, g) for c, g in gone.items()}
    both = master.withColumns({f"_old_{c}": F.col(c) for c in gone}).withColumns(new)
    changed = F.lit(False)
    for c in gone:
        changed = changed | ~F.col(c).eqNullSafe(F.col(f"_old_{c}"))
    audit = both.where(changed).select("record_id", *[x for c in gone for x in (F.col(f"_old_{c}").alias(f"old_{c}"), F.col(c).alias(f"new_{c}"))])
    return both.drop(*[f"_old_{c}" for c in gone]), audit


def resolve_duplicates(rows: DataFrame, group: str, key: str = "record_id") -> DataFrame:
    """One row per group of known duplicates: the member with pages and the longest address, then
    the least id, stays and gets all different addresses of the group; ungrouped rows are kept."""
    known = rows.where(F.col(group).isNotNull())
    order = F.struct((F.trim(F.coalesce("pages", F.lit(""))) == "").alias("a"), (-F.length(F.coalesce("url_raw", F.lit("")))).alias("b"), F.col(key).alias("c"))
    rest = [c for c in rows.columns if c not in (group, "url_raw")]
    kept = known.groupBy(group).agg(F.min_by(F.struct(*rest), order).alias("_r"), v.joined_distinct(F.col("url_raw")).alias("url_raw"))  # addresses of one publication
    return rows.where(F.col(group).isNull()).unionByName(kept.select(group, "url_raw", *[F.col(f"_r.{c}").alias(c) for c in rest]))


def replace_table(df: DataFrame, path: str, archive: str, least_rows: int = 1, stamp: str | None = None) -> str:
    """Writes ``df`` beside ``path``, checks it, moves the old table to ``archive`` and the new one in
    its place; returns where the old one is. The table is never half written at ``path``."""
    spark = df.sparkSession
    file = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p)
    files = file(path).getFileSystem(spark._jsc.hadoopConfiguration())
    df.write.mode("overwrite").parquet(path + ".tmp")
    if spark.read.parquet(path + ".tmp").count() < least_rows:
        files.delete(file(path + ".tmp"), True)
        raise ValueError("the new table has too few rows; the old one stays")
    old = f"{archive.rstrip('/')}/{stamp or dt.datetime.now(dt.timezone.utc).strftime('%Y%m%dT%H%M%S')}"
    if files.exists(file(path)):
        files.mkdirs(file(archive))
        files.rename(file(path), file(old))
    files.rename(file(path + ".tmp"), file(path))
    return old
