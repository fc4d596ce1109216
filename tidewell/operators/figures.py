"""Tables behind figures and the dashboard's document."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import values as v

#: The order in which species are shown, and the column names of ISO codes.
PREFERRED = ("Atlantic salmon", "Rainbow trout", "Chinook salmon", "Coho salmon", "Sockeye salmon", "Chum salmon", "Pink salmon", "Masu salmon")
ISO_ALPHA = ("iso3", "iso_3", "alpha3", "iso_alpha3", "iso3c", "iso_a3", "iso_a3c", "alpha_3")
ISO_NUMERIC = ("iso_numeric", "iso_num", "numeric", "numeric_code", "m49", "country_code_numeric", "iso_numeric_code", "iso_n3", "iso_n")


def ordered_species(counts: DataFrame, preferred: tuple[str, ...] = PREFERRED) -> DataFrame:
    """species, records, position: preferred names first in their order, others by records then name;
    unspecified species are left out."""
    place = F.array_position(F.array(*[F.lit(p) for p in preferred]), F.col("species"))
    rows = counts.where("species <> 'Unspecified species'").withColumn("_p", F.when(place > 0, place).otherwise(len(preferred) + 1))
    return rows.select("species", "records", F.row_number().over(Window.orderBy("_p", F.desc("records"), "species")).alias("position"))  # one row per species


def country_names(gazetteer: DataFrame) -> DataFrame:
    """iso3c, country_name: of the rows that name a country, the one of the greatest priority, then the first name."""
    rows = gazetteer.select(F.upper(F.trim("iso3c")).alias("iso3c"), F.trim("country_name").alias("country_name"), F.lower(F.trim("match_type")).alias("kind"), F.col("priority").try_cast("double").alias("priority"))
    rows = rows.where("iso3c <> '' and country_name <> '' and kind in ('country', 'country name')")
    return rows.groupBy("iso3c").agg(F.min_by("country_name", F.struct(-F.coalesce("priority", F.lit(float("-inf"))), "country_name")).alias("country_name"))


def on_the_map(counts: DataFrame, world: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(every country of the map with its records or 0, counted codes that the map lacks)."""
    return world.join(counts, "iso3", "left").withColumn("records", F.coalesce("records", F.lit(0))), counts.join(world, "iso3", "left_anti")


def final_points(dense: DataFrame, name: str = "topic") -> DataFrame:
    """Per topic its last year with records, and the label of that point."""
    rows = dense.where("records > 0").groupBy(name).agg(F.max_by(F.struct("year", "records"), "year").alias("p"))
    return rows.select(name, "p.year", "p.records", F.concat(F.lit("n = "), F.format_number("p.records", 0)).alias("label"))


def topics_of_interest(view: DataFrame, chosen: DataFrame) -> DataFrame:
    """Records per year and topic of the chosen paths (columns path, topic); a record counts once per topic."""
    rows = view.where("year is not null").select("record_id", "year", F.explode(F.array_distinct(F.transform("paths", lambda p: F.array_join(p, " > ")))).alias("path"))
    return rows.join(chosen, "path").groupBy("topic", "year").agg(F.count_distinct("record_id").alias("records"))


def growth_classes(dense: DataFrame, yearly: DataFrame, base: tuple[int, int], recent: tuple[int, int]) -> DataFrame:
    """Per topic the ratio of recent to base years, that of all records, and whether it grew faster."""
    mean = lambda span: F.avg(F.when(F.col("year").between(*span), F.col("records")))
    whole = yearly.agg((mean(recent) / mean(base)).alias("background_growth"))
    topics = dense.groupBy("topic").agg(mean(base).alias("baseline"), mean(recent).alias("recent_mean"))
    rows = topics.crossJoin(F.broadcast(whole)).withColumn("growth", F.try_divide("recent_mean", "baseline"))
    kind = F.when(F.col("growth").isNull(), "New theme; no baseline").when(F.col("growth") > F.col("background_growth"), "Faster than background").otherwise("Not faster than background")
    return rows.select("topic", F.round("baseline", 6).alias("baseline"), F.round("recent_mean", 6).alias("recent_mean"), F.round("growth", 6).alias("growth"), F.round("background_growth", 6).alias("background_growth"), kind.alias("classification"))


def shares_of_parent(tree: DataFrame) -> DataFrame:
    """Nodes of the topic tree with their share of the parent's records and their place among its children."""
    parents = tree.select(F.col("prefix").alias("parent"), F.col("records").alias("_of"))
    place = F.row_number().over(Window.partitionBy("parent").orderBy(F.desc("records"), "name"))
    return tree.join(parents, "parent", "left").select("prefix", "depth", "parent", "name", "records", F.round(F.col("records") / F.col("_of"), 6).alias("share"), place.alias("place"))


def branch_species(counts: DataFrame, tree: DataFrame, branch: str) -> DataFrame:
    """Records per child of a branch ("" for the roots) and species."""
    children = tree.where(F.coalesce("parent", F.lit("")) == branch).select("prefix", "name")
    return counts.join(children, "prefix").select("name", "species", "records")


def group_ends(bars: DataFrame) -> DataFrame:
    """Per level_1 and level_2 the number of bars and where its group ends among those of level_1."""
    groups = bars.groupBy("level_1", "level_2", "parent_index").agg(F.count("*").alias("bars"))
    upto = Window.partitionBy("level_1").orderBy("parent_index").rowsBetween(Window.unboundedPreceding, 0)
    return groups.select("level_1", "level_2", "bars", F.sum("bars").over(upto).alias("end"))


def with_citations(records: DataFrame, master: DataFrame) -> DataFrame:
    """Records with authors, journal, volume, pages and url of the master, empty where it has none."""
    told = master.select("record_id", *[F.coalesce(F.trim(c), F.lit("")).alias(c) for c in ("authors", "journal", "volume", "pages", "url_raw")])
    fill = {c: F.coalesce(c, F.lit("")) for c in ("authors", "journal", "volume", "pages", "url_raw")}
    return records.join(told, "record_id", "left").withColumns(fill)


def grouped_records(records: DataFrame, groups: DataFrame, group: str) -> DataFrame:
    """What is known of a group brought back to its records; a group with several rows multiplies them."""
    return records.join(groups, group, "left")


def topic_level_columns(columns: list[str]) -> list[str]:
    """Columns named topic ... level N, by N."""
    found = [(int(m[1]), c) for c in columns if (m := re.search(r"(?i)topic.*level\D*(\d+)", c))]
    return [c for _, c in sorted(found)]


def iso_numbers(table: DataFrame) -> DataFrame:
    """iso3 and its number, three digits, from a table that has both under any of their usual names."""
    low = {c.lower(): c for c in table.columns}
    pick = lambda names: next((low[n] for n in names if n in low), None)
    alpha, number = pick(ISO_ALPHA), pick(ISO_NUMERIC)
    if alpha is None or number is None:
        return table.sparkSession.createDataFrame([], "iso3 string, iso_numeric string")
    code, digits = F.upper(F.trim(alpha)), F.trim(F.col(number).cast("string"))
    return table.select(code.alias("iso3"), F.lpad(digits, 3, "0").alias("iso_numeric")).where((code != "") & (digits != "")).distinct()


def search_total(baseline: Column, runs: DataFrame, results: str) -> DataFrame:
    """One row: the baseline's search results and those of all runs; NULL if no number is known."""
    number = lambda c: c.try_cast("double").try_cast("bigint")
    summed = runs.agg(F.sum(number(F.col(results))).alias("_s"))
    return summed.select(F.when(F.col("_s").isNotNull() | baseline.isNotNull(), F.coalesce("_s", F.lit(0)) + F.coalesce(number(baseline), F.lit(0))).alias("search_results"))


def document_rows(view: DataFrame) -> DataFrame:
    """record_id and the record as compact JSON, as the dashboard's document holds it."""
    levels = [v.level_values(F.col("paths"), i).alias(f"topic_level_{i + 1}") for i in range(3)]
    shown = F.struct("record_id", "year", "title", "species", F.col("iso3").alias("countries"), F.col("paths").alias("topic_paths"), *levels)
    return view.select("record_id", F.to_json(shown).alias("document"))
