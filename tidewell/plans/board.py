"""Queries of the dashboard and the figures, over the master table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import values as fv
from ..operators import dashboard as d
from ..operators import trends as tr
from . import fragments as q
from .tables import read

BASE, RECENT, START = (2010, 2014), (2021, 2025), 2010


def _split(x: str) -> str:
    """SQL of split_values."""
    bare = f"trim(coalesce({x}, ''))"
    json = f"CASE WHEN starts_with({bare}, '[') THEN TRY(from_json({bare}, '[\"VARCHAR\"]')) END"
    parts = f"coalesce({json}, regexp_split_to_array({bare}, '\\s*(?:;|\\||→|>>)\\s*'))"
    return f"list_filter(list_transform({parts}, lambda x: {q.label('x')}), lambda x: x IS NOT NULL)"


def _species(x: str) -> str:
    low = f"lower({q.squish(x)})"
    return (
        f"CASE WHEN {low} IN ({q.BAD}) OR (contains({low}, 'unspecified') AND regexp_matches({low}, 'salmon|salmonid|species')) THEN 'Unspecified species' "
        f"WHEN {low} IN ('rainbow salmon', 'rainbow_trout', 'rainbow trout') THEN 'Rainbow trout' ELSE {q.squish(x)} END"
    )


_LEVELS = f"list_filter(list_transform(regexp_split_to_array(p, '\\s*(?:→|>>|/|>)\\s*'), lambda y: {q.label('y')}), lambda y: y IS NOT NULL)"
_PATHS = (
    f"list_filter(list_transform(list_filter(regexp_split_to_array(coalesce(topic_hierarchy_paths, ''), '\\s*;\\s*'), lambda p: ({q.label('p')}) IS NOT NULL), "
    f"lambda p: {_LEVELS}), lambda a: len(a) > 0)"
)
VIEW = f"""
WITH v0 AS (SELECT record_id, try_cast(try_cast(year AS DOUBLE) AS INTEGER) AS year, title, abstract,
  list_transform({_split('final_species')}, lambda s: {_species('s')}) AS sp, {_split('final_primary_country_iso3c')} AS iso3, {_PATHS} AS paths FROM merge_master_update),
v AS MATERIALIZED (SELECT *, CASE WHEN len(sp) = 0 THEN ['Unspecified species'] ELSE sp END AS species FROM v0),
pt AS MATERIALIZED (SELECT record_id, year, species, unnest(paths) AS p FROM v),
px AS (SELECT record_id, species, p, unnest(range(1, len(p) + 1)) AS i FROM pt),
pre AS MATERIALIZED (SELECT record_id, species, array_to_string(p[1:i], ' > ') AS prefix, cast(i AS INTEGER) AS depth, p[i] AS name, CASE WHEN i > 1 THEN array_to_string(p[1:i - 1], ' > ') END AS parent FROM px),
ctry AS (SELECT record_id, species, CASE c WHEN 'SJM' THEN 'NOR' WHEN 'JEY' THEN 'GBR' WHEN 'IMN' THEN 'GBR' WHEN 'NONE' THEN NULL ELSE c END AS iso3
  FROM (SELECT record_id, species, upper(unnest(iso3)) AS c FROM v)),
onto AS (SELECT DISTINCT unnest([level_1, level_1 || ' > ' || level_2, level_1 || ' > ' || level_2 || ' > ' || level_3]) AS prefix FROM topic_ontology)
"""
_N = "count(DISTINCT record_id) AS records"


def _view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.record_view(read(spark, sf_dir, "merge_master_update"))


def _of(function, *more: str):
    """A query from an operator of the record view and further tables."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(_view(spark, sf_dir), *[read(spark, sf_dir, m) for m in more])

    return run


def search_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = d.search(_view(spark, sf_dir), country="NOR", topic="Fish health", text="changes", page=2, size=3)
    return page.select("record_id", "title", "year", F.array_join("species", "; ").alias("species"))


def search_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = d.matches(_view(spark, sf_dir), country="NOR", topic="Fish health", text="changes")
    return found.agg(F.count("*").alias("found"), F.greatest(F.lit(1), F.ceil(F.count("*") / 25)).alias("pages"))


_FOUND = """f AS (SELECT * FROM v WHERE list_contains(iso3, 'NOR') AND len(list_filter(paths, lambda p: array_to_string(p, ' > ') = 'Fish health' OR starts_with(array_to_string(p, ' > '), 'Fish health > '))) > 0
  AND contains(lower(concat_ws(' ', title, abstract, cast(year AS VARCHAR), array_to_string(species, ' '), array_to_string(iso3, ' '))), 'changes'))"""


def normalised_species_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = read(spark, sf_dir, "build_dashboard")
    new = F.array_join(F.array_distinct(F.transform(fv.split_values(F.col("species")), lambda s: fv.canonical_species(s))), "; ")
    return b.select("record_id", F.coalesce("species", F.lit("")).alias("old"), new.alias("new")).where("old <> new")


def without_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = read(spark, sf_dir, "merge_master_update")
    kept = fv.drop_values(F.col("final_primary_country_iso3c"), ["FRO", "ISL"])
    return m.select("record_id", kept.alias("countries")).where(kept != F.array_join(fv.split_values(F.col("final_primary_country_iso3c")), "; "))


def topic_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = prefix_options(read(spark, sf_dir, "topic_ontology"))
    return tree


def prefix_options(ontology: DataFrame) -> DataFrame:
    """Paths of the ontology grouped under their first level."""
    return d.ontology_prefixes(ontology).groupBy(F.get(F.split("prefix", " > "), F.lit(0)).alias("root")).agg(F.array_join(F.array_sort(F.collect_list("prefix")), "|").alias("options"))


QUERIES = {
    "species_counts": _of(d.species_counts), "country_counts": _of(d.country_counts), "country_species_counts": _of(d.country_species_counts),
    "topic_tree": _of(d.topic_tree), "topic_level_counts": _of(d.topic_level_counts), "species_topic_counts": _of(d.species_topic_counts),
    "terminal_topics": _of(d.terminal_topics), "finest_topics": _of(d.finest_topics), "topic_rollup": _of(d.topic_rollup), "topic_coverage": _of(d.topic_coverage),
    "valid_paths": _of(d.valid_paths, "topic_ontology"), "ontology_audit": _of(d.ontology_audit, "topic_ontology"), "level_pairs": _of(d.level_pairs),
    "unmapped_paths": _of(d.unmapped_paths, "topic_ontology"),
    "search_records": search_records, "search_count": search_count, "normalised_species_cells": normalised_species_cells, "without_countries": without_countries,
    "topic_options": topic_options,
    "year_species": _of(lambda v: tr.by_year(v, "species", "species")), "year_topics": _of(tr.year_topics),
    "top_countries": _of(lambda v: tr.top_values(d.country_counts(v), "iso3", 20)),
    "top_country_species": _of(lambda v: d.country_species_counts(v).join(tr.top_values(d.country_counts(v), "iso3", 20).select("iso3"), "iso3", "left_semi")),
    "hierarchy_bars": _of(tr.hierarchy_bars), "background_trend": _of(lambda v: tr.background_trend(v, START, BASE)), "emerging_topics": _of(lambda v: tr.emerging_topics(v, BASE, RECENT)),
    "dense_year_topics": _of(lambda v: tr.dense_years(tr.year_topics(v), "topic")), "country_classes": _of(lambda v: d.count_classes(d.country_counts(v))),
}
_COUNTRIES = f"cc AS (SELECT iso3, {_N} FROM ctry WHERE iso3 IS NOT NULL GROUP BY iso3)"
_CS = f"cs AS (SELECT iso3, species, {_N} FROM (SELECT record_id, iso3, unnest(species) AS species FROM ctry WHERE iso3 IS NOT NULL) GROUP BY ALL)"
_YT = f"yt AS (SELECT year, p[1] AS topic, {_N} FROM pt WHERE year IS NOT NULL GROUP BY ALL)"
_YEARLY = f"yr AS (SELECT year, {_N} FROM v WHERE year IS NOT NULL GROUP BY year)"
_GRID = "g AS (SELECT t.topic, y.year, coalesce(yt.records, 0) AS records FROM (SELECT DISTINCT topic FROM yt) t CROSS JOIN (SELECT unnest(range(min(year), max(year) + 1)) AS year FROM yt) y LEFT JOIN yt ON yt.topic = t.topic AND yt.year = y.year)"
ORACLES = {
    "species_counts": VIEW + f"SELECT species, {_N} FROM (SELECT record_id, unnest(species) AS species FROM v) GROUP BY species",
    "country_counts": VIEW + f", {_COUNTRIES} SELECT * FROM cc",
    "country_species_counts": VIEW + f", {_CS} SELECT * FROM cs",
    "topic_tree": VIEW + f"SELECT prefix, depth, parent, name, {_N} FROM pre GROUP BY ALL",
    "topic_level_counts": VIEW + f"SELECT depth, name, {_N} FROM pre GROUP BY ALL",
    "species_topic_counts": VIEW + f"SELECT species, prefix, {_N} FROM (SELECT record_id, prefix, unnest(species) AS species FROM pre) GROUP BY ALL",
    "terminal_topics": VIEW + f"SELECT p[-1] AS topic, {_N} FROM pt GROUP BY ALL",
    "finest_topics": VIEW + f"SELECT p[-1] AS topic, {_N} FROM (SELECT *, max(len(p)) OVER (PARTITION BY record_id) AS deep FROM pt) WHERE len(p) = deep GROUP BY ALL",
    "topic_rollup": VIEW + f"SELECT p[1] AS level_1, p[2] AS level_2, p[3] AS level_3, {_N}, cast(grouping(p[1], p[2], p[3]) AS INTEGER) AS grouping FROM pt GROUP BY ROLLUP (p[1], p[2], p[3])",
    "topic_coverage": VIEW + "SELECT count(*) AS records, count(*) FILTER (len(paths) = 0) AS without_topics, cast(sum(len(paths)) AS BIGINT) AS assignments, (SELECT count(DISTINCT array_to_string(p, ' > ')) FROM pt) AS unique_paths FROM v",
    "valid_paths": VIEW + ", dp AS (SELECT record_id, array_to_string(p, ' > ') AS path, min(i) AS i FROM (SELECT record_id, paths[i] AS p, i FROM (SELECT record_id, paths, unnest(range(1, len(paths) + 1)) AS i FROM v)) GROUP BY ALL), "
    "np AS (SELECT record_id, path, cast(row_number() OVER (PARTITION BY record_id ORDER BY i) AS INTEGER) AS position FROM dp) SELECT np.* FROM np WHERE path IN (SELECT prefix FROM onto)",
    "ontology_audit": VIEW + "SELECT cast(len(p) AS INTEGER) AS depth, count(*) AS assignments, count(DISTINCT x) AS unique_paths, count(DISTINCT x) FILTER (prefix IS NULL) AS unmapped_paths, count(DISTINCT record_id) FILTER (prefix IS NULL) AS unmapped_records "
    "FROM (SELECT *, array_to_string(p, ' > ') AS x FROM pt) LEFT JOIN onto ON x = prefix GROUP BY 1",
    "unmapped_paths": VIEW + f"SELECT x AS path, {_N}, count(*) AS assignments FROM (SELECT record_id, array_to_string(p, ' > ') AS x FROM pt) WHERE x NOT IN (SELECT prefix FROM onto) GROUP BY x ORDER BY assignments DESC, x LIMIT 20",
    "level_pairs": VIEW + f"SELECT root, parent, child, {_N} FROM (SELECT record_id, p[1] AS root, p[i - 1] AS parent, p[i] AS child FROM (SELECT record_id, p, unnest(range(2, least(len(p), 9) + 1)) AS i FROM pt)) GROUP BY ALL",
    "search_records": VIEW + f", {_FOUND} SELECT record_id, title, year, array_to_string(species, '; ') AS species FROM f ORDER BY trim(coalesce(title, '')) = '', lower(title) NULLS LAST, record_id LIMIT 3 OFFSET 3",
    "search_count": VIEW + f", {_FOUND} SELECT count(*) AS found, cast(greatest(1, ceil(count(*) / 25)) AS BIGINT) AS pages FROM f",
    "normalised_species_cells": f"SELECT record_id, old, new FROM (SELECT record_id, old, coalesce(array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), '; '), '') AS new FROM (SELECT record_id, coalesce(species, '') AS old, list_transform({_split('species')}, lambda s: {_species('s')}) AS l FROM build_dashboard)) WHERE old <> new",
    "without_countries": f"SELECT record_id, countries FROM (SELECT record_id, array_to_string(list_filter({_split('final_primary_country_iso3c')}, lambda z: lower(z) NOT IN ('fro', 'isl')), '; ') AS countries, array_to_string({_split('final_primary_country_iso3c')}, '; ') AS old FROM merge_master_update) WHERE countries <> old",
    "topic_options": VIEW + "SELECT split_part(prefix, ' > ', 1) AS root, string_agg(prefix, '|' ORDER BY prefix) AS options FROM onto GROUP BY 1",
    "year_species": VIEW + f"SELECT year, species, {_N} FROM (SELECT record_id, year, unnest(species) AS species FROM v WHERE year IS NOT NULL) GROUP BY ALL",
    "year_topics": VIEW + f", {_YT} SELECT * FROM yt",
    "top_countries": VIEW + f", {_COUNTRIES} SELECT * FROM cc ORDER BY records DESC, iso3 LIMIT 20",
    "top_country_species": VIEW + f", {_COUNTRIES}, {_CS} SELECT * FROM cs WHERE iso3 IN (SELECT iso3 FROM cc ORDER BY records DESC, iso3 LIMIT 20)",
    "hierarchy_bars": VIEW + "SELECT *, cast(dense_rank() OVER (PARTITION BY level_1 ORDER BY parent_total DESC, level_2) AS INTEGER) AS parent_index FROM (SELECT *, cast(sum(assignments) OVER (PARTITION BY level_1, level_2) AS BIGINT) AS parent_total FROM "
    "(SELECT coalesce(p[1], 'General') AS level_1, coalesce(p[2], 'General') AS level_2, coalesce(p[3], 'General') AS level_3, count(*) AS assignments FROM pt GROUP BY ALL))",
    "background_trend": VIEW + f", {_YEARLY}, ft AS (SELECT regr_slope(ln(records), year) AS s, regr_intercept(ln(records), year) AS c FROM yr WHERE year >= {START} AND records > 0), x AS (SELECT year, records, exp(c + s * year) AS f FROM yr, ft) "
    f"SELECT year, records, round(f, 6) AS fitted, round(f / (SELECT avg(f) FROM x WHERE year BETWEEN {BASE[0]} AND {BASE[1]}), 6) AS index FROM x",
    "emerging_topics": VIEW + f", {_YT}, {_YEARLY}, {_GRID}, tp AS (SELECT topic, avg(records) FILTER (year BETWEEN {BASE[0]} AND {BASE[1]}) AS b, avg(records) FILTER (year BETWEEN {RECENT[0]} AND {RECENT[1]}) AS r, "
    f"cast(min(year) FILTER (records > 0) AS INTEGER) AS first_year, cast(max(year) FILTER (records > 0) AS INTEGER) AS last_year FROM g GROUP BY topic), bg AS (SELECT avg(records) FILTER (year BETWEEN {RECENT[0]} AND {RECENT[1]}) / avg(records) FILTER (year BETWEEN {BASE[0]} AND {BASE[1]}) AS k FROM yr) "
    "SELECT topic, round(b, 6) AS baseline, round(r, 6) AS recent, first_year, last_year, round(r / nullif(b, 0), 6) AS growth, round(r / nullif(b, 0) / k, 6) AS relative, "
    "CASE WHEN r / nullif(b, 0) IS NULL THEN 'new' WHEN r / nullif(b, 0) / k >= 1.25 THEN 'faster' WHEN r / nullif(b, 0) / k <= 0.8 THEN 'slower' ELSE 'as background' END AS class FROM tp, bg",
    "dense_year_topics": VIEW + f", {_YT}, {_GRID} SELECT topic, cast(year AS INTEGER) AS year, records FROM g",
}
