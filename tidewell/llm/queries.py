"""Queries of the corpus operators, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import abuse, canonical, contamination, format_duplicates, history, markup, mixing, names, survivorship


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names.variant_pairs(_table(spark, sf_dir, "relevance_screening"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_duplicates.copies_of_records(_table(spark, sf_dir, "relevance_screening"))


def p2_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_duplicates.collapsed_records(_table(spark, sf_dir, "relevance_screening"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survivorship.surviving_members(_table(spark, sf_dir, "merge_master_update"))


def p3_trusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survivorship.trusted_records(_table(spark, sf_dir, "merge_master_update"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.repeated_rows(_table(spark, sf_dir, "relevance_screening"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markup.marked_fields(_table(spark, sf_dir, "relevance_screening"))


def p6_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markup.cleaned(markup.record_texts(_table(spark, sf_dir, "relevance_screening")), ["record_sequence", "field_name"])


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical.mapped_species(_table(spark, sf_dir, "build_dashboard"), _table(spark, sf_dir, "species_dictionary"))


def p7_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = canonical.typed_species(_table(spark, sf_dir, "build_dashboard"))
    return canonical.all_entries(values, _table(spark, sf_dir, "species_dictionary"), "species_id", ["preferred_name", "synonym", "scientific_name"], "species_value")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "mix_targets"))[0]


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "mix_targets"))[1]


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return abuse.abusive_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def p10_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return abuse.rates(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found,
    "p2_found": p2_found,
    "p2_copies": p2_copies,
    "p3_found": p3_found,
    "p3_trusted": p3_trusted,
    "p4_found": p4_found,
    "p6_found": p6_found,
    "p6_cleaned": p6_cleaned,
    "p7_found": p7_found,
    "p7_entries": p7_entries,
    "p8_found": p8_found,
    "p9_mix": p9_mix,
    "p9_shares": p9_shares,
    "p10_found": p10_found,
    "p10_rates": p10_rates,
}


def _doi(x: str) -> str:
    bare = f"regexp_replace(replace(lower({x}), '%2f', '/'), '^[\\s\\p{{Z}}]*(?:https?:/+)?(?:(?:dx\\.|www\\.)?doi\\.org/+)?(?:doi[\\s\\p{{Z}}]*:?[\\s\\p{{Z}}]*)?', '')"
    return f"nullif(regexp_extract({bare}, '^(10\\.\\d{{3,9}}/[^\\s\\p{{Z}}]*[\\p{{L}}\\p{{N}})])[\\p{{P}}\\s\\p{{Z}}]*$', 1), '')"


_PLACEHOLDER = "lower(trim(t)) IN ('na', 'n/a', '-', 'nan', 'null', 'none', '')"
_COPIES = f"""
WITH a AS (SELECT record_sequence, title, doi, {_doi('title')} AS dt, {_doi('doi')} AS dd FROM relevance_screening),
b AS (SELECT record_sequence, CASE WHEN dt IS NOT NULL AND dd IS NULL THEN doi ELSE title END AS t, CASE WHEN dt IS NOT NULL AND dd IS NULL THEN dt ELSE dd END AS d FROM a),
c AS (SELECT record_sequence, coalesce(CASE WHEN NOT ({_PLACEHOLDER}) THEN regexp_replace(lower(t), '[^\\p{{L}}\\p{{N}}\\p{{M}}&]+', '', 'g') END, '') AS k, coalesce(d, '') AS d FROM b),
g AS (SELECT record_sequence, min(record_sequence) OVER (PARTITION BY k, d) AS first, count(*) OVER (PARTITION BY k, d) AS n FROM c WHERE k <> '' OR d <> '')
"""
_SURVIVORS = """
WITH l AS (SELECT duplicate_group AS g, record_id AS m, updated_at AS u, source, unnest(['pages', 'url_raw', 'doi']) AS f, trim(unnest([pages, url_raw, doi])) AS v FROM merge_master_update WHERE duplicate_group IS NOT NULL),
k AS (SELECT *, CASE f WHEN 'doi' THEN regexp_replace(lower(v), '^https?://(?:dx\\.)?doi\\.org/', '') ELSE v END AS c, CASE f
  WHEN 'pages' THEN regexp_matches(v, '^(?:(?:pp?\\.?\\s*)?[A-Za-z]{0,3}\\d+\\s*[-–—−]+\\s*[A-Za-z]{0,3}\\d+|[eE]\\d+)$')
  WHEN 'url_raw' THEN regexp_matches(v, '^[hH][tT][tT][pP][sS]?://[^\\s/?#]+\\.[^\\s/?#]+/[^\\s]*[^\\s./…]/?$') AND NOT regexp_matches(v, '(?:\\.\\.\\.|…)$')
  ELSE regexp_matches(v, '^(?:[hH][tT][tT][pP][sS]?://(?:[dD][xX]\\.)?[dD][oO][iI]\\.[oO][rR][gG]/)?10\\.\\d{4,9}/\\S*[^\\s.…]$') AND NOT regexp_matches(v, '(?:\\.\\.\\.|…)$') AND length(replace(v, '(', '')) = length(replace(v, ')', '')) END AS ok FROM l WHERE v IS NOT NULL AND v <> ''),
w AS (SELECT * FROM k a WHERE ok AND NOT EXISTS (SELECT 1 FROM k b WHERE b.g = a.g AND b.f = a.f AND length(b.c) > length(a.c) AND starts_with(b.c, a.c)))
"""
_TRUSTED = "max(v) FILTER (f = '{0}' AND n = 1) AS {0}"
ORACLES: dict[str, str] = {
    "p3_found": _SURVIVORS + "SELECT g AS duplicate_group, f AS field_name, m AS record_id FROM w QUALIFY row_number() OVER (PARTITION BY g, f ORDER BY u DESC NULLS LAST, v DESC, m DESC) = 1",
    "p3_trusted": _SURVIVORS + f"SELECT g AS duplicate_group, {', '.join(_TRUSTED.format(f) for f in ('pages', 'url_raw', 'doi'))} FROM (SELECT *, row_number() OVER (PARTITION BY g, f ORDER BY CASE source WHEN 'lens_api' THEN 3 WHEN 'manual_ris' THEN 2 WHEN 'backfile' THEN 1 ELSE 0 END DESC, u DESC NULLS LAST, v DESC, m DESC) AS n FROM w) GROUP BY g",
    "p2_found": _COPIES + "SELECT first AS first_sequence, record_sequence AS copy_sequence FROM g WHERE record_sequence > first",
    "p2_copies": _COPIES + "SELECT DISTINCT first AS first_sequence, n AS copies FROM g",
}
