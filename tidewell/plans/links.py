"""Queries of record linkage. New records are those of the weekly batches, the master is batch 0."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import linkage as k
from . import fragments as q
from .tables import read


def duplicate_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return k.duplicate_candidates(read(spark, sf_dir, "relevance_screening"))


def canonical_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return k.canonical_pairs(read(spark, sf_dir, "relevance_screening"), F.col("batch_id") == 0)


_FIELD = {
    "title": q.bibliographic("title"), "authors": q.bibliographic("authors"), "journal": q.bibliographic("journal"), "pages": q.pages("pages"),
    **{c: f"trim(coalesce(cast({c} AS VARCHAR), ''))" for c in ("year", "volume", "issue")},
}


def _star(old: str) -> str:
    keys = " UNION ALL ".join(
        f"SELECT rs, rid, old, {n} AS pass, {q.dedup_key(*[f'{f}_' for f in fields])} AS key FROM f" for n, (_, _, fields) in enumerate(k.PASSES)
    )
    return f"""
WITH f AS MATERIALIZED (SELECT record_sequence AS rs, record_id AS rid, {old} AS old, {', '.join(f'{v} AS {c}_' for c, v in _FIELD.items())} FROM relevance_screening),
k AS ({keys}),
c AS (SELECT *, first_value(rs) OVER w AS i, first_value(rid) OVER w AS ci, first_value(old) OVER w AS oi FROM k WHERE key IS NOT NULL
      WINDOW w AS (PARTITION BY pass, key ORDER BY old DESC, rs)),
p AS (SELECT i, rs AS j, any_value(ci) AS ci, any_value(rid) AS cj, any_value(oi) AS oi, any_value(old) AS oj, min(pass) AS pass FROM c WHERE i <> rs GROUP BY i, rs)
"""


_METHOD = "CASE pass " + " ".join(f"WHEN {n} THEN '{p[0]}'" for n, p in enumerate(k.PASSES)) + " END AS method, CASE WHEN pass < 2 THEN 'duplicate' ELSE 'review' END AS status"
DUPLICATE_CLASSES = _star("false") + f"SELECT cast(i AS BIGINT) AS record_i, cast(j AS BIGINT) AS record_j, {_METHOD} FROM p"
CANONICAL_RECORDS = _star("batch_id = 0") + f"SELECT cast(i AS BIGINT) AS record_i, cast(j AS BIGINT) AS record_j, {_METHOD}, oi <> oj AS cross_corpus, ci AS canonical_id, cj AS duplicate_id FROM p"


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    r = read(spark, sf_dir, "relevance_screening")
    return r.where("batch_id > 0"), r.where("batch_id = 0")


def link_new_vs_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return k.link_new_records(*_sides(spark, sf_dir))


def link_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = k.link_new_records(*_sides(spark, sf_dir))
    return linked.groupBy("duplicate_status", "duplicate_basis").agg(F.count("*").alias("records"))


_LINK = f"""
WITH keyed AS MATERIALIZED (SELECT record_sequence AS rw, record_id AS id, batch_id, year, {q.title_key('title')} AS tk, {q.doi_key('doi')} AS dk, {q.first_author('authors')} AS ak FROM relevance_screening),
k2 AS MATERIALIZED (SELECT *, left(tk, 24) AS pk, array_to_string(list_sort(list_distinct(string_split(tk, ' ')[1:8])), ' ') AS sk FROM keyed),
n AS (SELECT * FROM k2 WHERE batch_id > 0), m AS (SELECT * FROM k2 WHERE batch_id = 0),
ex AS (SELECT n.rw, m.rw AS mr, m.id AS mid, 1 AS pri, 1.0::DOUBLE AS sim, 'exact normalised title' AS basis FROM n JOIN m ON n.tk = m.tk WHERE n.tk <> ''),
dd AS (SELECT n.rw, m.rw AS mr, m.id AS mid, n.tk AS a, m.tk AS b, CASE WHEN n.tk = '' OR m.tk = '' THEN 0.0 ELSE jaro_winkler_similarity(n.tk, m.tk) END AS sim FROM n JOIN m ON n.dk = m.dk),
d AS (SELECT rw, mr, mid, CASE WHEN a = '' OR b = '' THEN 5 WHEN sim >= 0.9 THEN 2 ELSE 6 END AS pri, sim, 'doi' AS basis FROM dd),
o AS (SELECT * FROM n WHERE tk <> '' AND rw NOT IN (SELECT rw FROM ex)),
bl AS (SELECT o.rw, m.rw AS mr, m.id AS mid, 0 AS bk, o.tk AS a, m.tk AS b FROM o JOIN m ON o.year = m.year AND m.tk <> ''
 UNION ALL SELECT o.rw, m.rw, m.id, 1, o.tk, m.tk FROM o JOIN m ON o.ak = m.ak AND o.ak <> '' AND m.tk <> ''
 UNION ALL SELECT o.rw, m.rw, m.id, 2, o.tk, m.tk FROM o JOIN m ON o.pk = m.pk AND m.tk <> ''
 UNION ALL SELECT o.rw, m.rw, m.id, 3, o.tk, m.tk FROM o JOIN m ON o.sk = m.sk AND m.tk <> ''),
js AS (SELECT *, jaro_winkler_similarity(a, b) AS sim FROM bl WHERE least(length(a), length(b)) >= 0.8 * greatest(length(a), length(b))),
bf AS (SELECT * FROM js WHERE sim >= 0.965 QUALIFY row_number() OVER (PARTITION BY rw, mid ORDER BY bk, mr) = 1),
fz AS (SELECT rw, mr, mid, CASE WHEN sim >= 0.985 AND bk <> 0 THEN 3 ELSE 4 END AS pri, sim, CASE bk WHEN 0 THEN 'same year' WHEN 1 THEN 'same first author' WHEN 2 THEN 'same title prefix' ELSE 'same title tokens' END AS basis FROM bf),
best AS (SELECT * FROM (SELECT * FROM ex UNION ALL SELECT * FROM d UNION ALL SELECT * FROM fz) QUALIFY row_number() OVER (PARTITION BY rw ORDER BY pri, sim DESC, mr) = 1),
linked AS (SELECT cast(n.rw AS BIGINT) AS "row", CASE WHEN pri IN (1, 2) THEN 'duplicate' WHEN pri = 3 THEN 'probable_duplicate' WHEN pri IN (4, 5) THEN 'possible_duplicate' WHEN pri = 6 THEN 'doi_conflict_review' ELSE 'new' END AS duplicate_status,
  coalesce(basis, '') AS duplicate_basis, mid AS matched_id, cast(mr AS BIGINT) AS matched_row, round(sim, 6) AS similarity FROM n LEFT JOIN best ON n.rw = best.rw)
"""
LINK_NEW_VS_MASTER = _LINK + "SELECT * FROM linked"
LINK_STATUS_COUNTS = _LINK + "SELECT duplicate_status, duplicate_basis, count(*) AS records FROM linked GROUP BY ALL"


def collapse_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    return k.collapse_training(read(spark, sf_dir, "relevance_screening"))


COLLAPSE_TRAINING = f"""
SELECT duplicate_group, eligibility, record_sequence, ac AS abstract_chars FROM (
 SELECT {q.title_key('title')} AS duplicate_group, eligibility, record_sequence, cast(length(coalesce(abstract, '')) AS INTEGER) AS ac, length(coalesce(title, '')) AS tc FROM relevance_screening WHERE eligibility IS NOT NULL)
QUALIFY row_number() OVER (PARTITION BY duplicate_group, eligibility ORDER BY ac > 0 DESC, ac DESC, tc DESC, record_sequence) = 1"""


def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return k.stratified_split(read(spark, sf_dir, "relevance_screening"))


STRATIFIED_SPLIT = """
SELECT record_sequence, eligibility, row_number() OVER (PARTITION BY eligibility ORDER BY record_sequence) <= ceil(count(*) OVER (PARTITION BY eligibility) * 0.2) AS validation
FROM relevance_screening WHERE eligibility IS NOT NULL"""


def _identity():
    return k.identity_key(F.col("record_id"), F.col("doi"), F.col("title"))


_NORM = lambda c: f"nullif(lower({q.squish(f'coalesce({c}, {chr(39) * 2})')}), '')"
_ID = f"coalesce('lens:' || {_NORM('record_id')}, 'doi:' || {_NORM('doi')}, 'title:' || {_NORM('title')})"


def harvest_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = read(spark, sf_dir, "relevance_screening")
    return k.first_of_identity(r.select("record_sequence", "record_id", "doi", "title"), _identity(), "record_sequence").select("record_sequence", "record_id")


HARVEST_DEDUPE = f"""
SELECT record_sequence, record_id FROM (SELECT *, {_ID} AS key FROM relevance_screening)
QUALIFY key IS NULL OR row_number() OVER (PARTITION BY key ORDER BY record_sequence) = 1"""


def identity_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return k.duplicate_count(read(spark, sf_dir, "relevance_screening"), _identity())


IDENTITY_DUPLICATES = f"SELECT count(key) AS records, count(DISTINCT key) AS identities, count(key) - count(DISTINCT key) AS duplicates FROM (SELECT {_ID} AS key FROM relevance_screening)"

QUERIES = {
    "duplicate_classes": duplicate_classes, "canonical_records": canonical_records, "link_new_vs_master": link_new_vs_master, "link_status_counts": link_status_counts,
 "collapse_training": collapse_training, "stratified_split": stratified_split, "harvest_dedupe": harvest_dedupe,
    "identity_duplicates": identity_duplicates,
}
ORACLES = {
    "duplicate_classes": DUPLICATE_CLASSES, "canonical_records": CANONICAL_RECORDS, "link_new_vs_master": LINK_NEW_VS_MASTER, "link_status_counts": LINK_STATUS_COUNTS,
    "collapse_training": COLLAPSE_TRAINING, "stratified_split": STRATIFIED_SPLIT, "harvest_dedupe": HARVEST_DEDUPE,
    "identity_duplicates": IDENTITY_DUPLICATES,
}
