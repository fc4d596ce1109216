"""Queries of the cleaning and keying functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t
from . import fragments as q
from .tables import read


def clean_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = read(spark, sf_dir, "relevance_screening")
    title, abstract, doi = t.clean_html(F.col("title")), t.clean_html(F.col("abstract")), t.valid_doi(F.col("doi"))
    return r.select(
        "record_sequence", t.clean_na(F.col("record_id")).alias("record_id"), title.alias("title"), abstract.alias("abstract"), doi.alias("doi"),
        t.first_year(F.col("year")).alias("year"), t.alphanumeric(title).alias("title_normalised"), t.word_count(abstract).alias("abstract_word_count"),
        t.word_count(title).alias("title_word_count"), title.isNotNull().alias("has_title"), abstract.isNotNull().alias("has_abstract"),
        doi.isNotNull().alias("has_valid_doi"), F.col("record_id").isNull().alias("parser_missing_id"),
    )


CLEAN_RECORDS = f"""
WITH c AS (SELECT record_sequence, record_id, {q.clean_html('title')} AS t, {q.clean_html('abstract')} AS a, {q.valid_doi('doi')} AS d, year FROM relevance_screening)
SELECT record_sequence, {q.clean_na('record_id')} AS record_id, t AS title, a AS abstract, d AS doi, {q.year('year')} AS year,
       {q.alphanumeric('t')} AS title_normalised, cast(len(regexp_extract_all(coalesce(a, ''), '\\S+')) AS INTEGER) AS abstract_word_count,
       cast(len(regexp_extract_all(coalesce(t, ''), '\\S+')) AS INTEGER) AS title_word_count, t IS NOT NULL AS has_title, a IS NOT NULL AS has_abstract,
       d IS NOT NULL AS has_valid_doi, record_id IS NULL AS parser_missing_id
FROM c"""


def screening_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = read(spark, sf_dir, "relevance_screening")
    key = t.screening_title(F.col("title"))
    return r.select(
        "record_sequence", key.alias("title_key"), t.screening_doi(F.col("doi")).alias("doi_key"), t.first_author_key(F.col("authors")).alias("first_author_key"),
        t.screening_text(F.col("title"), F.col("abstract")).alias("screening_text"), (F.coalesce("abstract", F.lit("")) != "").alias("has_abstract"),
        F.substring(key, 1, 24).alias("title_prefix"), t.token_key(key).alias("title_token_key"),
    )


SCREENING_KEYS = f"""
WITH k AS (SELECT *, {q.title_key('title')} AS tk FROM relevance_screening)
SELECT record_sequence, tk AS title_key, {q.doi_key('doi')} AS doi_key, {q.first_author('authors')} AS first_author_key,
       {q.squish("'TITLE_TITLE ' || coalesce(title, '') || ' TITLE_TITLE ' || coalesce(title, '') || ' ABSTRACT ' || coalesce(abstract, '')")} AS screening_text,
       coalesce(abstract, '') <> '' AS has_abstract, left(tk, 24) AS title_prefix,
       array_to_string(list_sort(list_distinct(string_split(tk, ' ')[1:8])), ' ') AS title_token_key
FROM k"""


def doi_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = read(spark, sf_dir, "merge_master_update")
    d = F.col("doi")
    return r.select(
        "record_id", t.valid_doi(d).alias("valid"), t.screening_doi(d).alias("screening"), t.lookup_doi(d).alias("lookup"), t.cited_doi(d).alias("cited")
    )


DOI_FORMS = f"""
SELECT record_id, {q.valid_doi('doi')} AS valid, {q.doi_key('doi')} AS screening, coalesce({q.doi_key('doi')}, '') AS lookup,
       trim(regexp_replace(doi, '(?i)^https?://(?:dx\\.)?doi\\.org/', '')) AS cited
FROM merge_master_update"""


def publication_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = read(spark, sf_dir, "relevance_screening")
    return r.select("record_sequence", t.notice_type(F.col("title")).alias("notice_type")).where("notice_type is not null")


PUBLICATION_NOTICES = f"SELECT record_sequence, {q.notice('title')} AS notice_type FROM relevance_screening WHERE {q.notice('title')} IS NOT NULL"


def dedup_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = read(spark, sf_dir, "merge_master_update")
    title, authors, journal = (t.bibliographic_text(F.col(c)) for c in ("title", "authors", "journal"))
    pages, year = t.page_key(F.col("pages")), F.coalesce(F.col("year"), F.lit(""))
    return r.select(
        "record_id", title.alias("title"), authors.alias("authors"), journal.alias("journal"), pages.alias("pages"),
        t.dedup_key(authors, year, title, journal).alias("key_a"), t.dedup_key(authors, year, title, pages).alias("key_b"),
    )


_DEDUP = {c: q.bibliographic(c) for c in ("title", "authors", "journal")} | {"pages": q.pages("pages"), "year": "coalesce(year, '')"}
DEDUP_FIELDS = f"""
WITH d AS (SELECT record_id, {', '.join(f'{v} AS {k}_' for k, v in _DEDUP.items())} FROM merge_master_update)
SELECT record_id, title_ AS title, authors_ AS authors, journal_ AS journal, pages_ AS pages,
       {q.dedup_key('authors_', 'year_', 'title_', 'journal_')} AS key_a, {q.dedup_key('authors_', 'year_', 'title_', 'pages_')} AS key_b
FROM d"""


def record_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = read(spark, sf_dir, "merge_master_update")
    doi, url, search = t.valid_doi(F.col("doi")), t.lens_url(F.col("url_raw")), t.scholar_query(F.col("title"))
    return r.select(
        "record_id", t.short_abstract(F.col("abstract")).alias("abstract"), t.author_line(F.col("authors")).alias("authors"),
        t.publication_line(F.col("journal"), F.col("volume"), F.col("pages")).alias("publication"),
        F.coalesce(F.concat(F.lit("https://doi.org/"), doi), F.nullif(url, F.lit("")), F.concat(F.lit("scholar?q="), search)).alias("url"),
        F.col("year").try_cast("double").try_cast("int").alias("year"),
    )


RECORD_LINES = f"""
WITH a AS (SELECT *, list_filter(list_transform(regexp_split_to_array(coalesce(authors, ''), '[;|]|\\s+and\\s+'), lambda x: trim(x)), lambda x: x <> '') AS names,
       CASE WHEN regexp_matches(trim(coalesce(url_raw, '')), '^https?://') THEN trim(url_raw)
            WHEN regexp_matches(trim(coalesce(url_raw, '')), '^lens-') THEN 'https://lens.org/' || regexp_replace(trim(url_raw), '^lens-', '') ELSE '' END AS u
  FROM merge_master_update)
SELECT record_id, CASE WHEN length(abstract) <= 220 THEN abstract ELSE regexp_replace(left(abstract, 221), '\\s+\\S*$', '') || '…' END AS abstract,
       CASE WHEN len(names) <= 2 THEN array_to_string(names, ' and ') ELSE names[1] || ' et al.' END AS authors,
       concat_ws(' · ', nullif(trim(journal), ''), nullif(trim(volume), ''), 'pp. ' || nullif(trim(pages), '')) AS publication,
       coalesce('https://doi.org/' || ({q.valid_doi('doi')}), nullif(u, ''),
                'scholar?q=' || regexp_replace(trim(regexp_replace(title, '[^\\p{{L}}\\p{{N}}\\s]', '', 'g')), '\\s+', '+', 'g')) AS url,
       try_cast(try_cast(year AS DOUBLE) AS INTEGER) AS year
FROM a"""


def authors_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = read(spark, sf_dir, "relevance_screening").where("authors is not null")
    return r.select("record_sequence", "record_id", F.posexplode(F.split("authors", r"\s*\|\s*")).alias("p", "author")).select(
        "record_sequence", "record_id", F.trim("author").alias("author"), (F.col("p") + 1).alias("author_order")
    )


AUTHORS_LONG = """
SELECT record_sequence, record_id, trim(names[i]) AS author, cast(i AS INTEGER) AS author_order
FROM (SELECT record_sequence, record_id, names, unnest(range(1, len(names) + 1)) AS i
      FROM (SELECT record_sequence, record_id, regexp_split_to_array(authors, '\\s*\\|\\s*') AS names FROM relevance_screening WHERE authors IS NOT NULL))"""


def short_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "topic_ontology")
    return o.select("path_id", t.shorten_terms(F.col("supporting_terms_from_old_ontology"), 3).alias("terms"))


SHORT_TERMS = """
WITH p AS (SELECT path_id, parts, unnest(range(1, len(parts) + 1)) AS i
           FROM (SELECT path_id, list_filter(regexp_split_to_array(coalesce(supporting_terms_from_old_ontology, ''), ';\\s*'), lambda x: trim(x) <> '') AS parts FROM topic_ontology)),
f AS (SELECT path_id, min(i) AS i, arg_min(parts[i], i) AS term FROM p GROUP BY path_id, lower(parts[i])),
k AS (SELECT path_id, term, i, row_number() OVER (PARTITION BY path_id ORDER BY i) AS n FROM f)
SELECT o.path_id, coalesce(string_agg(term, '; ' ORDER BY i), '') AS terms FROM topic_ontology o LEFT JOIN k ON o.path_id = k.path_id AND n <= 3 GROUP BY o.path_id"""

QUERIES = {
    "clean_records": clean_records, "screening_keys": screening_keys, "doi_forms": doi_forms, "publication_notices": publication_notices,
    "dedup_fields": dedup_fields, "record_lines": record_lines, "authors_long": authors_long, "short_terms": short_terms,
}
ORACLES = {
    "clean_records": CLEAN_RECORDS, "screening_keys": SCREENING_KEYS, "doi_forms": DOI_FORMS, "publication_notices": PUBLICATION_NOTICES,
    "dedup_fields": DEDUP_FIELDS, "record_lines": RECORD_LINES, "authors_long": AUTHORS_LONG, "short_terms": SHORT_TERMS,
}
