"""Queries of updates, repairs of the master, saved models and figures' tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t
from ..functions import values as v
from ..operators import dashboard as d
from ..operators import figures as fg
from ..operators import linkage as k
from ..operators import relevance as rv
from ..operators import trends as tr
from ..operators import upkeep as up
from ..session import shared_dir
from ..sources import model as md
from ..sources import paged as pg
from ..sources import target as tg
from . import board, evidence
from . import fragments as q
from .tables import read


def _update(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Incoming and existing rows, an audit of the incoming ones, and stand-in answers about its residue."""
    r = read(spark, sf_dir, "relevance_screening")
    old, new = r.where("batch_id = 0"), r.where("batch_id > 0").withColumn("incoming_row", F.col("record_sequence"))
    known = old.select("record_id").where("record_id is not null").distinct().withColumn("_k", F.lit(True))
    status = F.when(F.col("_k"), "duplicate").when(F.col("doi").isNull(), "possible_duplicate").otherwise("new")
    audit = new.join(known, "record_id", "left").select("incoming_row", status.alias("duplicate_status"))
    decision = F.when(F.col("year") % 2 == 0, "duplicate").when(F.col("abstract").isNull(), "uncertain").otherwise("not_duplicate")
    answers = audit.where("duplicate_status = 'possible_duplicate'").join(new, "incoming_row").select("incoming_row", decision.alias("decision"), F.lit(0.9).alias("confidence"), F.lit("stand-in").alias("rationale"))
    return new, old, audit, answers


def merged_adjudication(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, audit, answers = _update(spark, sf_dir)
    return up.merge_adjudication(audit, answers)


def adjudication_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, audit, answers = _update(spark, sf_dir)
    return up.adjudication_problems(audit, answers)


def update_new_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    new, _, audit, answers = _update(spark, sf_dir)
    return up.new_records(new, up.merge_adjudication(audit, answers)).select("incoming_row", "record_id", "title")


def update_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    new, old, audit, answers = _update(spark, sf_dir)
    return up.update_summary(new, old, up.merge_adjudication(audit, answers))


_UPDATE = """
WITH nw AS (SELECT * FROM relevance_screening WHERE batch_id > 0), au AS (SELECT record_sequence AS incoming_row, year, abstract,
  CASE WHEN record_id IN (SELECT record_id FROM relevance_screening WHERE batch_id = 0 AND record_id IS NOT NULL) THEN 'duplicate' WHEN doi IS NULL THEN 'possible_duplicate' ELSE 'new' END AS duplicate_status FROM nw),
mg AS (SELECT incoming_row, duplicate_status, CASE WHEN duplicate_status = 'possible_duplicate' THEN CASE WHEN year % 2 = 0 THEN 'duplicate' WHEN abstract IS NULL THEN 'uncertain' ELSE 'not_duplicate' END END AS api_decision FROM au),
fin AS (SELECT *, CASE WHEN api_decision = 'not_duplicate' THEN 'new' WHEN api_decision IS NOT NULL THEN api_decision ELSE duplicate_status END AS final_duplicate_status FROM mg)
"""


def annotated_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = read(spark, sf_dir, "merge_master_update").withColumnRenamed("record_id", "id")
    species = m.select("id", F.col("final_species").alias("farmed_species"), F.col("final_species").isNull().alias("review_required"))
    places = m.select("id", F.col("final_primary_country_iso3c").alias("primary_countries"), F.col("final_primary_country_iso3c").isNull().alias("review_required"))
    answers = m.where("topic_review_required = 'TRUE'").select("id", F.lit("Answered").alias("species_decision"), F.lit("UNRESOLVED").alias("country_decision"))
    return up.annotated(m.select("id", "title"), species, places, answers).select("id", "final_species", "final_countries", "species_review", "country_review")


def _assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = read(spark, sf_dir, "merge_master_update")
    failed = F.when(F.col("topic_path_ids").isNull(), "failed").otherwise("completed")
    return m.select("record_id", F.col("topic_path_ids").alias("path_id"), (F.col("topic_review_required") == "TRUE").alias("review_required"), failed.alias("status"))


def assignment_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return up.assignment_totals(_assignments(spark, sf_dir))


def sweep_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return up.sweep_counts(evidence.publication_status(spark, sf_dir))


def _four_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = board._view(spark, sf_dir).select("record_id", F.explode("paths").alias("p")).where(F.size("p") >= 2)
    level = lambda i: F.coalesce(F.get("p", F.lit(i)), F.lit("General"))
    told = F.concat_ws(" > ", level(0), level(1), level(2), F.lit("General"))
    broad = F.concat_ws(" > ", level(0), level(1), F.lit("General"), F.lit("General"))
    return rows.select("record_id", F.explode(F.array(told, broad)).alias("path")).distinct().select("record_id", *up.split_assignment(F.col("path")))


def specific_assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return up.specific_assignments(_four_levels(spark, sf_dir), ["record_id"])


def valid_assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = board._view(spark, sf_dir).select("record_id", F.explode("paths").alias("p")).select("record_id", F.array_join("p", " > ").alias("hierarchy_path")).distinct()
    kept, _ = up.valid_assignments(rows, read(spark, sf_dir, "topic_ontology"), "record_id")
    return kept


def _recovered(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    m = read(spark, sf_dir, "merge_master_update")
    path = read(spark, sf_dir, "topic_ontology").agg(F.min("path_id").alias("path_id"), F.min_by("hierarchy_path", "path_id").alias("hierarchy_path"))
    told = m.where("year is null or topic_path_ids is null").select("record_id").crossJoin(F.broadcast(path))  # a table of one row
    return up.recover_topics(m, told.withColumns({"review_required": F.lit("TRUE"), "review_reason": F.lit("recovered")}))


def topic_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recovered(spark, sf_dir)[0].select("record_id", "topic_path_ids", "topic_hierarchy_paths", "topic_review_required", "topic_review_reason")


def topic_recovery_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recovered(spark, sf_dir)[1]


_RECOVER = """
WITH pt AS (SELECT min(path_id) AS pid, min_by(hierarchy_path, path_id) AS pth FROM topic_ontology),
j AS (SELECT m.*, (year IS NULL OR topic_path_ids IS NULL) AS told, trim(coalesce(topic_hierarchy_paths, '')) <> '' AND trim(coalesce(topic_path_ids, '')) <> '' AS done FROM merge_master_update m)
"""


def manual_exclusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = read(spark, sf_dir, "merge_master_update")
    decisions = m.select("record_id", F.when(F.col("pages").isNull(), " Exclude ").otherwise("keep").alias("human_decision")).unionByName(spark.createDataFrame([("74017", "exclude")], "record_id string, human_decision string"))
    got = up.excluded(m, decisions, ("74017",))
    return got["remaining"].select("record_id", F.lit("remaining").alias("state")).unionByName(got["removed"].select("record_id", F.lit("removed").alias("state"))).unionByName(got["problems"].select("record_id", F.lit("missing").alias("state")))


def country_taxon_repairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return up.repair_confusions(read(spark, sf_dir, "merge_master_update"), "Glacichar", ["NOR", "CAN", "AUS"], [])[1]


def resolved_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = read(spark, sf_dir, "merge_master_update").select("record_id", "duplicate_group", "pages", "url_raw", "title")
    return up.resolve_duplicates(m, "duplicate_group").select("record_id", "duplicate_group", "pages", "url_raw")


def ids_outside_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tg.unknown_ids(read(spark, sf_dir, "merge_master_update"), read(spark, sf_dir, "relevance_screening"))


def _saved(spark: SparkSession) -> md.Bundle:
    path = f"{shared_dir(spark).rstrip('/')}/model-{uuid.uuid4().hex}"
    md.save_model(path, evidence._model(spark), evidence.INTERCEPT, {"exclude_threshold": evidence.EXCLUDE, "include_threshold": evidence.INCLUDE}, ngrams="1:2")
    return md.load_model(spark, path)


def screen_with_saved_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = md.screen(read(spark, sf_dir, "relevance_screening"), _saved(spark))
    return s.withColumn("relevance_probability", F.round("relevance_probability", 9))


def operating_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rv.operating_points(read(spark, sf_dir, "relevance_screening"), "eligibility", "relevance_probability", 0.3, 0.7)


def _points(low: float, name: str) -> str:
    c = f"SELECT count(*) FILTER (y = 1 AND p >= {low}) AS tp, count(*) FILTER (y <> 1 AND p >= {low}) AS fp, count(*) FILTER (y <> 1 AND p < {low}) AS tn, count(*) FILTER (y = 1 AND p < {low}) AS fn FROM (SELECT eligibility AS y, relevance_probability AS p FROM relevance_screening WHERE eligibility IS NOT NULL AND relevance_probability IS NOT NULL)"
    return f"SELECT *, tp / nullif(tp + fn, 0) AS sensitivity, tn / nullif(tn + fp, 0) AS specificity, tp / nullif(tp + fp, 0) AS precision, tn / nullif(tn + fn, 0) AS npv, '{name}' AS operating_point, {low}::DOUBLE AS threshold FROM ({c})"


def harvest_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = read(spark, sf_dir, "relevance_screening")
    query = pg.Query(["oxygen", "probiotic*"], ["manual_ris"], "2020-01-01", "2024-06-30")
    return r.where(query.predicate(F.col("title"), F.col("abstract"), F.lit(""), F.col("source"), F.col("created"))).select("record_sequence")


def label_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles and DOIs whose records lie on both sides of an even probability."""
    r = read(spark, sf_dir, "relevance_screening").withColumn("eligibility", (F.col("relevance_probability") >= 0.5).cast("int"))
    return k.label_conflicts(r)


#: A literal gazetteer with several rows a country, and numbers of countries.
NAMES = (("nor ", "Norway", "Country", "1"), ("NOR", "Noreg", "country name", "3"), ("NOR", "Norge", "country", "3"), ("CAN", "Canada", "country", None), ("CAN", "Dominion", "country", "0"), ("CHL", "Chiloe", "region", "9"), ("AUS", " ", "country", "1"))
NUMBERS = (("nor", "578"), ("FRO", "234"), ("ATA", "10"), ("AUS", "36"), ("CAN", None))
CHOSEN = (("Fish health > Predator standards > Manual insurance", "Insurance"), ("Fish health > Predator standards > Genetic meal", "Insurance"), ("Genetics and breeding > Spleen modelling > Farmed marker", "Markers"))


def ordered_species(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fg.ordered_species(d.species_counts(board._view(spark, sf_dir)), ("Ember trout", "Not there", "Raven smelt"))


def country_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fg.country_names(spark.createDataFrame(list(NAMES), "iso3c string, country_name string, match_type string, priority string"))


def _map(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    world = fg.iso_numbers(spark.createDataFrame(list(NUMBERS), "ISO_A3 string, m49 string"))
    return fg.on_the_map(d.country_counts(board._view(spark, sf_dir)), world)


def map_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _map(spark, sf_dir)[0]


def codes_off_the_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _map(spark, sf_dir)[1]


def final_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fg.final_points(tr.dense_years(tr.year_topics(board._view(spark, sf_dir)), "topic"))


def topics_of_interest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fg.topics_of_interest(board._view(spark, sf_dir), F.broadcast(spark.createDataFrame(list(CHOSEN), "path string, topic string")))  # a literal of three rows


def growth_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = board._view(spark, sf_dir)
    yearly = view.where("year is not null").groupBy("year").agg(F.count_distinct("record_id").alias("records"))
    return fg.growth_classes(tr.dense_years(tr.year_topics(view), "topic"), yearly, board.BASE, board.RECENT)


def topic_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fg.shares_of_parent(d.topic_tree(board._view(spark, sf_dir)))


def branch_species(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = board._view(spark, sf_dir)
    return fg.branch_species(d.species_topic_counts(view), d.topic_tree(view), "Fish health")


def group_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fg.group_ends(tr.hierarchy_bars(board._view(spark, sf_dir)))


def dashboard_citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = read(spark, sf_dir, "build_dashboard").select("record_id", "title").distinct()
    return fg.with_citations(records, read(spark, sf_dir, "merge_master_update")).select("record_id", "authors", "journal", "volume", "pages", "url_raw")


def grouped_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = read(spark, sf_dir, "merge_master_update").select("record_id", "duplicate_group", "source")
    groups = m.where("duplicate_group is not null").groupBy("duplicate_group", F.col("source").alias("group_source")).agg(F.count("*").alias("members"))
    return fg.grouped_records(m.drop("source"), groups, "duplicate_group")


def search_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fg.search_total(F.lit("19793.0"), read(spark, sf_dir, "relevance_screening").where("batch_id > 0"), "volume")


def dashboard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fg.document_rows(board._view(spark, sf_dir))


def unshown_species(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Species names that figures do not show, with their records."""
    rows = read(spark, sf_dir, "merge_master_update").select("record_id", F.explode(v.split_values(F.col("final_species"))).alias("s"))
    named = rows.select("record_id", v.figure_species(F.col("s")).alias("species")).where(~F.col("species").isin(*v.SHOWN_SPECIES))
    return named.groupBy("species").agg(F.count_distinct("record_id").alias("records"))


def screening_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = read(spark, sf_dir, "relevance_screening")
    return r.select("record_sequence", t.screening_text(F.col("title"), F.col("abstract")).alias("screening_text"))


QUERIES = {
    f.__name__: f
    for f in (
        merged_adjudication, adjudication_problems, update_new_records, update_summary, annotated_update, assignment_totals, sweep_counts, specific_assignments, valid_assignments,
        topic_recovery, topic_recovery_counts, manual_exclusions, country_taxon_repairs, resolved_duplicates, ids_outside_target, screen_with_saved_model, operating_points,
        harvest_query, label_conflicts, ordered_species, country_lookup, map_counts, codes_off_the_map, final_points, topics_of_interest, growth_classes, topic_shares, branch_species,
        group_ends, dashboard_citations, grouped_records, search_total, dashboard_documents, unshown_species, screening_texts,
    )
}
_V, _N = board.VIEW, board._N
_TEXT = q.squish("'TITLE_TITLE ' || coalesce(title, '') || ' TITLE_TITLE ' || coalesce(title, '') || ' ABSTRACT ' || coalesce(abstract, '')")
_GLAC = "(regexp_matches(coalesce(final_species, ''), '(?i)\\bGlacichar\\b') OR regexp_matches(concat_ws(' ', final_species, title, abstract), '(?i)\\bGlacichar\\s+[a-z][a-z-]+\\b'))"
_CODES = board._split("final_primary_country_iso3c")
_ROWS = lambda rows: ", ".join("(" + ", ".join("NULL" if x is None else f"'{x}'" for x in r) + ")" for r in rows)
_WORLD = f"wd AS (SELECT upper(trim(a)) AS iso3, lpad(trim(n), 3, '0') AS iso_numeric FROM (VALUES {_ROWS(NUMBERS)}) z(a, n) WHERE n IS NOT NULL)"
_TREE = f"te AS (SELECT prefix, depth, parent, name, {_N} FROM pre GROUP BY ALL)"
ORACLES = {
    "merged_adjudication": _UPDATE + "SELECT incoming_row, duplicate_status, api_decision, CASE WHEN api_decision IS NOT NULL THEN 0.9::DOUBLE END AS api_confidence, CASE WHEN api_decision IS NOT NULL THEN 'stand-in' END AS api_rationale, final_duplicate_status FROM fin",
    "adjudication_problems": _UPDATE + "SELECT 0 AS repeated, 0 AS invalid, count(*) FILTER (api_decision = 'uncertain') AS uncertain, 0 AS unasked, 0 AS unanswered FROM fin",
    "update_new_records": _UPDATE + "SELECT incoming_row, record_id, title FROM fin JOIN nw ON record_sequence = incoming_row WHERE final_duplicate_status = 'new'",
    "update_summary": _UPDATE + "SELECT (SELECT count(*) FROM nw) AS incoming_records, (SELECT count(*) FROM relevance_screening WHERE batch_id = 0) AS existing_records, count(*) FILTER (duplicate_status = 'duplicate') AS automatic_duplicates, count(*) FILTER (duplicate_status = 'possible_duplicate') AS residual_candidates, "
    "count(*) FILTER (api_decision = 'duplicate') AS api_duplicates, count(*) FILTER (api_decision = 'not_duplicate') AS api_not_duplicates, count(*) FILTER (api_decision = 'uncertain') AS api_uncertain, count(*) FILTER (final_duplicate_status = 'new') AS new_records_after_deduplication FROM fin",
    "annotated_update": "SELECT record_id AS id, CASE WHEN topic_review_required = 'TRUE' THEN 'Answered' ELSE nullif(final_species, '') END AS final_species, CASE WHEN topic_review_required = 'TRUE' THEN NULL ELSE final_primary_country_iso3c END AS final_countries, final_species IS NULL AS species_review, final_primary_country_iso3c IS NULL AS country_review FROM merge_master_update",
    "assignment_totals": "SELECT count(topic_path_ids) AS assignments, count(DISTINCT record_id) FILTER (topic_path_ids IS NOT NULL) AS records, count(*) FILTER (topic_path_ids IS NULL) AS failed, count(DISTINCT record_id) FILTER (topic_path_ids IS NULL OR topic_review_required = 'TRUE') AS to_review FROM merge_master_update",
    "sweep_counts": f"SELECT count(DISTINCT nullif(doi_for_lookup, '')) AS dois, count(*) FILTER (openalex_lookup_status = 'found') AS checked, count(*) FILTER (removal_reason = 'retracted_original') AS retracted, 0 AS failed FROM ({evidence.PUBLICATION_STATUS})",
    "specific_assignments": _V + ", fl AS (SELECT DISTINCT record_id, p[1] AS broad_topic, p[2] AS subtopic, unnest([coalesce(p[3], 'General'), 'General']) AS feature, 'General' AS component FROM pt WHERE len(p) >= 2) SELECT * FROM fl f WHERE feature <> 'General' OR NOT EXISTS (SELECT 1 FROM fl o WHERE o.record_id = f.record_id AND o.broad_topic = f.broad_topic AND o.subtopic = f.subtopic AND o.feature <> 'General')",
    "valid_assignments": _V + ", aa AS (SELECT DISTINCT record_id, array_to_string(p, ' > ') AS hierarchy_path FROM pt) SELECT * FROM aa WHERE record_id NOT IN (SELECT record_id FROM aa WHERE hierarchy_path NOT IN (SELECT hierarchy_path FROM topic_ontology))",
    "topic_recovery": _RECOVER + "SELECT record_id, CASE WHEN told AND NOT done THEN pid ELSE topic_path_ids END AS topic_path_ids, CASE WHEN told AND NOT done THEN pth ELSE topic_hierarchy_paths END AS topic_hierarchy_paths, CASE WHEN told AND NOT done THEN 'TRUE' ELSE topic_review_required END AS topic_review_required, CASE WHEN told AND NOT done THEN 'recovered' ELSE topic_review_reason END AS topic_review_reason FROM j, pt",
    "topic_recovery_counts": _RECOVER + "SELECT 0 AS absent, 0 AS without_path, count(*) FILTER (told AND NOT done) AS repaired, count(*) FILTER (told AND done) AS already_complete FROM j",
    "manual_exclusions": "SELECT record_id, CASE WHEN pages IS NULL THEN 'removed' ELSE 'remaining' END AS state FROM merge_master_update",
    "country_taxon_repairs": f"SELECT record_id, final_primary_country_iso3c AS old_final_primary_country_iso3c, array_to_string(list_filter({_CODES}, lambda z: lower(z) NOT IN ('nor', 'can', 'aus')), '; ') AS new_final_primary_country_iso3c FROM merge_master_update WHERE {_GLAC} AND len(list_filter({_CODES}, lambda z: lower(z) IN ('nor', 'can', 'aus'))) > 0",
    "resolved_duplicates": "SELECT record_id, duplicate_group, pages, url_raw FROM merge_master_update WHERE duplicate_group IS NULL UNION ALL SELECT record_id, duplicate_group, pages, u FROM (SELECT *, (SELECT string_agg(DISTINCT nullif(url_raw, ''), '; ' ORDER BY nullif(url_raw, '')) FROM merge_master_update o WHERE o.duplicate_group = m.duplicate_group) AS u "
    "FROM merge_master_update m WHERE duplicate_group IS NOT NULL QUALIFY row_number() OVER (PARTITION BY duplicate_group ORDER BY trim(coalesce(pages, '')) = '', length(coalesce(url_raw, '')) DESC, record_id) = 1)",
    "ids_outside_target": "SELECT DISTINCT record_id FROM merge_master_update WHERE record_id IS NOT NULL AND record_id NOT IN (SELECT record_id FROM relevance_screening WHERE record_id IS NOT NULL)",
    "screen_with_saved_model": evidence.RELEVANCE_SCORES.replace("concat_ws(' ', title, abstract)", _TEXT).replace("AS probability", "AS relevance_probability"),
    "operating_points": _points(0.3, "automatic-exclude boundary") + " UNION ALL " + _points(0.7, "automatic-retain boundary"),
    "harvest_query": "SELECT record_sequence FROM relevance_screening WHERE regexp_matches(lower(concat_ws(' ', title, abstract, '')), '\\b(?:oxygen|probiotic\\w*)\\b') AND coalesce(source, '') <> 'manual_ris' AND created >= TIMESTAMP '2020-01-01' AND created <= TIMESTAMP '2024-06-30'",
    "label_conflicts": f"WITH x AS (SELECT {q.title_key('title')} AS tk, {q.doi_key('doi')} AS dk, cast(relevance_probability >= 0.5 AS INTEGER) AS y FROM relevance_screening WHERE relevance_probability IS NOT NULL) SELECT 'title' AS basis, tk AS key, count(*) AS records, count(DISTINCT y) AS labels FROM x WHERE tk <> '' GROUP BY tk HAVING count(DISTINCT y) > 1 "
    "UNION ALL SELECT 'doi', dk, count(*), count(DISTINCT y) FROM x WHERE dk <> '' GROUP BY dk HAVING count(DISTINCT y) > 1",
    "ordered_species": _V + f", sc AS (SELECT species, {_N} FROM (SELECT record_id, unnest(species) AS species FROM v) GROUP BY species) SELECT species, records, cast(row_number() OVER (ORDER BY CASE species WHEN 'Ember trout' THEN 1 WHEN 'Raven smelt' THEN 3 ELSE 4 END, records DESC, species) AS INTEGER) AS position FROM sc WHERE species <> 'Unspecified species'",
    "country_lookup": f"SELECT upper(trim(a)) AS iso3c, trim(b) AS country_name FROM (VALUES {_ROWS(NAMES)}) z(a, b, c, p) WHERE trim(b) <> '' AND lower(trim(c)) IN ('country', 'country name') QUALIFY row_number() OVER (PARTITION BY upper(trim(a)) ORDER BY coalesce(try_cast(p AS DOUBLE), '-infinity'::DOUBLE) DESC, trim(b)) = 1",
    "map_counts": _V + f", {board._COUNTRIES}, {_WORLD} SELECT wd.iso3, iso_numeric, coalesce(records, 0) AS records FROM wd LEFT JOIN cc ON cc.iso3 = wd.iso3",
    "codes_off_the_map": _V + f", {board._COUNTRIES}, {_WORLD} SELECT iso3, records FROM cc WHERE iso3 NOT IN (SELECT iso3 FROM wd)",
    "final_points": _V + f", {board._YT} SELECT topic, year, records, 'n = ' || format('{{:,}}', records) AS label FROM yt QUALIFY row_number() OVER (PARTITION BY topic ORDER BY year DESC) = 1",
    "topics_of_interest": _V + f", ch(path, topic) AS (VALUES {_ROWS(CHOSEN)}) SELECT topic, year, {_N} FROM pt JOIN ch ON array_to_string(p, ' > ') = path WHERE year IS NOT NULL GROUP BY ALL",
    "growth_classes": _V + f", {board._YT}, {board._YEARLY}, {board._GRID}, tp AS (SELECT topic, avg(records) FILTER (year BETWEEN 2010 AND 2014) AS b, avg(records) FILTER (year BETWEEN 2021 AND 2025) AS r FROM g GROUP BY topic), bg AS (SELECT avg(records) FILTER (year BETWEEN 2021 AND 2025) / avg(records) FILTER (year BETWEEN 2010 AND 2014) AS k FROM yr) "
    "SELECT topic, round(b, 6) AS baseline, round(r, 6) AS recent_mean, round(r / nullif(b, 0), 6) AS growth, round(k, 6) AS background_growth, CASE WHEN r / nullif(b, 0) IS NULL THEN 'New theme; no baseline' WHEN r / nullif(b, 0) > k THEN 'Faster than background' ELSE 'Not faster than background' END AS classification FROM tp, bg",
    "topic_shares": _V + f", {_TREE} SELECT a.prefix, a.depth, a.parent, a.name, a.records, round(a.records / b.records, 6) AS share, cast(row_number() OVER (PARTITION BY a.parent ORDER BY a.records DESC, a.name) AS INTEGER) AS place FROM te a LEFT JOIN te b ON a.parent = b.prefix",
    "branch_species": _V + f"SELECT name, species, {_N} FROM (SELECT record_id, name, unnest(species) AS species FROM pre WHERE parent = 'Fish health') GROUP BY ALL",
    "group_ends": _V + ", hb AS (SELECT coalesce(p[1], 'General') AS level_1, coalesce(p[2], 'General') AS level_2, coalesce(p[3], 'General') AS level_3, count(*) AS n FROM pt GROUP BY ALL), hg AS (SELECT level_1, level_2, count(*) AS bars, sum(n) AS total FROM hb GROUP BY ALL) SELECT level_1, level_2, bars, cast(sum(bars) OVER (PARTITION BY level_1 ORDER BY total DESC, level_2 ROWS UNBOUNDED PRECEDING) AS BIGINT) AS \"end\" FROM hg",
    "dashboard_citations": "SELECT b.record_id, coalesce(trim(authors), '') AS authors, coalesce(trim(journal), '') AS journal, coalesce(trim(volume), '') AS volume, coalesce(trim(pages), '') AS pages, coalesce(trim(url_raw), '') AS url_raw FROM (SELECT DISTINCT record_id, title FROM build_dashboard) b LEFT JOIN merge_master_update m ON b.record_id = m.record_id",
    "grouped_records": "SELECT record_id, m.duplicate_group, group_source, members FROM merge_master_update m LEFT JOIN (SELECT duplicate_group, source AS group_source, count(*) AS members FROM merge_master_update WHERE duplicate_group IS NOT NULL GROUP BY ALL) g ON g.duplicate_group = m.duplicate_group",
    "search_total": "SELECT cast(19793 + sum(try_cast(try_cast(volume AS DOUBLE) AS BIGINT)) AS BIGINT) AS search_results FROM relevance_screening WHERE batch_id > 0",
    "unshown_species": f"SELECT CASE WHEN lower(s) IN ('steelhead', 'steelhead trout', 'rainbow salmon') THEN 'Rainbow trout' WHEN lower(s) = 'farmed salmon' OR starts_with(lower(s), 'unspecified') THEN 'Unspecified species' ELSE s END AS species, {_N} FROM (SELECT record_id, unnest({board._split('final_species')}) AS s FROM merge_master_update) GROUP BY 1 HAVING species NOT IN ('Unspecified species', 'Rainbow trout')",
    "screening_texts": f"SELECT record_sequence, {_TEXT} AS screening_text FROM relevance_screening",
}
