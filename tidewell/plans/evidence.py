"""Queries of relevance scoring, mentions, publication status, merging and harvests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t
from ..operators import maintenance as mt
from ..operators import mentions as mn
from ..operators import relevance as rv
from ..operators.linkage import identity_key
from ..streaming import harvest as hv
from . import fragments as q
from .tables import read

#: A literal model: the fitted artefact is not part of the data.
MODEL = (("salmon", 0.5, 1.2), ("trout", 0.4, 0.9), ("whitefish", 0.6, 0.4), ("survey", 0.7, -0.6), ("market", 0.8, -1.1), ("deep_survey", 1.9, -0.3), ("preliminary_results", 1.4, 0.2))
INTERCEPT, EXCLUDE, INCLUDE = -0.4, 0.35, 0.7
#: A literal gazetteer of words that the titles and abstracts hold.
PLACES = (("Loch", "United Kingdom", "GBR", "Europe"), ("Inlet", "Canada", "CAN", "North America"), ("Sound", "New Zealand", "NZL", "Oceania"), ("Bay", "Ireland", "IRL", "Europe"), ("winter", None, None, "Northern waters"), ("Sound", "Norway", "NZZ", "Europe"))


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "relevance_screening").select("record_sequence", "eligibility", F.concat_ws(" ", "title", "abstract").alias("text"))


def _model(spark: SparkSession) -> DataFrame:
    return F.broadcast(spark.createDataFrame(list(MODEL), "term string, idf double, coef double"))  # a literal of seven rows


def relevance_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = rv.score(_texts(spark, sf_dir), _model(spark), INTERCEPT, "record_sequence", "text")
    return s.select("record_sequence", F.round("probability", 9).alias("probability"), rv.decision(F.col("probability"), EXCLUDE, INCLUDE).alias("relevance_decision"))


_STOP = ", ".join(f"'{w}'" for w in rv.STOPWORDS)
_TERMS = f"""
WITH w AS (SELECT record_sequence, list_filter(regexp_split_to_array(regexp_replace(lower(concat_ws(' ', title, abstract)), 'https?://\\S+', ' ', 'g'), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '' AND x NOT IN ({_STOP})) AS l FROM relevance_screening),
tm AS (SELECT record_sequence, unnest(l) AS term FROM w UNION ALL SELECT record_sequence, l[i] || '_' || l[i + 1] FROM (SELECT record_sequence, l, unnest(range(1, len(l))) AS i FROM w)),
tc AS MATERIALIZED (SELECT record_sequence, term, count(*) AS tf FROM tm GROUP BY ALL)
"""
RELEVANCE_SCORES = (
    _TERMS
    + f", m(term, idf, coef) AS (VALUES {', '.join(f'({chr(39)}{a}{chr(39)}, {b}::DOUBLE, {c}::DOUBLE)' for a, b, c in MODEL)}), z AS (SELECT record_sequence, sum(tf * idf * coef) AS z FROM tc JOIN m USING (term) GROUP BY ALL), "
    f"p AS (SELECT r.record_sequence, 1 / (1 + exp(-({INTERCEPT} + coalesce(z, 0)))) AS p FROM relevance_screening r LEFT JOIN z USING (record_sequence)) "
    f"SELECT record_sequence, round(p, 9) AS probability, CASE WHEN p < {EXCLUDE} THEN 'automatic_exclude' WHEN p >= {INCLUDE} THEN 'automatic_retain' ELSE 'review' END AS relevance_decision FROM p"
)


def term_idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = _texts(spark, sf_dir)
    weights = rv.idf(rv.term_counts(texts, "record_sequence", "text"), texts.count())
    return weights.select("term", "df", F.round("idf", 9).alias("idf"))


TERM_IDF = _TERMS + "SELECT term, df, round(log10(n::DOUBLE / df), 9) AS idf FROM (SELECT term, count(*) AS df FROM tc GROUP BY term), (SELECT count(*) AS n FROM relevance_screening) WHERE df >= 3 AND df <= 0.98 * n"


def screening_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = read(spark, sf_dir, "relevance_screening").where("eligibility is not null and relevance_probability is not null")
    return rv.metrics(r, "eligibility", "relevance_probability", 0.5)


SCREENING_METRICS = """
WITH c AS (SELECT count(*) FILTER (eligibility = 1 AND relevance_probability >= 0.5) AS tp, count(*) FILTER (eligibility <> 1 AND relevance_probability >= 0.5) AS fp,
  count(*) FILTER (eligibility <> 1 AND relevance_probability < 0.5) AS tn, count(*) FILTER (eligibility = 1 AND relevance_probability < 0.5) AS fn
  FROM relevance_screening WHERE eligibility IS NOT NULL AND relevance_probability IS NOT NULL)
SELECT *, tp / nullif(tp + fn, 0) AS sensitivity, tn / nullif(tn + fp, 0) AS specificity, tp / nullif(tp + fp, 0) AS precision, tn / nullif(tn + fn, 0) AS npv FROM c"""


def operating_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rv.operating_thresholds(read(spark, sf_dir, "relevance_screening"), "eligibility", "relevance_probability", 0.9, 0.5)


OPERATING_THRESHOLDS = """
WITH k AS (SELECT eligibility AS y, relevance_probability AS p FROM relevance_screening WHERE eligibility IS NOT NULL AND relevance_probability IS NOT NULL),
g AS (SELECT p AS t, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y <> 1) AS neg FROM k GROUP BY 1 UNION ALL SELECT i / 1000, 0, 0 FROM range(0, 1001) r(i)),
u AS (SELECT t, sum(pos) AS pos, sum(neg) AS neg FROM g GROUP BY t),
s AS (SELECT t, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS allpos FROM u WINDOW w AS (ORDER BY t DESC ROWS UNBOUNDED PRECEDING)),
f AS (SELECT coalesce(max(t) FILTER (tp / nullif(allpos, 0) >= 0.9), 0.0) AS e, coalesce(min(t) FILTER (tp / nullif(tp + fp, 0) >= 0.5 AND tp > 0), 1.0) AS i FROM s)
SELECT e AS exclude, CASE WHEN i <= e THEN least(1.0, greatest(e + 0.05, (SELECT quantile_cont(p, 0.25) FROM k WHERE y = 1))) ELSE i END AS include FROM f"""


def relevance_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, intercept = rv.train(_texts(spark, sf_dir), "eligibility", "text")
    return model.withColumn("intercept", F.lit(intercept))


#: The part of the generic, the ruling genus and the weak species, played by entries of the given dictionary.
GENERIC, GENUS, WEAK = "UNSPEC_FINFISH", "Fluvitrutta", ("NOR_IGNIVA00",)


def species_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mn.species_mentions(read(spark, sf_dir, "relevance_screening"), read(spark, sf_dir, "species_dictionary"))


def species_assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = read(spark, sf_dir, "relevance_screening")
    found = mn.species_mentions(records, read(spark, sf_dir, "species_dictionary"))
    eligible = mn.filter_generic(found, F.col("species_id") == GENERIC, GENUS)
    return mn.assign_species(eligible, records.select(F.col("record_sequence").cast("bigint").alias("id")), GENERIC, WEAK)


_SPECIES = """
WITH tx AS (SELECT record_sequence AS id, 'title' AS source, title AS txt FROM relevance_screening UNION ALL SELECT record_sequence, 'abstract', abstract FROM relevance_screening),
sy AS (SELECT DISTINCT synonym AS term, species_id FROM species_dictionary WHERE synonym IS NOT NULL AND trim(synonym) <> ''),
sp AS (SELECT species_id, min(preferred_name) AS preferred_name, min(scientific_name) AS scientific_name, bool_or(is_farmed_candidate) AS is_farmed_candidate, min(default_group) AS default_group FROM species_dictionary GROUP BY 1),
ps AS (SELECT id, source, txt, term, species_id, unnest(range(1, greatest(2, length(txt) - length(term) + 2))) AS i FROM tx JOIN sy ON contains(lower(txt), lower(term))),
hit AS MATERIALIZED (SELECT DISTINCT id, source, species_id, i AS s, i + length(term) - 1 AS e, substr(txt, i, length(term)) AS matched_text FROM ps WHERE lower(substr(txt, i, length(term))) = lower(term)
  AND NOT regexp_matches(substr(txt, i + length(term), 1), '[A-Za-z0-9_]') AND (i = 1 OR NOT regexp_matches(substr(txt, i - 1, 1), '[A-Za-z0-9_]'))),
kept AS MATERIALIZED (SELECT * FROM hit h WHERE NOT EXISTS (SELECT 1 FROM hit o WHERE o.id = h.id AND o.source = h.source AND o.s <= h.e AND h.s <= o.e AND (o.e - o.s > h.e - h.s OR o.e - o.s = h.e - h.s AND (o.s < h.s OR o.s = h.s AND o.species_id < h.species_id)))),
mn AS MATERIALIZED (SELECT cast(id AS BIGINT) AS id, source, kept.species_id, matched_text, cast(s AS INTEGER) AS match_start, cast(e AS INTEGER) AS match_end, preferred_name, scientific_name, is_farmed_candidate, default_group FROM kept JOIN sp USING (species_id))
"""
SPECIES_MENTIONS = _SPECIES + "SELECT * FROM mn"
_ASSIGNED = (
    _SPECIES
    + """, el AS (SELECT * FROM mn m WHERE NOT (species_id = 'UNSPEC_FINFISH' AND lower(matched_text) NOT IN ('salmon farm', 'salmon farms', 'farmed salmon', 'salmon aquaculture', 'salmon cage', 'salmon cages', 'salmon pen', 'salmon pens')
  AND EXISTS (SELECT 1 FROM mn o WHERE o.id = m.id AND o.source = m.source AND NOT o.is_farmed_candidate AND regexp_matches(o.scientific_name, '(?i)^Fluvitrutta\\s+[A-Za-z-]+$') AND abs((o.match_start + o.match_end) / 2.0 - (m.match_start + m.match_end) / 2.0) <= 120))),
un AS (SELECT DISTINCT id, species_id, preferred_name, is_farmed_candidate FROM el), fa AS (SELECT * FROM un u WHERE is_farmed_candidate AND NOT (species_id = 'UNSPEC_FINFISH' AND EXISTS (SELECT 1 FROM un o WHERE o.id = u.id AND o.is_farmed_candidate AND o.species_id NOT IN ('UNSPEC_FINFISH', 'NOR_IGNIVA00')))),
nt AS (SELECT id, string_agg(DISTINCT preferred_name, '; ' ORDER BY preferred_name) AS non_target_species FROM un WHERE NOT is_farmed_candidate GROUP BY id), fc AS (SELECT *, count(*) OVER (PARTITION BY id) AS n FROM fa),
sa AS (SELECT r.id, fc.species_id AS farmed_species_id, fc.preferred_name AS farmed_species, CASE WHEN n IS NULL THEN 'unresolved' WHEN n = 1 THEN 'primary' ELSE 'co-primary' END AS assignment_role, n IS NULL AS review_required,
  CASE WHEN n = 1 THEN 'One eligible farmed species detected' WHEN n > 1 THEN n || ' eligible farmed species detected; none treated as primary' WHEN non_target_species IS NOT NULL THEN 'Only non-target species detected' ELSE 'No eligible farmed species detected' END AS assignment_reason, non_target_species
  FROM (SELECT cast(record_sequence AS BIGINT) AS id FROM relevance_screening) r LEFT JOIN fc ON r.id = fc.id LEFT JOIN nt ON r.id = nt.id)
"""
)
SPECIES_ASSIGNMENTS = _ASSIGNED + "SELECT * FROM sa"


def _gazetteer(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(PLACES), "matched_place string, country_name string, iso3c string, region_name string")


def _ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mn.rank_countries(mn.place_mentions(read(spark, sf_dir, "relevance_screening"), _gazetteer(spark)))


def country_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranking(spark, sf_dir)


def country_assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mn.country_summary(*mn.primary_countries(_ranking(spark, sf_dir)))


#: The SQL has each name once: of the two rows named Sound the first by code is the one that counts.
_PLACE_ROWS = ", ".join("(" + ", ".join("NULL" if x is None else f"'{x}'" for x in p) + ")" for p in PLACES if p[2] != "NZZ")
_ARTEFACT = " OR ".join(f"contains(ctx, '{a}')" for a in mn.ARTEFACTS)
_RANK = f"""
WITH gz(place, country_name, iso3c, region_name) AS (VALUES {_PLACE_ROWS}),
tx AS (SELECT record_sequence AS id, 'title' AS source, title AS txt FROM relevance_screening UNION ALL SELECT record_sequence, 'abstract', abstract FROM relevance_screening),
ps AS (SELECT id, source, txt, gz.*, unnest(range(1, greatest(2, length(txt) - length(place) + 2))) AS i FROM tx JOIN gz ON contains(lower(txt), lower(place))),
mt AS (SELECT * FROM ps WHERE lower(substr(txt, i, length(place))) = lower(place) AND NOT regexp_matches(substr(txt, i + length(place), 1), '[A-Za-z0-9_]') AND (i = 1 OR NOT regexp_matches(substr(txt, i - 1, 1), '[A-Za-z0-9_]'))),
mc AS (SELECT *, lower(trim(regexp_replace(substr(txt, greatest(1, i - 100), least(i, 101) - 1 + length(place) + 100), '\\s+', ' ', 'g'))) AS ctx FROM mt),
kp AS (SELECT *, CASE WHEN source = 'title' THEN 1 WHEN regexp_matches(ctx, '{mn.LOCATION}') THEN 2 WHEN regexp_matches(ctx, '{mn.ENTITY}') AND NOT regexp_matches(ctx, '{mn.BACKGROUND}') THEN 3 WHEN regexp_matches(ctx, '{mn.BACKGROUND}') THEN 5 ELSE 4 END AS tier
  FROM mc WHERE iso3c IS NOT NULL AND NOT ({_ARTEFACT}) AND NOT regexp_matches(ctx, '\\b' || lower(place) || '\\s+(salmon|trout|char|grayling|fish)\\b')),
tt AS (SELECT id, count(DISTINCT iso3c) AS n FROM kp WHERE source = 'title' GROUP BY id),
rg AS (SELECT DISTINCT id FROM mc WHERE source = 'title' AND iso3c IS NULL AND region_name IS NOT NULL),
rk AS (SELECT cast(kp.id AS BIGINT) AS id, iso3c, country_name, min(tier) AS best_tier, count(*) FILTER (source = 'title') AS title_mentions, count(*) FILTER (tier <= 3) AS substantive_mentions, count(*) AS total_mentions,
  coalesce(any_value(tt.n), 0) AS title_country_count, bool_or(rg.id IS NOT NULL) AS title_has_region_scope FROM kp LEFT JOIN tt ON kp.id = tt.id LEFT JOIN rg ON kp.id = rg.id GROUP BY kp.id, iso3c, country_name)
"""
COUNTRY_RANKING = _RANK + "SELECT * FROM rk"
COUNTRY_ASSIGNMENTS = (
    _RANK
    + """, asg AS (SELECT id, iso3c, country_name, CASE WHEN title_country_count = 1 THEN 'Country in title' ELSE 'Countries co-named in title' END AS why FROM rk WHERE title_country_count > 0 AND title_mentions > 0
 UNION ALL SELECT id, iso3c, country_name, 'Leading abstract evidence' FROM (SELECT *, count(*) OVER (PARTITION BY id) AS ties FROM (SELECT * FROM rk WHERE title_country_count = 0 AND NOT title_has_region_scope
   QUALIFY rank() OVER (PARTITION BY id ORDER BY best_tier, substantive_mentions DESC, total_mentions DESC) = 1)) WHERE ties = 1),
rv AS (SELECT DISTINCT id, 'Title names a region' AS why FROM rk WHERE title_has_region_scope UNION ALL SELECT DISTINCT id, 'Abstract candidates remain exactly tied' FROM (SELECT *, count(*) OVER (PARTITION BY id) AS ties FROM (SELECT * FROM rk WHERE title_country_count = 0 AND NOT title_has_region_scope
   QUALIFY rank() OVER (PARTITION BY id ORDER BY best_tier, substantive_mentions DESC, total_mentions DESC) = 1)) WHERE ties > 1),
a AS (SELECT id, string_agg(DISTINCT country_name, '; ' ORDER BY country_name) AS primary_countries, string_agg(DISTINCT iso3c, '; ' ORDER BY iso3c) AS primary_iso3c, count(DISTINCT iso3c) AS n, string_agg(DISTINCT why, '; ' ORDER BY why) AS assignment_reasons FROM asg GROUP BY id),
r AS (SELECT id, string_agg(DISTINCT why, '; ' ORDER BY why) AS review_reason FROM rv GROUP BY id)
SELECT coalesce(a.id, r.id) AS id, primary_countries, primary_iso3c, coalesce(n, 0) AS primary_country_count, assignment_reasons, review_reason, review_reason IS NOT NULL AS review_required FROM a FULL JOIN r ON a.id = r.id"""
)


def adjudication_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = read(spark, sf_dir, "relevance_screening")
    ids = records.select(F.col("record_sequence").cast("bigint").alias("id"), "record_id", "title")
    ranking = _ranking(spark, sf_dir)
    summary = mn.country_summary(*mn.primary_countries(ranking))
    return mt.adjudication_queue(ids, species_assignments(spark, sf_dir), summary, ranking)


ADJUDICATION_QUEUE = f"""
WITH sa AS ({SPECIES_ASSIGNMENTS}), cs AS ({COUNTRY_ASSIGNMENTS}), cr AS ({COUNTRY_RANKING}),
fd AS (SELECT id, string_agg(DISTINCT nullif(farmed_species, ''), '; ' ORDER BY nullif(farmed_species, '')) AS deterministic_species, string_agg(DISTINCT nullif(farmed_species_id, ''), '; ' ORDER BY nullif(farmed_species_id, '')) AS deterministic_species_ids,
  string_agg(DISTINCT assignment_reason, '; ' ORDER BY assignment_reason) AS species_reasons, string_agg(DISTINCT non_target_species, '; ' ORDER BY non_target_species) AS non_target_species, bool_or(review_required) AS s FROM sa GROUP BY id),
pl AS (SELECT id, string_agg(country_name || ' [' || iso3c || ']; tier ' || best_tier, ' | ' ORDER BY best_tier, iso3c) AS geography_candidates FROM cr GROUP BY id)
SELECT cast(r.record_sequence AS BIGINT) AS id, r.record_id, r.title, deterministic_species, deterministic_species_ids, species_reasons, non_target_species, coalesce(s, false) AS species_review_required, coalesce(cs.review_required, false) AS geography_review_required,
  cs.review_reason AS geography_review_reason, cs.primary_countries AS deterministic_primary_countries, geography_candidates
FROM relevance_screening r LEFT JOIN fd ON fd.id = r.record_sequence LEFT JOIN cs ON cs.id = r.record_sequence LEFT JOIN pl ON pl.id = r.record_sequence WHERE coalesce(s, false) OR coalesce(cs.review_required, false)"""


def _lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stand-in for the outside lookup: DOIs that end in 7 are retracted, those in 3 are unknown."""
    dois = read(spark, sf_dir, "relevance_screening").select(t.lookup_doi(F.col("doi")).alias("doi"))

    def fetch(part: list[str]) -> dict[str, dict]:
        return {d: {"id": "W" + d, "title": None, "is_retracted": d.endswith("7")} for d in part if not d.endswith("3")}

    return mt.lookup_dois(dois, fetch)


def publication_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit = mt.publication_status(read(spark, sf_dir, "relevance_screening"), _lookup(spark, sf_dir))
    return audit.select("record_sequence", "notice_type", "doi_for_lookup", "openalex_lookup_status", "remove_publication_status", "removal_reason")


PUBLICATION_STATUS = f"""
WITH k AS (SELECT record_sequence, {q.notice('title')} AS nt, coalesce({q.doi_key('doi')}, '') AS d FROM relevance_screening)
SELECT record_sequence, nt AS notice_type, d AS doi_for_lookup, CASE WHEN nt IS NOT NULL THEN 'not_queried_notice' WHEN d = '' THEN 'not_queried_no_doi' WHEN right(d, 1) = '3' THEN 'not_found' ELSE 'found' END AS openalex_lookup_status,
  nt IS NOT NULL OR right(d, 1) = '7' AS remove_publication_status, CASE WHEN nt IS NOT NULL THEN nt WHEN right(d, 1) = '7' THEN 'retracted_original' END AS removal_reason FROM k"""


def due_retractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report of limited length: the first 500 lookups that are due."""
    r = read(spark, sf_dir, "relevance_screening").where("doi is not null")
    cache = r.groupBy(t.lookup_doi(F.col("doi")).alias("doi_for_lookup")).agg(F.max("harvested_at").alias("last_checked_at"), F.lit(False).alias("openalex_is_retracted"))
    cache = cache.withColumn("next_check_at", mt.next_check(F.col("last_checked_at"), F.lit("found"), F.col("openalex_is_retracted")))
    return mt.due_lookups(cache, F.lit("2023-01-01").cast("timestamp")).select("doi_for_lookup")


DUE_RETRACTIONS = f"""
SELECT d AS doi_for_lookup FROM (SELECT coalesce({q.doi_key('doi')}, '') AS d, max(harvested_at) + INTERVAL 90 DAYS AS nx FROM relevance_screening WHERE doi IS NOT NULL GROUP BY 1)
WHERE nx <= TIMESTAMP '2023-01-01' ORDER BY nx, d LIMIT 500"""


def final_screening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions by probability, the middle band by a stand-in model that retains even numbers."""
    r = read(spark, sf_dir, "relevance_screening").select(F.col("record_sequence").cast("string").alias("key"), rv.decision(F.col("relevance_probability"), 0.3, 0.7).alias("auto"))

    def model(rows: list[dict]) -> list[dict]:
        return [{"key": x["key"], "decision": "retain" if int(x["key"]) % 2 == 0 else "exclude"} for x in rows]

    asked = mt.ask(r.where("auto = 'review'").select("key"), model, "key", {"decision": "uncertain"})
    joined = r.join(asked, "key", "left")
    return joined.groupBy("auto", mt.final_decision(F.col("auto"), F.col("decision"), F.col("llm_failed")).alias("final_screening_decision")).agg(F.count("*").alias("records"))


FINAL_SCREENING = """
WITH a AS (SELECT record_sequence, CASE WHEN relevance_probability < 0.3 THEN 'automatic_exclude' WHEN relevance_probability >= 0.7 THEN 'automatic_retain' ELSE 'review' END AS auto FROM relevance_screening)
SELECT auto, CASE auto WHEN 'automatic_retain' THEN 'retain' WHEN 'automatic_exclude' THEN 'exclude' ELSE CASE WHEN record_sequence % 2 = 0 THEN 'retain' ELSE 'exclude' END END AS final_screening_decision, count(*) AS records FROM a GROUP BY ALL"""


def topic_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = read(spark, sf_dir, "merge_master_update")
    rows = m.select("record_id", F.explode(F.split("topic_path_ids", r'[;,|"\[\] ]+')).alias("path_id"), F.col("topic_review_required").alias("review_required"), F.col("topic_review_reason").alias("review_reason"), F.lit("").alias("hierarchy_path"))
    return mt.topic_map(rows).drop("topic_hierarchy_paths")


TOPIC_MAP = """
SELECT record_id, string_agg(DISTINCT nullif(p, ''), '; ' ORDER BY nullif(p, '')) AS topic_path_ids, coalesce(bool_or(lower(coalesce(rr, '')) IN ('true', '1', 'yes')), false) AS topic_review_required,
  string_agg(DISTINCT nullif(rs, ''), '; ' ORDER BY nullif(rs, '')) AS topic_review_reason
FROM (SELECT record_id, unnest(regexp_split_to_array(topic_path_ids, '[;,|"\\[\\] ]+')) AS p, topic_review_required AS rr, topic_review_reason AS rs FROM merge_master_update WHERE topic_path_ids IS NOT NULL) GROUP BY record_id"""


def merge_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = read(spark, sf_dir, "relevance_screening")
    key = identity_key(F.col("record_id"), F.col("doi"), F.col("title"))
    return mt.merge_checks(read(spark, sf_dir, "merge_master_update"), r.where("batch_id > 0"), key)


_NORM = lambda c: f"nullif(lower({q.squish(f'coalesce({c}, {chr(39) * 2})')}), '')"
_ID = f"coalesce('lens:' || {_NORM('record_id')}, 'doi:' || {_NORM('doi')}, 'title:' || {_NORM('title')})"
MERGE_CHECKS = f"""
WITH u AS (SELECT {_ID} AS k FROM relevance_screening WHERE batch_id > 0), m AS (SELECT {_ID} AS k FROM merge_master_update)
SELECT (SELECT count(*) FROM u) AS update_records, (SELECT count(k) - count(DISTINCT k) FROM u) AS update_duplicates, (SELECT count(*) FROM (SELECT DISTINCT k FROM u WHERE k IN (SELECT k FROM m))) AS overlap,
  (SELECT count(*) FROM m) AS master_records, (SELECT count(k) - count(DISTINCT k) FROM m) AS master_duplicates"""


def key_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mt.key_problems(read(spark, sf_dir, "relevance_screening"), ["record_sequence", "record_id"])


KEY_PROBLEMS = " UNION ALL ".join(
    f"SELECT '{k}' AS key, 'missing' AS problem, count(*) FILTER ({k} IS NULL OR cast({k} AS VARCHAR) = '') AS rows FROM relevance_screening "
    f"UNION ALL SELECT '{k}', 'repeated', cast(coalesce(sum(n), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM relevance_screening WHERE {k} IS NOT NULL GROUP BY {k} HAVING count(*) > 1)"
    for k in ("record_sequence", "record_id")
)


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mt.manifest(read(spark, sf_dir, "relevance_screening"), "screening")


MANIFEST = "SELECT 'screening' AS target_name, count(*) AS n_records, min(record_sequence) AS min_sequence, max(record_sequence) AS max_sequence FROM relevance_screening"


def upserted_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = read(spark, sf_dir, "merge_master_update").select("record_id", "title", "source")
    r = read(spark, sf_dir, "relevance_screening").where("batch_id > 0 and record_id is not null")
    new = r.groupBy("record_id").agg(F.max_by(F.struct("title", "source"), "record_sequence").alias("s")).select("record_id", "s.title", "s.source")
    return mt.upsert(m, new, "record_id")


UPSERTED_MASTER = """
WITH n AS (SELECT record_id, title, source FROM relevance_screening WHERE batch_id > 0 AND record_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY record_sequence DESC) = 1)
SELECT record_id, title, source FROM merge_master_update WHERE record_id NOT IN (SELECT record_id FROM n) UNION ALL SELECT * FROM n"""


def harvest_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    rows = hv.window_of(e, "ts", F.lit("2024-01-20").cast("timestamp"), F.lit("2024-01-25").cast("timestamp")).withColumn("day", F.to_date("ts"))
    return hv.first_seen_batch(rows.select("user_id", "event_type", "day", "event_id", "ts"), ["user_id", "event_type", "day"], ["ts", "event_id"])


HARVEST_WINDOW = """
SELECT user_id, event_type, cast(ts AS DATE) AS day, event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-13' AND ts <= TIMESTAMP '2024-01-25'
QUALIFY row_number() OVER (PARTITION BY user_id, event_type, cast(ts AS DATE) ORDER BY ts, event_id) = 1"""


def weekly_harvest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hv.weekly_counts(read(spark, sf_dir, "relevance_screening"), "harvested_at", ["record_id"])


WEEKLY_HARVEST = "SELECT time_bucket(INTERVAL 7 DAYS, harvested_at, TIMESTAMP '1970-01-01') AS week, count(*) AS raw_records, count(DISTINCT record_id) AS unique_records FROM relevance_screening WHERE harvested_at IS NOT NULL GROUP BY 1"

QUERIES = {
    "relevance_scores": relevance_scores, "term_idf": term_idf, "screening_metrics": screening_metrics, "operating_thresholds": operating_thresholds, "relevance_train": relevance_train,
    "species_mentions": species_mentions, "species_assignments": species_assignments, "country_ranking": country_ranking, "country_assignments": country_assignments,
    "adjudication_queue": adjudication_queue, "publication_status": publication_status, "due_retractions": due_retractions, "final_screening": final_screening,
    "topic_map": topic_map, "merge_checks": merge_checks, "key_problems": key_problems, "manifest": manifest, "upserted_master": upserted_master,
    "harvest_window": harvest_window, "weekly_harvest": weekly_harvest,
}
ORACLES = {
    "relevance_scores": RELEVANCE_SCORES, "term_idf": TERM_IDF, "screening_metrics": SCREENING_METRICS, "operating_thresholds": OPERATING_THRESHOLDS,
    "country_ranking": COUNTRY_RANKING, "country_assignments": COUNTRY_ASSIGNMENTS, "publication_status": PUBLICATION_STATUS, "due_retractions": DUE_RETRACTIONS,
    "adjudication_queue": ADJUDICATION_QUEUE, "species_mentions": SPECIES_MENTIONS, "species_assignments": SPECIES_ASSIGNMENTS, "final_screening": FINAL_SCREENING, "topic_map": TOPIC_MAP, "merge_checks": MERGE_CHECKS, "key_problems": KEY_PROBLEMS, "manifest": MANIFEST,
    "upserted_master": UPSERTED_MASTER, "harvest_window": HARVEST_WINDOW, "weekly_harvest": WEEKLY_HARVEST,
}
