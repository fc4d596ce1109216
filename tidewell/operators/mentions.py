"""Mentions of species and places in titles and abstracts, and what is concluded from them."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import values as v

#: Terms of a dictionary at most; they are sent to the tasks.
MOST_TERMS = 200_000


class Matcher:
    """Whole-term search by the first word: ASCII word boundaries, case apart, all occurrences."""

    def __init__(self, terms: list[tuple[str, str]]):
        self.first: dict[str, list[tuple[str, str]]] = defaultdict(list)
        for term, key in sorted(set(terms)):
            low = term.lower()
            head = re.match(r"[A-Za-z0-9_]+|.", low)
            if head:
                self.first[head[0]].append((low, key))

    def find(self, text: str) -> list[tuple[int, int, str, str]]:
        """(start, end, key, term) from 1, both ends included."""
        low, out = text.lower(), []
        if len(low) != len(text):  # a few letters change their length in lower case
            low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
        for m in re.finditer(r"[A-Za-z0-9_]+|[^\sA-Za-z0-9_]", low):
            for term, key in self.first.get(m[0], ()):
                end = m.start() + len(term)
                if low.startswith(term, m.start()) and not (end < len(low) and re.match(r"[A-Za-z0-9_]", low[end])) and not (m.start() and re.match(r"[A-Za-z0-9_]", low[m.start() - 1])):
                    out.append((m.start() + 1, end, key, term))
        return out


def resolve(hits: list[tuple[int, int, str, str]]) -> list[tuple[int, int, str, str]]:
    """In the order of start, longer first, key: each hit still there drops the others it overlaps
    that are no longer than itself. Only neighbours by position are looked at."""
    order = sorted(set(hits), key=lambda h: (h[0], -(h[1] - h[0]), h[2]))
    longest = max((h[1] - h[0] for h in order), default=0)
    gone = [False] * len(order)
    for i, a in enumerate(order):
        if gone[i]:
            continue
        j = i + 1
        while j < len(order) and order[j][0] <= a[1]:
            gone[j] = gone[j] or order[j][1] - order[j][0] <= a[1] - a[0]
            j += 1
        j = i - 1
        while j >= 0 and order[j][0] >= a[0] - longest:
            gone[j] = gone[j] or order[j][1] >= a[0] and order[j][1] - order[j][0] <= a[1] - a[0]
            j -= 1
    return [h for h, g in zip(order, gone) if not g]


def _mentions(matcher: Matcher, sources: list[str], around: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [], [], [])
            ids = batch.column("id").to_pylist()
            for source in sources:
                for i, text in zip(ids, batch.column(source).to_pylist()):
                    for start, end, key, _ in resolve(matcher.find(text)) if text else ():
                        context = re.sub(r"[ \t\n\r\f]+", " ", text[max(0, start - 1 - around) : end + around]).strip(" ")
                        for column, value in zip(out, (i, source, key, text[start - 1 : end], start, end, context)):
                            column.append(value)
            types = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=["id", "source", "key", "matched_text", "match_start", "match_end", "context"])

    return run


def find_mentions(texts: DataFrame, terms: DataFrame, sources: list[str], around: int = 100) -> DataFrame:
    """id, source, key, matched_text, match_start, match_end, context (up to ``around`` characters on
    each side, squished); ``texts`` has id and the sources, ``terms`` has term and key."""
    rows = terms.where("term is not null and trim(term) <> ''").select("term", "key").distinct().limit(MOST_TERMS + 1).collect()
    if len(rows) > MOST_TERMS:
        raise ValueError(f"the dictionary has more than {MOST_TERMS} terms")
    matcher = Matcher([(r.term, r.key) for r in rows])
    schema = "id bigint, source string, key string, matched_text string, match_start int, match_end int, context string"
    return texts.select(F.col("id").cast("bigint").alias("id"), *sources).mapInArrow(_mentions(matcher, sources, around), schema)


def species_mentions(records: DataFrame, dictionary: DataFrame, key: str = "record_sequence") -> DataFrame:
    """Mentions of the dictionary's synonyms with the species they name."""
    texts = records.select(F.col(key).alias("id"), "title", "abstract")
    hits = find_mentions(texts, dictionary.select(F.col("synonym").alias("term"), F.col("species_id").alias("key")), ["title", "abstract"]).drop("context")
    species = dictionary.groupBy(F.col("species_id").alias("key")).agg(
        F.min("preferred_name").alias("preferred_name"), F.min("scientific_name").alias("scientific_name"), F.max("is_farmed_candidate").alias("is_farmed_candidate"), F.min("default_group").alias("default_group")
    )
    return hits.join(species, "key").withColumnRenamed("key", "species_id")


#: Generic terms that speak of farming by themselves, and the distance that a
#: mention of a non-candidate species reaches.
FARMING = ("salmon farm", "salmon farms", "farmed salmon", "salmon aquaculture", "salmon cage", "salmon cages", "salmon pen", "salmon pens")
REACH = 120


#: How a generic mention is known, the genus whose non-candidates rule it out, and the reason given.
GENERIC_NAME, GENERIC_ID = "unspecified farmed salmon", "unspecified.*salmon|generic.*salmon"
GENUS = "Salmo"
NEAR_NON_TARGET = "Generic salmon mention located near a named non-target Salmo species"
#: The id that gives way to specific species, and the one that is not specific enough for that.
UNSPECIFIED, WEAK = "UNSPEC_SALMON", ("ONC_MYKISS",)


def is_generic(name: Column, species_id: Column) -> Column:
    return (F.lower(F.coalesce(name, F.lit(""))) == GENERIC_NAME) | F.lower(F.coalesce(species_id, F.lit(""))).rlike(GENERIC_ID)


def filter_generic(mentions: DataFrame, generic: Column | None = None, genus: str = GENUS) -> DataFrame:
    """mention_eligible and filter_reason: FALSE for a generic mention, farming phrases apart, whose
    middle lies within REACH of a mention of a non-candidate species of the genus in the same text."""
    middle = (F.col("match_start") + F.col("match_end")) / 2
    generic = is_generic(F.col("preferred_name"), F.col("species_id")) if generic is None else generic
    marked = mentions.withColumn("mid", middle).withColumn("generic", generic & ~F.lower("matched_text").isin(*FARMING))
    other = F.coalesce("scientific_name", F.lit("")).rlike(rf"(?i)^{genus}\s+[A-Za-z-]+$") & ~F.coalesce("is_farmed_candidate", F.lit(False))
    others = marked.where(other).select(F.col("id").alias("oid"), F.col("source").alias("os"), F.col("mid").alias("om")).distinct()
    cell = lambda c: F.floor(c / REACH)
    near = (
        marked.where("generic")
        .select("id", "source", "match_start", "match_end", "species_id", "mid", F.explode(F.array(cell(F.col("mid")) - 1, cell(F.col("mid")), cell(F.col("mid")) + 1)).alias("c"))
        .join(others.withColumn("oc", cell(F.col("om"))), (F.col("id") == F.col("oid")) & (F.col("source") == F.col("os")) & (F.col("c") == F.col("oc")))
        .where(F.abs(F.col("mid") - F.col("om")) <= REACH)
        .select("id", "source", "match_start", "match_end", "species_id")
        .distinct()
        .withColumn("hit", F.lit(True))
    )
    joined = marked.join(near, ["id", "source", "match_start", "match_end", "species_id"], "left")
    return joined.withColumns({"mention_eligible": F.col("hit").isNull(), "filter_reason": F.when(F.col("hit"), NEAR_NON_TARGET)}).drop("hit", "mid", "generic")


def assign_species(mentions: DataFrame, ids: DataFrame, generic_id: str | None = UNSPECIFIED, weak: tuple[str, ...] = WEAK) -> DataFrame:
    """One row per farmed species of a record, or one unresolved row: role, reason, other species.

    ``mentions`` has id, species_id, preferred_name, is_farmed_candidate and mention_eligible;
    ``generic_id`` gives way to any specific species but the ``weak`` ones.
    """
    unique = mentions.where("mention_eligible").select("id", "species_id", "preferred_name", "is_farmed_candidate").distinct()
    farmed = unique.where("is_farmed_candidate")
    if generic_id:
        specific = farmed.where(~F.col("species_id").isin(generic_id, *weak)).select("id").distinct().withColumn("s", F.lit(True))
        farmed = farmed.join(specific, "id", "left").where((F.col("species_id") != generic_id) | F.col("s").isNull()).drop("s")
    others = unique.where("not is_farmed_candidate").groupBy("id").agg(v.joined_distinct(F.col("preferred_name")).alias("non_target_species"))
    count = farmed.groupBy("id").agg(F.count("*").alias("n"))
    named = farmed.join(count, "id").select(
        "id", F.col("species_id").alias("farmed_species_id"), F.col("preferred_name").alias("farmed_species"),
        F.when(F.col("n") == 1, "primary").otherwise("co-primary").alias("assignment_role"), F.lit(False).alias("review_required"),
        F.when(F.col("n") == 1, "One eligible farmed species detected").otherwise(F.concat(F.col("n").cast("string"), F.lit(" eligible farmed species detected; none treated as primary"))).alias("assignment_reason"),
    )
    open_ = ids.select("id").join(count, "id", "left_anti").join(others.select("id", F.lit(True).alias("other")), "id", "left").select(
        "id", F.lit(None).cast("string").alias("farmed_species_id"), F.lit(None).cast("string").alias("farmed_species"), F.lit("unresolved").alias("assignment_role"),
        F.lit(True).alias("review_required"), F.when(F.col("other"), "Only non-target species detected").otherwise("No eligible farmed species detected").alias("assignment_reason"),
    )
    return named.unionByName(open_).join(others, "id", "left")


def annotate_species(records: DataFrame, dictionary: DataFrame, key: str = "record_sequence") -> dict[str, DataFrame]:
    """mentions, assignments and failures of all records: search, filter and assignment together.

    Records that cannot be read (no key, or a key that recurs) are failures, with the reason; the
    others are annotated.
    """
    text = F.col(key).cast("string")
    seen = records.groupBy(text.alias("k")).agg(F.count("*").alias("n"))
    told = records.withColumn("k", text).join(seen, "k", "left")
    error = F.when(F.col(key).isNull(), "the record has no key").when(F.col("n") > 1, "the key is not unique")
    failures = told.withColumn("error", error).where("error is not null").select(key, "title", "error")
    good = told.where(error.isNull()).drop("k", "n")
    mentions = filter_generic(species_mentions(good, dictionary, key))
    return {"mentions": mentions, "assignments": assign_species(mentions, good.select(F.col(key).cast("bigint").alias("id"))), "failures": failures}


#: Context that makes a place an artefact, and phrases that rank a mention. All of
#: them count anywhere in the context, inside words too.
ARTEFACTS = (
    "copyright", "all rights reserved", "creative commons", "published by", "publisher", "springer", "elsevier", "wiley", "taylor & francis",
    "translate with", "translation", "language selector", "software", "version", "manufacturer", "manufactured by", "supplied by", "provided by",
    "purchased from", "equipment", "instrument", "microscope", "camera", "reader", "incubator", "analyser", "analyzer",
)
LOCATION = "|".join((
    "conducted in", "conducted at", "study was carried out in", "study was undertaken in", "study was performed in", "study area", "study site", "study sites",
    "sampled in", "sampled from", "samples were collected in", "samples were collected from", "collected in", "collected from", "obtained in", "obtained from",
    "farms in", "farm in", "fish farms in", "aquaculture farms in", "sites in", "site in", "located in", "reared in", "raised in", "cultured in", "produced in",
    "originating from", "originated from", "surveyed in", "interviewed in", "fieldwork in", "case study in",
))
ENTITY = "|".join((
    "stakeholder", "stakeholders", "farmer", "farmers", "producer", "producers", "company", "companies", "industry", "industries", "farm", "farms",
    "hatchery", "hatcheries", "population", "populations", "community", "communities", "river", "rivers", "lake", "lakes", "site", "sites",
))
BACKGROUND = "|".join((
    "previous studies in", "previous research in", "reported in", "reported from", "compared with", "compared to", "unlike", "elsewhere in",
    "for example in", "such as", "including",
))


def tier(source: Column, context: Column) -> Column:
    """1 title, 2 a study location, 3 a place word without background, 5 background, else 4."""
    low = F.lower(context)
    return (
        F.when(F.lower(source) == "title", 1).when(low.rlike(LOCATION), 2).when(low.rlike(ENTITY) & ~low.rlike(BACKGROUND), 3).when(low.rlike(BACKGROUND), 5).otherwise(4)
    )


def usable_mention(match: Column, context: Column, country: Column) -> Column:
    """Not an artefact, not an adjective of a fish, not a genus that is also a country."""
    low = F.lower(context)
    clean = F.lit(True)
    for word in ARTEFACTS:
        clean = clean & ~F.contains(low, F.lit(word))
    fish = F.regexp_like(low, F.concat(F.lit(r"\b"), F.regexp_replace(F.lower(match), r"([^a-z0-9 ])", r"\\$1"), F.lit(r"\s+(salmon|trout|char|grayling|fish)\b")))
    genus = low.rlike(r"\banguilla\s+[a-z][a-z-]+\b") & F.lower(country).isin("anguilla", "antigua and barbuda")
    return clean & ~fish & ~genus


def rank_countries(mentions: DataFrame) -> DataFrame:
    """id, iso3c, country_name, best_tier, title, substantive and total mentions, and of the record
    the number of countries in the title and whether a region stands there."""
    kept = mentions.where((F.coalesce("iso3c", F.lit("")) != "") & usable_mention(F.col("matched_text"), F.col("context"), F.col("country_name")))
    tiered = kept.withColumn("tier", tier(F.col("source"), F.col("context")))
    ranking = tiered.groupBy("id", "iso3c", "country_name").agg(
        F.min("tier").alias("best_tier"), F.count_if(F.lower("source") == "title").alias("title_mentions"), F.count_if(F.col("tier") <= 3).alias("substantive_mentions"), F.count("*").alias("total_mentions")
    )
    titles = tiered.where(F.lower("source") == "title").groupBy("id").agg(F.count_distinct("iso3c").alias("title_country_count"))
    regions = mentions.where((F.lower("source") == "title") & (F.coalesce("iso3c", F.lit("")) == "") & (F.coalesce("region_name", F.lit("")) != "")).select("id").distinct()
    return (
        ranking.join(titles, "id", "left").join(regions.withColumn("region", F.lit(True)), "id", "left")
        .select(*ranking.columns, F.coalesce("title_country_count", F.lit(0)).alias("title_country_count"), F.coalesce("region", F.lit(False)).alias("title_has_region_scope"))
    )


def primary_countries(ranking: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(assignments, review): countries of the title; else the one that leads by tier, substantive
    and total mentions; ties and titles that name a region go to review."""
    titled = ranking.where("title_country_count > 0 and title_mentions > 0").select(
        "id", "iso3c", "country_name", F.when(F.col("title_country_count") == 1, "Country in title").otherwise("Countries co-named in title").alias("assignment_reason")
    )
    open_ = ranking.where("title_country_count = 0 and not title_has_region_scope")
    lead = F.rank().over(Window.partitionBy("id").orderBy("best_tier", F.desc("substantive_mentions"), F.desc("total_mentions")))
    first = open_.withColumn("r", lead).where("r = 1").withColumn("ties", F.count("*").over(Window.partitionBy("id")))
    single = first.where("ties = 1").select("id", "iso3c", "country_name", F.lit("Leading abstract evidence").alias("assignment_reason"))
    tied = first.where("ties > 1").select("id", F.lit("Abstract candidates remain exactly tied").alias("review_reason")).distinct()
    region = ranking.where("title_has_region_scope").select("id", F.lit("Title names a region").alias("review_reason")).distinct()
    return titled.unionByName(single), tied.unionByName(region)


def country_summary(assignments: DataFrame, review: DataFrame) -> DataFrame:
    """One row per record that was assigned or has to be reviewed."""
    named = assignments.groupBy("id").agg(
        v.joined_distinct(F.col("country_name")).alias("primary_countries"), v.joined_distinct(F.col("iso3c")).alias("primary_iso3c"),
        F.count_distinct("iso3c").alias("primary_country_count"), v.joined_distinct(F.col("assignment_reason")).alias("assignment_reasons"),
    )
    why = review.groupBy("id").agg(v.joined_distinct(F.col("review_reason")).alias("review_reason"))
    return named.join(why, "id", "full").select(
        "id", "primary_countries", "primary_iso3c", F.coalesce("primary_country_count", F.lit(0)).alias("primary_country_count"), "assignment_reasons", "review_reason",
        F.col("review_reason").isNotNull().alias("review_required"),
    )


def place_mentions(records: DataFrame, gazetteer: DataFrame, key: str = "record_sequence", around: int = 100) -> DataFrame:
    """Mentions of places with their context. Of several places of one name the first counts, by
    matched_place, then the gazetteer's ``position`` where it has one, then the other columns."""
    texts = records.select(F.col(key).alias("id"), "title", "abstract")
    hits = find_mentions(texts, gazetteer.select(F.col("matched_place").alias("term"), F.lower("matched_place").alias("key")), ["title", "abstract"], around)
    place = F.struct("matched_place", "country_name", "iso3c", "region_name")
    order = F.struct("matched_place", *(["position"] if "position" in gazetteer.columns else []), *[F.coalesce(c, F.lit("\uffff")) for c in ("iso3c", "country_name", "region_name")])
    rows = gazetteer.groupBy(F.lower("matched_place").alias("key")).agg(F.min_by(place, order).alias("p"))
    return hits.join(rows, "key").select("id", "source", "matched_text", "p.*", "match_start", "match_end", "context")
