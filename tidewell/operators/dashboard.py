"""Counts, cross-tabulations, the topic tree and the record search behind a dashboard."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as t
from ..functions import values as v

#: Territories counted with a country, and the code that names none.
COUNTED_WITH = {"SJM": "NOR", "JEY": "GBR", "IMN": "GBR"}
NO_COUNTRY = "NONE"


def record_view(master: DataFrame) -> DataFrame:
    """record_id, year and the arrays species, iso3 and paths of each master record."""
    species = F.array_distinct(F.transform(v.split_values(F.col("final_species")), lambda s: v.canonical_species(s)))
    return master.select(
        "record_id", F.col("year").try_cast("double").try_cast("int").alias("year"), "title", "abstract",
        F.when(F.size(species) == 0, F.array(F.lit("Unspecified species"))).otherwise(species).alias("species"),
        v.split_values(F.col("final_primary_country_iso3c")).alias("iso3"), v.hierarchy_paths(F.col("topic_hierarchy_paths")).alias("paths"),
    )


def unique_records(view: DataFrame, *keys: Column) -> DataFrame:
    """Number of different records per key; partial counts of distinct ids are merged, not collected."""
    return view.groupBy(*keys).agg(F.count_distinct("record_id").alias("records"))


def species_counts(view: DataFrame) -> DataFrame:
    return unique_records(view.select("record_id", F.explode("species").alias("species")), F.col("species"))


def country_of(iso: Column) -> Column:
    code = F.upper(iso)
    mapped = F.create_map(*[F.lit(x) for pair in COUNTED_WITH.items() for x in pair])
    return F.nullif(F.coalesce(F.element_at(mapped, code), code), F.lit(NO_COUNTRY))


def country_counts(view: DataFrame) -> DataFrame:
    rows = view.select("record_id", F.explode(F.transform("iso3", lambda c: country_of(c))).alias("iso3")).where("iso3 is not null")
    return unique_records(rows, F.col("iso3"))


def country_species_counts(view: DataFrame) -> DataFrame:
    rows = view.select("record_id", "species", F.explode(F.transform("iso3", lambda c: country_of(c))).alias("iso3")).where("iso3 is not null")
    return unique_records(rows.select("record_id", "iso3", F.explode("species").alias("species")), F.col("iso3"), F.col("species"))


def prefix_rows(view: DataFrame, *keep: str) -> DataFrame:
    """One row per record and beginning of one of its paths: prefix, depth, parent and name."""
    rows = view.select("record_id", *keep, F.explode("paths").alias("path"))
    rows = rows.select("record_id", *keep, "path", F.posexplode(v.prefixes(F.col("path"))).alias("at", "prefix"))
    return rows.select(
        "record_id", *keep, "prefix", (F.col("at") + 1).alias("depth"), F.get("path", F.col("at")).alias("name"),
        F.when(F.col("at") > 0, F.array_join(F.slice("path", F.lit(1), F.col("at")), " > ")).alias("parent"),
    )


def topic_tree(view: DataFrame) -> DataFrame:
    """The tree as rows: prefix, depth, parent, name and unique records."""
    return unique_records(prefix_rows(view), *[F.col(c) for c in ("prefix", "depth", "parent", "name")])


def topic_level_counts(view: DataFrame) -> DataFrame:
    return unique_records(prefix_rows(view).select("record_id", "depth", "name"), F.col("depth"), F.col("name"))


def species_topic_counts(view: DataFrame) -> DataFrame:
    rows = prefix_rows(view, "species").select("record_id", "prefix", F.explode("species").alias("species"))
    return unique_records(rows, F.col("species"), F.col("prefix"))


def terminal_topics(view: DataFrame) -> DataFrame:
    """Unique records per last name of any path."""
    rows = view.select("record_id", F.explode("paths").alias("p")).select("record_id", F.element_at("p", -1).alias("topic"))
    return unique_records(rows, F.col("topic"))


def finest_topics(view: DataFrame) -> DataFrame:
    """Unique records per last name of the record's deepest paths."""
    deepest = F.array_max(F.transform("paths", lambda p: F.size(p)))
    rows = view.select("record_id", F.explode(F.filter("paths", lambda p: F.size(p) == deepest)).alias("p"))
    return unique_records(rows.select("record_id", F.element_at("p", -1).alias("topic")), F.col("topic"))


def topic_rollup(view: DataFrame) -> DataFrame:
    """Unique records per level_1, level_2, level_3 and their subtotals."""
    rows = view.select("record_id", F.explode("paths").alias("p")).select("record_id", *[F.get("p", F.lit(i)).alias(f"level_{i + 1}") for i in range(3)])
    return rows.rollup("level_1", "level_2", "level_3").agg(F.count_distinct("record_id").alias("records"), F.grouping_id().cast("int").alias("grouping"))


def topic_coverage(view: DataFrame) -> DataFrame:
    """One row: records, records without topics, assignments and different paths."""
    path = F.transform("paths", lambda p: F.array_join(p, " > "))
    whole = view.agg(F.count("*").alias("records"), F.count_if(F.size("paths") == 0).alias("without_topics"), F.sum(F.size("paths")).cast("bigint").alias("assignments"))
    unique = view.select(F.explode(path).alias("path")).agg(F.count_distinct("path").alias("unique_paths"))
    return whole.crossJoin(unique)  # two tables of one row


def ontology_prefixes(ontology: DataFrame) -> DataFrame:
    path = F.filter(F.array("level_1", "level_2", "level_3"), lambda x: x.isNotNull())
    return ontology.select(F.explode(v.prefixes(path)).alias("prefix")).distinct()


def valid_paths(view: DataFrame, ontology: DataFrame) -> DataFrame:
    """record_id, position and path of the paths that are a beginning in the ontology."""
    rows = view.select("record_id", F.posexplode(F.array_distinct(F.transform("paths", lambda p: F.array_join(p, " > ")))).alias("at", "prefix"))
    kept = rows.join(ontology_prefixes(ontology), "prefix", "left_semi")
    return kept.select("record_id", (F.col("at") + 1).alias("position"), F.col("prefix").alias("path"))


def ontology_audit(view: DataFrame, ontology: DataFrame) -> DataFrame:
    """Per depth: assignments, unique paths, and those the ontology lacks."""
    rows = view.select("record_id", F.explode("paths").alias("p")).select("record_id", F.size("p").alias("depth"), F.array_join("p", " > ").alias("prefix"))
    known = ontology_prefixes(ontology).withColumn("known", F.lit(True))
    out = F.col("known").isNull()
    return rows.join(known, "prefix", "left").groupBy("depth").agg(
        F.count("*").alias("assignments"), F.count_distinct("prefix").alias("unique_paths"), F.count_distinct(F.when(out, F.col("prefix"))).alias("unmapped_paths"),
        F.count_distinct(F.when(out, F.col("record_id"))).alias("unmapped_records"),
    )


def unmapped_paths(view: DataFrame, ontology: DataFrame, most: int = 20) -> DataFrame:
    """The ``most`` used paths that the ontology lacks, with their records and assignments."""
    rows = view.select("record_id", F.explode("paths").alias("p")).select("record_id", F.array_join("p", " > ").alias("path"))
    lacking = rows.join(ontology_prefixes(ontology).withColumnRenamed("prefix", "path"), "path", "left_anti")
    counts = lacking.groupBy("path").agg(F.count_distinct("record_id").alias("records"), F.count("*").alias("assignments"))
    return counts.orderBy(F.desc("assignments"), "path").limit(most)


def level_pairs(view: DataFrame) -> DataFrame:
    """(root, parent, child) of neighbouring levels with unique records."""
    rows = view.select("record_id", F.explode("paths").alias("p")).select("record_id", F.explode(v.level_pairs(F.col("p"))).alias("s")).select("record_id", "s.*")
    return unique_records(rows, F.col("root"), F.col("parent"), F.col("child"))


def matches(view: DataFrame, species: str = "", country: str = "", topic: str = "", text: str = "") -> DataFrame:
    """The records that meet all filters."""
    rows = view
    if species:
        rows = rows.where(F.array_contains("species", species))
    if country:
        rows = rows.where(F.array_contains("iso3", country))
    if topic:
        inside = F.exists("paths", lambda p: (F.array_join(p, " > ") == topic) | F.array_join(p, " > ").startswith(topic + " > "))
        rows = rows.where(inside)
    if text:
        everything = F.concat_ws(" ", "title", "abstract", F.col("year").cast("string"), F.array_join("species", " "), F.array_join("iso3", " "))
        rows = rows.where(F.contains(F.lower(everything), F.lit(text.lower())))
    return rows


def natural_key(text: Column) -> Column:
    """Sort key that knows no case and no accents and takes runs of digits for numbers."""
    return F.regexp_replace(F.regexp_replace(t.to_ascii(text), r"(\d+)", "000000000000$1"), r"0*(\d{12})(?!\d)", "$1")


def page_of(found: int, page: int, size: int) -> tuple[int, int, int, int]:
    """(page within bounds, pages, first and last row shown); nothing found shows 0 to 0 of one page."""
    pages = max(1, -(-found // size))
    page = min(max(page, 1), pages)
    return page, pages, (page - 1) * size + 1 if found else 0, min(page * size, found)


def search(
    view: DataFrame, species: str = "", country: str = "", topic: str = "", text: str = "", order: str = "title", ascending: bool = True, page: int = 1, size: int = 50
) -> DataFrame:
    """One page of the records that meet all filters; blank and untitled ones sort last whatever the order."""
    rows = matches(view, species, country, topic, text)
    blank = F.lower(F.coalesce(F.trim("title"), F.lit(""))).isin("", "untitled")
    key = natural_key(F.col(order)) if dict(view.dtypes)[order] == "string" else F.col(order)
    ordered = rows.orderBy(blank, key.asc_nulls_last() if ascending else key.desc_nulls_last(), "record_id")
    return ordered.offset((max(page, 1) - 1) * size).limit(size)


def natural_breaks(counts: list[float], classes: int = 7) -> list[float]:
    """Fisher-Jenks upper bounds of at most ``classes`` classes of the positive counts, exact by
    dynamic programming over the different values (there are as many as countries)."""
    values = sorted({c for c in counts if c > 0})
    weight = [counts.count(x) for x in values]
    k = min(classes, len(values))
    if not k:
        return []
    n, total, square, first = [0], [0.0], [0.0], range(len(values))
    for x, w in zip(values, weight):
        n.append(n[-1] + w)
        total.append(total[-1] + w * x)
        square.append(square[-1] + w * x * x)

    def spread(i: int, j: int) -> float:
        """Squared deviations of values i..j from their mean."""
        m = n[j + 1] - n[i]
        s = total[j + 1] - total[i]
        return square[j + 1] - square[i] - s * s / m

    best = [spread(0, j) for j in first]
    cuts: list[list[int]] = []
    for _ in range(1, k):
        new, at = [], []
        for j in first:
            options = [(best[i - 1] + spread(i, j), i) for i in range(1, j + 1)] or [(best[j], 0)]
            got = min(options)
            new.append(got[0])
            at.append(got[1])
        best = new
        cuts.append(at)
    bounds, j = [values[-1]], len(values) - 1
    for at in reversed(cuts):
        j = at[j] - 1
        if j < 0:
            break
        bounds.append(values[j])
    return sorted(set(bounds))


def count_classes(counts: DataFrame, classes: int = 7) -> DataFrame:
    """Adds the Fisher-Jenks class (1..) of ``records``, 0 for none; one row per country comes in."""
    bounds = natural_breaks([float(r.records) for r in counts.select("records").collect()], classes)
    chosen = F.lit(0)
    for i, bound in reversed(list(enumerate(bounds, 1))):
        chosen = F.when(F.col("records") <= bound, i).otherwise(chosen)
    return counts.withColumn("class", F.when(F.col("records") <= 0, 0).otherwise(chosen))
