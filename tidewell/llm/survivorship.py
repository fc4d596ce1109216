"""Best representative of each duplicate group, field by field.

Per group one aggregation takes, for every field, the maximum of the composite
(complete, source priority, timestamp, value, member). What a complete value is depends on the
field; that a value is only the beginning of another member's value is found before, by an
equi-join of values with the prefixes of longer ones, so no group is ever gathered in one task.

Defined results: a NULL group is no group; NULL, empty and placeholder values are never complete;
without a complete value the field has no survivor; ties in the timestamp go to the greater value,
then to the greater member id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Forms of complete values.
PAGES = r"^(?:(?:pp?\.?\s*)?[A-Za-z]{0,3}\d+\s*[-–—−]+\s*[A-Za-z]{0,3}\d+|[eE]\d+)$"
URL = r"^[hH][tT][tT][pP][sS]?://[^\s/?#]+\.[^\s/?#]+/[^\s]*[^\s./…]/?$"
DOI = r"^(?:[hH][tT][tT][pP][sS]?://(?:[dD][xX]\.)?[dD][oO][iI]\.[oO][rR][gG]/)?10\.\d{4,9}/\S*[^\s.…]$"


def _balanced(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"[^(]", "")) == F.length(F.regexp_replace(text, r"[^)]", ""))


def well_formed(field: Column, value: Column) -> Column:
    """Is the trimmed value complete by its form?"""
    ellipsis = value.rlike(r"(?:\.\.\.|…)$")
    return (
        F.when(field == "pages", value.rlike(PAGES))
        .when(field == "url_raw", value.rlike(URL) & ~ellipsis)
        .when(field == "doi", value.rlike(DOI) & _balanced(value) & ~ellipsis)
        .otherwise(F.lower(value).isin("na", "n/a", "-", "null", "none", "nan", "") == F.lit(False))
    )


def comparable(field: Column, value: Column) -> Column:
    """The value as it is compared for being the beginning of another one."""
    doi = F.regexp_replace(F.lower(value), r"^https?://(?:dx\.)?doi\.org/", "")
    return F.when(field == "doi", doi).otherwise(value)


def survivors(
    records: DataFrame,
    group: str,
    member: str,
    stamp: str,
    fields: list[str],
    priority: Column | None = None,
) -> DataFrame:
    """One row per group with, for each field f, ``f_member`` and ``f_value`` (NULL if none survives)."""
    rank = F.lit(0) if priority is None else priority
    cells = F.array(*[F.struct(F.lit(f).alias("field"), F.trim(F.col(f).cast("string")).alias("value")) for f in fields])
    long = (
        records.where(F.col(group).isNotNull())
        .select(F.col(group).alias("grp"), F.col(member).alias("member"), F.col(stamp).alias("stamp"), rank.alias("rank"), F.explode(cells).alias("c"))
        .select("grp", "member", "stamp", "rank", "c.field", "c.value")
        .where("value is not null and value != ''")
        .withColumn("same", comparable(F.col("field"), F.col("value")))
        .withColumn("ok", F.coalesce(well_formed(F.col("field"), F.col("value")), F.lit(False)))
    )
    # Beginnings: the lengths that complete values of a group have (at most as many as characters
    # in the longest one) tell which prefixes of its longer values can be such a value.
    forms = long.groupBy("grp", "field", "same").agg(F.max("ok").alias("ok"))
    lengths = forms.where("ok").groupBy("grp", "field").agg(F.collect_set(F.length("same")).alias("lengths"))
    beginnings = (
        forms.join(lengths, ["grp", "field"])
        .select("grp", "field", "same", F.explode(F.filter("lengths", lambda n: n < F.length("same"))).alias("n"))
        .select("grp", "field", F.substring("same", F.lit(1), F.col("n")).alias("same"))
        .distinct()
        .withColumn("cut", F.lit(True))
    )
    judged = long.where("ok").join(beginnings, ["grp", "field", "same"], "left").where("cut is null")
    best = [
        F.max(F.when(F.col("field") == f, F.struct("rank", "stamp", "value", "member"))).alias(f) for f in fields
    ]
    found = judged.groupBy("grp").agg(*best)
    return found.select(
        F.col("grp").alias(group),
        *[c for f in fields for c in (F.col(f"{f}.member").alias(f"{f}_member"), F.col(f"{f}.value").alias(f"{f}_value"))],
    )


FIELDS = ["pages", "url_raw", "doi"]


def surviving_members(master: DataFrame) -> DataFrame:
    """Per duplicate group and field the member whose value survives."""
    best = survivors(master, "duplicate_group", "record_id", "updated_at", FIELDS)
    rows = F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f"{f}_member").alias("record_id")) for f in FIELDS])
    return (
        best.select("duplicate_group", F.explode(rows).alias("r"))
        .select("duplicate_group", "r.field_name", "r.record_id")
        .where("record_id is not null")
    )


#: How far sources are trusted, the most first; others come last.
TRUST = ("lens_api", "manual_ris", "backfile")


def trusted_records(master: DataFrame, trust: tuple[str, ...] = TRUST) -> DataFrame:
    """One record per duplicate group, each field from the most trusted source that has it complete,
    then the latest; a group without any complete value has no record."""
    place = F.array_position(F.array(*[F.lit(s) for s in trust]), F.col("source"))
    rank = F.when(place > 0, len(trust) + 1 - place).otherwise(0)
    best = survivors(master, "duplicate_group", "record_id", "updated_at", FIELDS, rank)
    return best.select("duplicate_group", *[F.col(f"{f}_value").alias(f) for f in FIELDS])
