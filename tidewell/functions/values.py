"""Column functions for delimited lists, hierarchy paths and canonical labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import squish

#: Texts that stand for a missing topic or label.
BAD_TOPIC = ("na", "n/a", "nan", "null", "none", "unknown", "unspecified", "not applicable", "")


def clean_label(text: Column) -> Column:
    """Squished; NULL for placeholders."""
    bare = squish(text)
    return F.when(~F.lower(bare).isin(*BAD_TOPIC), bare)


def split_values(text: Column) -> Column:
    """Array of a JSON list or of a text delimited by ; | → or >>; placeholders left out, order kept."""
    bare = F.trim(F.coalesce(text, F.lit("")))
    parts = F.coalesce(F.when(bare.startswith("["), F.from_json(bare, "array<string>")), F.split(bare, r"\s*(?:;|\||→|>>)\s*"))
    return F.filter(F.transform(parts, lambda x: clean_label(x)), lambda x: x.isNotNull())


def hierarchy_paths(text: Column) -> Column:
    """Array of paths, each an array of its level names; paths are delimited by ";"."""
    paths = F.filter(F.split(F.coalesce(text, F.lit("")), r"\s*;\s*"), lambda p: clean_label(p).isNotNull())
    return F.filter(
        F.transform(paths, lambda p: F.filter(F.transform(F.split(p, r"\s*(?:→|>>|/|>)\s*"), lambda x: clean_label(x)), lambda x: x.isNotNull())),
        lambda a: F.size(a) > 0,
    )


def prefixes(path: Column) -> Column:
    """All beginnings of a path, joined by " > "."""
    return F.transform(F.sequence(F.lit(1), F.size(path)), lambda i: F.array_join(F.slice(path, F.lit(1), i), " > "))


def level_values(paths: Column, level: int) -> Column:
    """Distinct names at a level (from 0) of all paths, first seen first."""
    return F.array_distinct(F.filter(F.transform(paths, lambda p: F.get(p, F.lit(level))), lambda x: x.isNotNull()))


def level_pairs(path: Column, most: int = 8) -> Column:
    """(root, parent, child) of neighbouring levels of a path, the first ``most``."""
    steps = F.when(F.size(path) >= 2, F.sequence(F.lit(1), F.size(path) - 1)).otherwise(F.array().cast("array<int>"))
    return F.slice(
        F.transform(steps, lambda i: F.struct(F.get(path, F.lit(0)).alias("root"), F.get(path, i - 1).alias("parent"), F.get(path, i).alias("child"))), 1, most
    )


def drop_values(text: Column, gone: list[str]) -> Column:
    """A "; " list without the named values (case apart)."""
    kept = F.filter(split_values(text), lambda x: ~F.lower(x).isin([g.lower() for g in gone]))
    return F.array_join(kept, "; ")


def canonical_species(name: Column) -> Column:
    """Blank or unspecified names to "Unspecified species", the rainbow spellings to one."""
    low = F.lower(squish(F.coalesce(name, F.lit(""))))
    return (
        F.when(low.isin(*BAD_TOPIC) | (low.contains("unspecified") & low.rlike("salmon|salmonid|species")), "Unspecified species")
        .when(low.isin("rainbow salmon", "rainbow_trout", "rainbow trout"), "Rainbow trout")
        .otherwise(squish(name))
    )


#: The names that figures show, and the spellings counted with one of them.
SHOWN_SPECIES = ("Atlantic salmon", "Chinook salmon", "Chum salmon", "Coho salmon", "Masu salmon", "Pink salmon", "Rainbow trout", "Sockeye salmon", "Unspecified species")
COUNTED_AS = {"steelhead": "Rainbow trout", "steelhead trout": "Rainbow trout", "rainbow salmon": "Rainbow trout", "farmed salmon": "Unspecified species"}


def figure_species(name: Column) -> Column:
    """Name of a species in figures: spellings counted with a shown name, unspecified ones together;
    other names stay, for ``unshown_species`` to report."""
    bare = squish(F.coalesce(name, F.lit("")))
    low = F.lower(bare)
    counted = F.create_map(*[F.lit(x) for pair in (COUNTED_AS | {s.lower(): s for s in SHOWN_SPECIES}).items() for x in pair])
    return F.when((low == "") | low.startswith("unspecified"), "Unspecified species").otherwise(F.coalesce(F.element_at(counted, low), bare))


def joined_distinct(values: Column) -> Column:
    """Sorted distinct non-empty values of a group joined by "; ", NULL when there are none."""
    return F.nullif(F.array_join(F.array_sort(F.collect_set(F.nullif(values, F.lit("")))), "; "), F.lit(""))
