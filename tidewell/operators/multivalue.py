"""Several values packed in one field, split by a parsing expression grammar.

    cell      <- list / delimited
    list      <- '[' (quoted (',' quoted)*)? ']'
    delimited <- value (delimiter value)*           one delimiter per cell, the first of the
                                                    profile's ordered choice that is present
    value     <- quoted / bracketed / bare          a quote that never closes, or closes before
                                                    more text, is taken back and read as bare

The grammar is the same for every column; a ``Profile`` gives the delimiters in their order of
choice and what a whole value looks like (a code, a path of levels, a name).

Defined results: NULL, empty and placeholder cells give no rows; empty values between delimiters
give no row and no position; a cell with one value gives one row; repeated values keep their own
positions; a malformed quote gives the value as written with flag ``unclosed_quote`` and a broken
list gives what its quoted parts hold with flag ``broken_list``.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PLACEHOLDERS = ("na", "n/a", "-", "nan", "null", "none", "")

#: Words that say how an animal was kept, aged or doubted; used to tell "juveniles, x" from a list.
QUALIFIERS = frozenset(
    "wild farmed cultured caged juvenile juveniles juv adult adults triploid diploid sp spp stocked hatchery reared captive".split()
)


@dataclass(frozen=True)
class Profile:
    """How the values of one column look.

    delimiters: regular expressions in order of choice. whole: a bare value between delimiters
    that is no whole value by itself is joined to its neighbour. levels: number of levels of a
    path, 0 where values are no paths. inverted: "genus, species" written backwards is one value.
    """

    delimiters: tuple[str, ...]
    levels: int = 0
    level_separator: str = r">>|>|→"
    inverted: bool = False
    qualifiers: frozenset[str] = field(default=QUALIFIERS)


CODES = Profile((r"(?:\s*[;|,/&+→-])+\s*|\s+",))  # a code holds neither white space nor signs
PATHS = Profile((r"\n", r"\t", r";;", r"\|", r";"), levels=3)
NAMES = Profile(
    (r"[\n\t]", r";", r"\|", r"\s/\s|/", r"→", r"\s&\s", r"\s\+\s", r"\sand\s", r","), inverted=True
)

_QUOTES = {'"': '"', "“": "”", "«": "»"}
_BRACKETS = {"(": ")", "[": "]"}
_GUARDED = re.compile(r'["“«(\[]')


def _quoted(text: str, at: int) -> tuple[str, int] | None:
    """quoted <- quote (escape / doubled quote / other)* quote; the value and the place after it."""
    end = _QUOTES[text[at]]
    out, i = [], at + 1
    while i < len(text):
        c = text[i]
        if c == "\\" and i + 1 < len(text):
            code = re.match(r"\\u([0-9a-fA-F]{4})", text[i:])
            if code:
                out.append(chr(int(code[1], 16)))
                i += 6
                continue
            out.append({"n": "\n", "t": "\t"}.get(text[i + 1], text[i + 1]))
            i += 2
        elif c == end:
            if i + 1 < len(text) and text[i + 1] == end and end == '"':
                out.append(end)
                i += 2
                continue
            return "".join(out), i + 1
        else:
            out.append(c)
            i += 1
    return None


def _bracketed(text: str, at: int) -> int | None:
    """bracketed <- open (bracketed / other)* close; the place after it."""
    depth, pairs = [], _BRACKETS
    for i in range(at, len(text)):
        if text[i] in pairs:
            depth.append(pairs[text[i]])
        elif depth and text[i] == depth[-1]:
            depth.pop()
            if not depth:
                return i + 1
    return None


def _pieces(text: str, delimiter: re.Pattern) -> tuple[list[tuple[str, bool]], str]:
    """delimited <- value (delimiter value)*; (value, was it quoted) and an error flag."""
    if not _GUARDED.search(text):
        return [(value, False) for part in delimiter.split(text) if (value := part.strip())], ""
    out: list[tuple[str, bool]] = []
    flag, i, start = "", 0, 0

    def bare(stop: int) -> None:
        if value := text[start:stop].strip():
            out.append((value, False))

    while i <= len(text):
        if i < len(text) and text[i] in _QUOTES and not text[start:i].strip():
            got = _quoted(text, i)
            if got:
                after = re.compile(r"\s*").match(text, got[1]).end()
                step = delimiter.match(text, got[1]) or delimiter.match(text, after)
                if after == len(text) or step:
                    if value := got[0].strip():
                        out.append((value, True))
                    if after == len(text):
                        return out, flag
                    i = start = max(step.end(), got[1] + 1)
                    continue
            else:
                flag = "unclosed_quote"
        if i < len(text) and text[i] in _BRACKETS:
            past = _bracketed(text, i)
            if past:
                i = past
                continue
        step = delimiter.match(text, i) if i < len(text) else None
        if step and step.end() > i:
            bare(i)
            i = start = step.end()
            continue
        if i == len(text):
            bare(i)
        i += 1
    return out, flag


def _join_levels(pieces: list[tuple[str, bool]], glue: str, profile: Profile) -> list[tuple[str, bool]]:
    """Level names may hold the delimiter: pieces join until a path has all its levels."""
    separator, want = re.compile(profile.level_separator), profile.levels - 1
    out: list[tuple[str, bool]] = []
    open_text, open_count = "", 0
    for value, quoted in pieces:
        count = len(separator.findall(value))
        if quoted:
            if open_text:
                out.append((open_text, False))
                open_text, open_count = "", 0
            out.append((value, True))
            continue
        if open_text and open_count + count > want:
            out.append((open_text, False))
            open_text, open_count = "", 0
        if not open_text and out and count == 0 and value[:1].islower():
            out[-1] = (out[-1][0] + glue + value, False)
            continue
        open_text = open_text + glue + value if open_text else value
        open_count += count
        if open_count == want:
            out.append((open_text, False))
            open_text, open_count = "", 0
    if open_text:
        out.append((open_text, False))
    return out


def _is_inverted(pieces: list[tuple[str, bool]], profile: Profile) -> bool:
    """"trout, zephyr": two bare lower-case parts of one word each, apart from qualifiers."""
    if len(pieces) != 2 or any(quoted for _, quoted in pieces):
        return False
    text = " ".join(value for value, _ in pieces)
    if text != text.lower():
        return False
    words = [
        [w for w in re.findall(r"[^\W\d_]+", re.sub(r"[(\[].*?[)\]]", " ", value)) if w not in profile.qualifiers]
        for value, _ in pieces
    ]
    return len(words[0]) <= 1 and len(words[1]) <= 1


def split_cell(cell: str | None, profile: Profile) -> tuple[list[str], str]:
    """The values of one cell in their order, and an error flag ('' where all went well)."""
    if cell is None or cell.strip().lower() in PLACEHOLDERS:
        return [], ""
    text, flag = cell.strip(), ""
    if text[0] == "[" and text[-1] == "]":
        try:
            values = json.loads(text)
            return [s for v in values if (s := str(v).strip())], ""
        except (ValueError, TypeError):
            comma = re.compile(r"\s*,\s*")
            pieces, _ = _pieces(text[1:-1], comma)
            if any(quoted for _, quoted in pieces):
                return [v for v, _ in pieces], "broken_list"
    pieces: list[tuple[str, bool]] = []
    for delimiter in profile.delimiters:
        pattern = re.compile(delimiter)
        if not pattern.search(text):
            continue
        pieces, flag = _pieces(text, pattern)
        if len(pieces) < 2:
            if pieces and pattern.search(text) and _only_padding(text, pattern):
                break
            continue
        if profile.levels and delimiter == ";":
            pieces = _join_levels(pieces, "; ", profile)
        if profile.inverted and delimiter == "," and _is_inverted(pieces, profile):
            pieces = [(", ".join(v for v, _ in pieces), False)]
        return [v for v, _ in pieces], flag
    if len(pieces) != 1:
        pieces, flag = _pieces(text, re.compile(r"(?!)"))
    return [v for v, _ in pieces], flag


def _only_padding(text: str, pattern: re.Pattern) -> bool:
    """Is the delimiter only before or after the one value, as in "; x" or "x; "?"""
    inner = text
    while m := pattern.match(inner):
        if m.end() == 0:
            break
        inner = inner[m.end() :]
    last = None
    for last in pattern.finditer(inner):
        pass
    return last is None or not inner[last.end() :].strip()


def _splitter(profiles: dict[str, Profile]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, str], tuple[list[str], str]] = {}
        for batch in batches:
            values, flags = [], []
            for name, cell in zip(batch.column("field_name").to_pylist(), batch.column("cell").to_pylist()):
                got = seen.get((name, cell))
                if got is None:
                    got = split_cell(cell, profiles[name])
                    if len(seen) < 50_000:
                        seen[(name, cell)] = got
                values.append(got[0])
                flags.append(got[1])
            keep = [batch.column(i) for i in range(batch.num_columns) if batch.schema.names[i] != "cell"]
            names = [n for n in batch.schema.names if n != "cell"]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(values, pa.list_(pa.string())), pa.array(flags, pa.string())], names=[*names, "items", "flag"]
            )

    return run


def cells_of(df: DataFrame, keys: dict[str, Column], columns: list[str]) -> DataFrame:
    """One row per cell: the keys, field_name and cell, without the cells that hold no value."""
    cells = F.array(*[F.struct(F.lit(c).alias("field_name"), F.col(c).cast("string").alias("cell")) for c in columns])
    rows = df.select(*[v.alias(k) for k, v in keys.items()], F.explode(cells).alias("_c"))
    rows = rows.select(*keys, "_c.field_name", "_c.cell")
    return rows.where(F.col("cell").isNotNull() & ~F.lower(F.trim("cell")).isin(list(PLACEHOLDERS)))


def split_cells(cells: DataFrame, profiles: dict[str, Profile]) -> DataFrame:
    """Adds ``items`` (array in order) and ``flag`` in place of ``cell``; no shuffle."""
    kept = [f for f in cells.schema.fields if f.name != "cell"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", items array<string>, flag string"
    return cells.mapInArrow(_splitter(profiles), schema)


def explode_values(cells: DataFrame, profiles: dict[str, Profile], least: int = 1) -> DataFrame:
    """One row per value with its position from 1, of cells with at least ``least`` values."""
    split = split_cells(cells, profiles).where(F.size("items") >= least)
    kept = [c for c in split.columns if c not in ("items", "flag")]
    rows = split.select(*kept, F.posexplode("items").alias("_p", "item"), "flag")
    return rows.select(*kept, (F.col("_p") + 1).cast("int").alias("position"), "item", "flag")


MASTER_FIELDS = {"topic_hierarchy_paths": PATHS, "topic_path_ids": CODES}
DASHBOARD_FIELDS = {"species": NAMES, "iso3": CODES}


def packed_values(master: DataFrame, dashboard: DataFrame, least: int = 2) -> DataFrame:
    """All values of the packed columns of both tables, without repeated rows."""
    parts = []
    for name, df, fields in (("merge_master_update", master, MASTER_FIELDS), ("build_dashboard", dashboard, DASHBOARD_FIELDS)):
        cells = cells_of(df, {"table_name": F.lit(name), "record_id": F.col("record_id")}, list(fields))
        parts.append(explode_values(cells, fields, least))
    return parts[0].unionByName(parts[1]).drop("flag").distinct()
