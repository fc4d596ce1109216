"""Mapping free-entered values to a canonical list.

The reference list becomes a trie whose paths are the entries and their aliases (species part
first, parts abbreviated, written together). A typed value is levelled, its words on age, origin,
rearing and doubt are taken out, and the trie is walked with a Levenshtein automaton: the states
are rows of edit distances (swapped neighbours count once), a branch ends where no state stays
within the bound, so all entries within the bound are found. The bound depends on the length of
the value. ``all_entries`` reports them all; for a mapping the nearest wins, and
entries of two ids at the same distance leave a value unmatched.

Values are made distinct before they are looked up. The list is sent to the tasks: it is a
reference list, and one of more than ``MOST_ENTRIES`` entries is refused rather than broadcast.

Defined results: NULL, empty and placeholder values are no values; a value that is letter for
letter an entry maps to it at distance 0; a value without an entry maps to NULL.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.multivalue import NAMES, cells_of, explode_values
from ..session import spread

MOST_ENTRIES = 100_000

#: Words that do not change which species a value names.
QUALIFIERS = frozenset(
    "wild farmed farm cultured caged cage pen penned reared raised juvenile juveniles juv adult adults fry parr smolt smolts larvae eggs triploid "
    "diploid sp spp stocked hatchery captive broodstock strain cf aff probably possibly maybe presumably likely unsure uncertain approx unknown "
    "the a of and origin wildcaught caught landlocked anadromous organic rope grown".split()
)


def levelled(text: str) -> str:
    """Lower case, letters and digits, one space between words."""
    plain = "".join(c for c in unicodedata.normalize("NFKD", text.lower()) if not unicodedata.combining(c))
    return " ".join(re.findall(r"[^\W_]+", plain))


def bound(length: int) -> int:
    """Edits allowed for a levelled value of this many characters."""
    return 0 if length < 4 else 1 if length < 8 else 2


class Trie:
    """Entries and aliases by their letters; leaves hold the ids and whether only an exact hit counts."""

    def __init__(self) -> None:
        self.root: dict = {}

    def add(self, path: str, name: str, exact: bool = False) -> None:
        node = self.root
        for c in path:
            node = node.setdefault(c, {})
        node.setdefault("", set()).add((name, exact))

    def within(self, word: str, most: int) -> list[tuple[int, str]]:
        """(distance, id) of all entries within ``most`` edits."""
        found: list[tuple[int, str]] = []
        n, far = len(word), most + 1
        first = [i if i <= most else far for i in range(n + 1)]
        todo = [(self.root, "", first, None, 0)]
        while todo:
            node, last, row, before, depth = todo.pop()
            if "" in node and row[n] <= most:
                found.extend((row[n], name) for name, exact in node[""] if not exact or row[n] == 0)
            depth += 1
            low, high = max(1, depth - most), min(n, depth + most)  # states outside this band are past the bound
            for c, child in node.items():
                if not c:
                    continue
                new = [far] * (n + 1)
                if depth <= most:
                    new[0] = depth
                alive = depth <= most
                for i in range(low, high + 1):
                    cost = row[i - 1] + (word[i - 1] != c)
                    if row[i] < cost:
                        cost = row[i] + 1
                    if new[i - 1] < cost:
                        cost = new[i - 1] + 1
                    if before is not None and i > 1 and word[i - 1] == last and word[i - 2] == c and before[i - 2] < cost:
                        cost = before[i - 2] + 1
                    if cost <= most:
                        new[i] = cost
                        alive = True
                if alive:
                    todo.append((child, c, new, row, depth))
        return found

    def nearest(self, word: str, most: int) -> list[tuple[int, str]]:
        """``within`` the least bound up to ``most`` that finds anything."""
        for limit in range(most + 1):
            if found := self.within(word, limit):
                return found
        return []


def build_trie(entries: list[tuple[str, str]]) -> Trie:
    """Trie of (id, name) with the alias paths of every name."""
    trie = Trie()
    for key, name in entries:
        words = levelled(name).split()
        if not words:
            continue
        trie.add(" ".join(words), key)
        if len(words) == 2:
            a, b = words
            trie.add(f"{b} {a}", key)
            for i in range(3, len(a)):
                trie.add(f"{a[:i]} {b}", key, exact=i > 4)
            for j in range(3, len(b)):
                trie.add(f"{a} {b[:j]}", key, exact=j > 5)
        if len(words) > 1:
            trie.add("".join(words), key)
    return trie


def readings(value: str) -> list[str]:
    """Levelled forms in which the value may name an entry, the fullest first."""
    text = value.replace("?", " ").strip()
    inside = re.findall(r"[(\[]([^()\[\]]*)[)\]]", text)
    outside = re.sub(r"[(\[][^()\[\]]*[)\]]\w*", " ", text)
    forms = [outside, *inside]
    if "," in outside:  # written backwards: "salmon, juniper"
        last, _, rest = outside.partition(",")
        forms.append(f"{rest} {last}")
    for part in list(forms):
        forms.extend(re.split(r"\s+[-–—]\s*|\s*[-–—]\s+", part))
    out: list[str] = []
    for form in forms:
        apart = re.sub(r"(?<=[a-z])(?=[A-Z])", " ", form)
        words = [w for w in levelled(form).split() if w not in QUALIFIERS]
        split = [w for w in levelled(apart).split() if w not in QUALIFIERS]
        for some in (words, split, [w for w in split if not misspelt(w)]):
            if some and (got := " ".join(some)) not in out:
                out.append(got)
    return out


def misspelt(word: str) -> bool:
    """Is the word one edit from a qualifier of six letters or more, or from "wild"?"""
    return len(word) >= 4 and any(
        (len(q) >= 6 or q == "wild") and abs(len(q) - len(word)) <= 1 and _one_edit(word, q) for q in QUALIFIERS
    )


def _one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    if len(a) < len(b):
        return a[i:] == b[i + 1 :]
    return a[i + 1 :] == b[i + 1 :] or a[i : i + 2] == b[i : i + 2][::-1] and a[i + 2 :] == b[i + 2 :]


def lookup(trie: Trie, value: str) -> tuple[str | None, int | None]:
    """(id, distance) of the nearest entry of any reading; (None, None) if none or two are nearest."""
    best: list[tuple[int, str]] = []
    for form in readings(value):
        hits = trie.nearest(form, bound(len(form.replace(" ", ""))))
        if not hits and " " in form:
            tight = form.replace(" ", "")
            hits = [(d + 1, k) for d, k in trie.nearest(tight, max(0, bound(len(tight)) - 1))]
        best.extend(hits)
        if hits and min(hits)[0] == 0:
            break
    if not best:
        return None, None
    least = min(best)[0]
    names = {k for d, k in best if d == least}
    return (names.pop(), least) if len(names) == 1 else (None, None)


def within(trie: Trie, value: str) -> list[tuple[str, int]]:
    """(id, least distance) of all entries within the bound of any reading, ties and all."""
    least: dict[str, int] = {}
    for form in readings(value):
        for d, k in trie.within(form, bound(len(form.replace(" ", "")))):
            least[k] = min(d, least.get(k, d))
    return sorted(least.items())


def _look(trie: Trie):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [lookup(trie, v) for v in batch.column("value").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("value"), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.int32())], names=["value", "entry", "distance"]
            )

    return run


def _within(trie: Trie):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(v, k, d) for v in batch.column("value").to_pylist() for k, d in within(trie, v)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.int32()))], names=["value", "entry", "distance"])

    return run


def entries_of(dictionary: DataFrame, key: str, names: list[str]) -> list[tuple[str, str]]:
    """Distinct (id, name) of the reference list; refuses lists beyond MOST_ENTRIES."""
    rows = dictionary.select(F.col(key).alias("k"), F.explode(F.array(*names)).alias("n")).where("k is not null and n is not null").distinct()
    got = rows.limit(MOST_ENTRIES + 1).collect()
    if len(got) > MOST_ENTRIES:
        raise ValueError(f"the reference list has more than {MOST_ENTRIES} entries")
    return sorted((r.k, r.n) for r in got)


def mapped(values: DataFrame, dictionary: DataFrame, key: str, names: list[str], column: str = "value") -> DataFrame:
    """(value, entry, distance) of each distinct value of ``column``."""
    trie = build_trie(entries_of(dictionary, key, names))
    distinct = values.select(F.col(column).alias("value")).where("value is not null").distinct()
    return spread(distinct).mapInArrow(_look(trie), "value string, entry string, distance int")


def all_entries(values: DataFrame, dictionary: DataFrame, key: str, names: list[str], column: str = "value") -> DataFrame:
    """(value, entry, distance) of every entry within the bound of each distinct value of ``column``."""
    trie = build_trie(entries_of(dictionary, key, names))
    distinct = values.select(F.col(column).alias("value")).where("value is not null").distinct()
    return spread(distinct).mapInArrow(_within(trie), "value string, entry string, distance int")


def typed_species(dashboard: DataFrame) -> DataFrame:
    """record_id and species_value: the values of the species cells."""
    cells = cells_of(dashboard, {"record_id": F.col("record_id")}, ["species"])
    return explode_values(cells, {"species": NAMES}).select("record_id", F.col("item").alias("species_value")).distinct()


def mapped_species(dashboard: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Each typed species value that is no entry letter for letter, with its species id or NONE."""
    values = typed_species(dashboard)
    known = dictionary.select(F.explode(F.array("preferred_name", "synonym")).alias("species_value")).where("species_value is not null").distinct()
    free = values.join(known, "species_value", "left_anti")
    found = mapped(free, dictionary, "species_id", ["preferred_name", "synonym", "scientific_name"], "species_value")
    rows = free.join(found, free["species_value"] == found["value"])
    return rows.select("record_id", "species_value", F.coalesce("entry", F.lit("NONE")).alias("species_id"))
