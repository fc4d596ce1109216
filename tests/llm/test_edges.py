"""Every operator on empty tables, all-NULL rows, empty and very long texts, repeated rows and
extra columns whose names clash with its own."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidewell.llm import abuse, canonical, contamination, format_duplicates, history, markup, mixing, names, survivorship

SCREENING = "record_sequence int, record_id string, title string, abstract string, doi string, authors string, batch_id int, source string"
MASTER = "record_id string, pages string, url_raw string, doi string, duplicate_group bigint, updated_at timestamp"
BOARD = "record_id string, species string, iso3 string"
WORDS = "species_id string, preferred_name string, scientific_name string, synonym string"
DOCS = "doc_id bigint, text string, source string"
LABELS = "doc_id bigint, toxic int"
ITEMS = "item_id bigint, text string"
TARGETS = "source string, target_share double, max_repeats int"
LONG = "word " * 40_000

ROWS = {
    SCREENING: [
        (1, None, None, None, None, None, None, None), (2, "", "", "", "", "", 0, ""), (3, "r", LONG, LONG, "10.1234/" + "x" * 5000, "A, B|" * 3000, 1, "s"),
        (4, "r", "NA", "-", "n/a", "NA; | ;", 1, "s"), (5, "r", "A title of some words", "x", "10.1234/a", "Mulvaunkem, Edward", 1, "s"),
        (5, "r", "A title of some words", "x", "10.1234/a", "Mulvaunkem, Edward", 1, "s"),
    ],
    MASTER: [(None, None, None, None, None, None), ("a", "", "-", "NA", 1, None), ("b", "1" * 9000, LONG, "10.1234/", 1, None), ("c", "1-2", "http://a.b/c", "10.1234/x", None, None)],
    BOARD: [(None, None, None), ("a", "", "NA"), ("b", LONG, "NOR"), ("b", "Cod", "NOR"), ("b", "Cod", "NOR")],
    WORDS: [(None, None, None, None), ("COD", "Cod", "Gadus morhua", "Torsk"), ("COD", "Cod", "Gadus morhua", "Torsk")],
    DOCS: [(1, None, None), (2, "", "a"), (3, LONG, "a"), (None, "x y z", "b"), (4, "ordinary words", "a"), (4, "ordinary words", "a")],
    LABELS: [(1, None), (2, 1), (3, 0), (None, 1), (2, 1)],
    ITEMS: [(1, None), (2, ""), (3, "a few words"), (3, "a few words"), (4, LONG)],
    TARGETS: [("a", 0.7, 2), ("b", 0.3, 0), (None, 0.1, 1), ("absent", 0.2, 1)],
}

RUNS = {
    "names": ((SCREENING,), lambda s: names.variant_pairs(s)),
    "format_duplicates": ((SCREENING,), lambda s: format_duplicates.copies_of_records(s)),
    "survivorship": ((MASTER,), lambda m: survivorship.surviving_members(m)),
    "history": ((SCREENING,), lambda s: history.repeated_rows(s)),
    "markup": ((SCREENING,), lambda s: markup.marked_fields(s)),
    "canonical": ((BOARD, WORDS), lambda b, w: canonical.mapped_species(b, w)),
    "contamination": ((DOCS, ITEMS), lambda d, i: contamination.leaks(d, i)),
    "mix": ((DOCS, TARGETS), lambda d, t: mixing.mixed(d, t)[0]),
    "shares": ((DOCS, TARGETS), lambda d, t: mixing.mixed(d, t)[1]),
    "abuse": ((DOCS, LABELS), lambda d, x: abuse.abusive_documents(d, x)),
    "rates": ((DOCS, LABELS), lambda d, x: abuse.rates(d, x)),
}
CLASH = ["k", "key", "node", "label", "token", "items", "host", "path", "_key", "seq", "id", "a", "b", "value", "grp", "toxic_", "tokens", "name", "n", "part", "pass", "finish", "word", "lang"]


@pytest.mark.parametrize("name", RUNS)
def test_empty_tables(spark, name):
    schemas, run = RUNS[name]
    assert run(*[spark.createDataFrame([], s) for s in schemas]).where("false" if name in ("shares",) else "true").count() == 0


@pytest.mark.parametrize("name", RUNS)
def test_odd_rows_and_clashing_columns(spark, name):
    schemas, run = RUNS[name]
    frames = [spark.createDataFrame(ROWS[s], s) for s in schemas]
    plain = sorted(map(str, run(*frames).collect()))
    wide = [f.withColumns({c: F.lit("x") for c in CLASH}) for f in frames]
    assert sorted(map(str, run(*wide).collect())) == plain
