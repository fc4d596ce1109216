from __future__ import annotations

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewell.operators.multivalue import CODES, NAMES, PATHS, cells_of, explode_values, packed_values, split_cell


@pytest.mark.parametrize(
    ("profile", "cell", "want"),
    [
        (NAMES, "trout, zephyr; Ember trout; ", ["trout, zephyr", "Ember trout"]),
        (NAMES, "trout, hollow", ["trout, hollow"]),
        (NAMES, "Turbot, Ember trout", ["Turbot", "Ember trout"]),
        (NAMES, 'A b, "x, y", C d', ["A b", "x, y", "C d"]),
        (NAMES, "Sable smelt (F, z)", ["Sable smelt (F, z)"]),
        (NAMES, 'say ""x""; y', ['say ""x""', "y"]),
        (NAMES, '"a ""b"" c"; d', ['a "b" c', "d"]),
        (PATHS, "E; nets > Oil > V; F > A > B", ["E; nets > Oil > V", "F > A > B"]),
        (PATHS, "A > B > C, other", ["A > B > C, other"]),
        (PATHS, "E; n → M → O;; G → F → C", ["E; n → M → O", "G → F → C"]),
        (PATHS, '["S \\u2192 T \\u2192 L"]', ["S → T → L"]),
        (CODES, 'P046 "P035"\tP043', ["P046", "P035", "P043"]),
        (CODES, "USA-SWE", ["USA", "SWE"]),
        (CODES, ";IRL; NZL|", ["IRL", "NZL"]),
        (CODES, "n/a", []),
        (CODES, None, []),
        (CODES, "", []),
    ],
)
def test_split(profile, cell, want):
    assert split_cell(cell, profile)[0] == want


def test_malformed_quotes_are_flagged_and_kept():
    assert split_cell('"Pewter; smelt', NAMES) == (['"Pewter', "smelt"], "unclosed_quote")
    assert split_cell('["a", "b]', NAMES)[0] != []


@given(st.lists(st.text(st.characters(codec="ascii", exclude_categories=("C",)), min_size=1).filter(lambda s: s.strip() == s and s != ""), min_size=2, max_size=6))
@settings(max_examples=200, deadline=None)
def test_json_lists_round_trip(values):
    assert split_cell(json.dumps(values), NAMES)[0] == values


@given(st.text())
@settings(max_examples=300, deadline=None)
def test_never_fails(text):
    for profile in (CODES, PATHS, NAMES):
        values, _ = split_cell(text, profile)
        assert all(v.strip() == v and v for v in values)


def test_long_cells():
    assert len(split_cell("; ".join(["NOR"] * 50_000), CODES)[0]) == 50_000


def test_tables(spark):
    schema = "record_id string, topic_hierarchy_paths string, topic_path_ids string, item string"
    master = spark.createDataFrame([("a", "A > B > C; D > E > F", "P1", "x"), ("b", None, "", "y"), (None, "NA", "P1;P2", "z")], schema)
    board = spark.createDataFrame([("a", "Cod | Ling", "NOR"), ("a", "Cod | Ling", "NOR"), ("c", None, "NOR; NOR")], "record_id string, species string, iso3 string")
    got = {tuple(r) for r in packed_values(master, board).collect()}
    assert got == {
        ("merge_master_update", "a", "topic_hierarchy_paths", 1, "A > B > C"), ("merge_master_update", "a", "topic_hierarchy_paths", 2, "D > E > F"),
        ("merge_master_update", None, "topic_path_ids", 1, "P1"), ("merge_master_update", None, "topic_path_ids", 2, "P2"),
        ("build_dashboard", "a", "species", 1, "Cod"), ("build_dashboard", "a", "species", 2, "Ling"),
        ("build_dashboard", "c", "iso3", 1, "NOR"), ("build_dashboard", "c", "iso3", 2, "NOR"),
    }
    assert packed_values(master.limit(0), board.limit(0)).count() == 0
    one = explode_values(cells_of(board, {"k": F.col("record_id")}, ["iso3"]), {"iso3": CODES})
    assert one.where("k = 'a'").count() == 2
