"""Targets, saved models, the paged source, updates and repairs on fixtures of a few rows."""

from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tidewell.functions import text as t
from tidewell.functions import values as v
from tidewell.operators import dashboard, figures, linkage, mentions, relevance, upkeep
from tidewell.sources import model, paged, ris, tables, target
from tidewell.streaming import harvest

RECORDS = "record_sequence int, record_id string, title string, abstract string"


def test_target_files(spark, tmp_path):
    home = tmp_path / "conf"
    home.mkdir()
    (tmp_path / "records.csv").write_text('record_sequence,record_id,title,abstract\n1,a,One,"x, y"\n2,b,Two,\n')
    (home / "t.yml").write_text("target:\n  name: T\n  records_file: ../records.csv\n  annotations:\n    species: s.csv\n")
    got = target.load_target(spark, str(home / "t.yml"))
    assert got.records_file == str(tmp_path / "records.csv") and got.annotations == {"species": str(home / "s.csv")} and got.records.count() == 2
    row = target.write_manifest(got, str(tmp_path / "out"), dt.datetime(2024, 1, 2, 3, 4, 5)).first()
    assert (row.n_records, row.min_record_sequence, row.max_record_sequence, row.created_at_utc) == (2, 1, 2, "2024-01-02 03:04:05 UTC")
    assert os.path.isdir(tmp_path / "out" / "target_manifest")
    (home / "bad.yml").write_text("target:\n  name: T\n")
    for path, what in ((str(home / "bad.yml"), "records_file"), (str(home / "none.yml"), "does not exist")):
        with pytest.raises(ValueError, match=what):
            target.read_target_config(path)


@pytest.mark.parametrize(("rows", "what"), [([], "no records"), ([(1, "a"), (1, "b")], "record_sequence"), ([(1, "a"), (2, "a")], "record_id"), ([(1, None)], "record_id"), ([(None, "a")], "record_sequence")])
def test_invalid_records(spark, rows, what):
    with pytest.raises(ValueError, match=what):
        target.validate_records(spark.createDataFrame([(*r, "t", None) for r in rows], RECORDS))


def test_ids_outside_the_target(spark):
    records = spark.createDataFrame([(1, "a", "t", None)], RECORDS)
    assert target.assert_target_ids(records, records) is records
    with pytest.raises(ValueError, match="1 record_id"):
        target.assert_target_ids(spark.createDataFrame([("a",), ("z",), ("z",), (None,)], "record_id string"), records)
    with pytest.raises(ValueError, match="lack"):
        target.unknown_ids(records.drop("record_id"), records)
    with pytest.raises(ValueError, match="abstract"):
        target.validate_records(records.drop("abstract"))


def test_saved_model(spark, tmp_path):
    terms = spark.createDataFrame([("salmon", 1.0, 2.0), ("salmon_farm", 1.0, 1.0)], "term string, idf double, coef double")
    path = str(tmp_path / "m")
    model.save_model(path, terms, -1.0, {"exclude_threshold": 0.2, "include_threshold": 0.8}, ngrams="1:2")
    got = model.load_model(spark, path)
    assert got.specification == {"ngrams": "1:2"}
    rows = spark.createDataFrame([(1, "a", "Salmon farm", None), (2, "b", None, None)], RECORDS)
    told = {r.record_sequence: (round(r.relevance_probability, 6), r.relevance_decision) for r in model.screen(rows, got).collect()}
    assert told == {1: (0.993307, "automatic_retain"), 2: (0.268941, "review")}
    with pytest.raises(ValueError, match="not found"):
        model.load_model(spark, str(tmp_path / "none"))
    for limits, what in (({"exclude_threshold": 0.2}, "include_threshold"), ({"exclude_threshold": 0.9, "include_threshold": 0.8}, "order")):
        model.save_model(path, terms, -1.0, limits)
        with pytest.raises(ValueError, match=what):
            model.load_model(spark, path)


def test_thresholds_are_exact_beyond_six_places(spark):
    rows = [(1, 0.5000004), (1, 0.9), (0, 0.5000001), (0, 0.1)]
    got = relevance.operating_thresholds(spark.createDataFrame(rows, "y int, p double"), "y", "p", 1.0, 1.0).first()
    assert (got.exclude, got.include) == (0.5000004, min(1.0, max(0.5500004, 0.5000004 + 0.25 * 0.3999996)))


def test_words_of_any_script(spark):
    df = spark.createDataFrame([("Tromsø and Ålesund naïve 5",)], "x string")
    assert df.select(relevance.words(F.col("x")).alias("w")).first().w == ["tromsø", "ålesund", "naïve", "5"]
    assert spark.createDataFrame([("Café Ålesund",)], "x string").select(t.alphanumeric(F.col("x")).alias("w")).first().w == "cafe alesund"


def transport(pages):
    asked = []

    def send(body, cursor):
        asked.append((body, cursor))
        return pages[len(asked) - 1]

    return send, asked


def test_pages_follow_the_cursor_and_wait():
    waits = []
    send, asked = transport([(200, {}, {"data": [{"i": 1}, {"i": 2}], "total": 3, "scroll_id": "c"}), (429, {"retry-after": "5"}, {}), (429, {}, {}), (200, {}, {"data": [{"i": 3}], "total": 3})])
    assert [r["i"] for r in paged.pages(send, paged.Query(["salmon*"], ["dataset"], "2024-01-01", None), 2, wait=waits.append)] == [1, 2, 3]
    assert waits == [5, 2] and [c for _, c in asked] == [None, "c", "c", "c"] and asked[0][0]["size"] == 2
    assert asked[0][0]["query"]["bool"]["must_not"] == [{"terms": {"publication_type": ["dataset"]}}] and asked[0][0]["query"]["bool"]["must"][1] == {"range": {"created": {"gte": "2024-01-01"}}}
    assert list(paged.pages(transport([(204, {}, {})])[0], paged.Query(["x"]))) == []
    for answers in ([(500, {}, {})], [(200, {}, {"data": [{}], "total": 9})], [(429, {}, {})] * 4):
        with pytest.raises(OSError):
            list(paged.pages(transport(answers)[0], paged.Query(["x"]), wait=waits.append))


def test_paged_data_source(spark):
    def send(body, cursor):
        start = body["query"]["bool"]["must"][1]["range"]["created"]["gte"]
        return 200, {}, {"data": [{"from": start}] * 2, "total": 2}

    got = paged.read_paged(spark, send, paged.Query(["x"]), [("2024-01-01", "2024-01-08"), ("2024-01-08", "2024-01-15")]).collect()
    assert sorted((r.window_start, r.position, json.loads(r.record)["from"]) for r in got) == [(w, i, w) for w in ("2024-01-01", "2024-01-08") for i in (1, 2)]


def test_generic_mentions_give_way_to_one_genus_only(spark):
    words = [("SAL_TRUTTA", "Brown trout", "Salmo trutta", "brown trout", False), ("ONC_KETA", "Chum salmon", "Oncorhynchus keta", "chum salmon", False), ("GENERIC_SALMON", "Unspecified species", None, "salmon farm", True), ("GENERIC_SALMON", "Unspecified species", None, "salmonids", True)]
    dictionary = spark.createDataFrame([(*w, "g") for w in words], "species_id string, preferred_name string, scientific_name string, synonym string, is_farmed_candidate boolean, default_group string")
    texts = {1: "salmonids and brown trout", 2: "salmonids and chum salmon", 3: "a salmon farm and brown trout", 4: "salmonids " + "x" * 130 + " brown trout"}
    found = mentions.species_mentions(spark.createDataFrame([(i, None, s, None) for i, s in texts.items()], RECORDS), dictionary)
    kept = {r.id for r in mentions.filter_generic(found).where("species_id = 'GENERIC_SALMON' and mention_eligible").collect()}
    assert kept == {2, 3, 4}
    unnamed = found.withColumn("species_id", F.regexp_replace("species_id", "GENERIC", "UNSPEC"))  # an id the rule does not know
    assert mentions.filter_generic(unnamed).where("not mention_eligible").isEmpty()
    why = {r.filter_reason for r in mentions.filter_generic(found).where("not mention_eligible").collect()}
    assert why == {mentions.NEAR_NON_TARGET}


def test_weak_species_leave_the_generic_one(spark):
    schema = "id bigint, species_id string, preferred_name string, is_farmed_candidate boolean, mention_eligible boolean"
    rows = [(1, "UNSPEC_SALMON", "U", True, True), (1, "ONC_MYKISS", "R", True, True), (2, "UNSPEC_SALMON", "U", True, True), (2, "SAL_SALAR", "A", True, True), (3, "SAL_TRUTTA", "B", False, True)]
    got = mentions.assign_species(spark.createDataFrame(rows, schema), spark.range(1, 5)).collect()
    assert sorted((r.id, r.farmed_species or "", r.assignment_role) for r in got) == [(1, "R", "co-primary"), (1, "U", "co-primary"), (2, "A", "primary"), (3, "", "unresolved"), (4, "", "unresolved")]
    assert {r.assignment_reason for r in got if r.id in (1, 3)} == {"2 eligible farmed species detected; none treated as primary", "Only non-target species detected"}


def test_records_that_cannot_be_annotated_are_reported(spark):
    dictionary = spark.createDataFrame([("COD", "Cod", "Gadus morhua", "cod", True, "g")], "species_id string, preferred_name string, scientific_name string, synonym string, is_farmed_candidate boolean, default_group string")
    rows = [(1, "a", "Cod", None), (2, "b", "Cod", None), (2, "c", "Cod", None), (None, "d", "Cod", None)]
    got = mentions.annotate_species(spark.createDataFrame(rows, RECORDS), dictionary)
    assert [r.id for r in got["mentions"].collect()] == [1] == [r.id for r in got["assignments"].collect()]
    assert sorted(r.error for r in got["failures"].collect()) == ["the key is not unique", "the key is not unique", "the record has no key"]


def test_first_of_several_places_of_a_name(spark):
    gazetteer = spark.createDataFrame([("Georgia", "United States", "USA", None, 2), ("Georgia", "Georgia", "GEO", None, 1)], "matched_place string, country_name string, iso3c string, region_name string, position int")
    got = mentions.place_mentions(spark.createDataFrame([(1, "a", "Farms in Georgia", None)], RECORDS), gazetteer).collect()
    assert [(r.iso3c, r.context) for r in got] == [("GEO", "Farms in Georgia")]


def test_adjudication_that_must_stop(spark):
    audit = spark.createDataFrame([(1, "new"), (2, "possible_duplicate"), (3, "probable_duplicate")], "incoming_row int, duplicate_status string")
    answers = spark.createDataFrame([(2, "uncertain", 0.5, "r"), (9, "maybe", 2.0, ""), (9, "duplicate", 1.0, "r")], "incoming_row int, decision string, confidence double, rationale string")
    problems = upkeep.adjudication_problems(audit, answers)
    assert problems.first().asDict() == {"repeated": 1, "invalid": 1, "uncertain": 1, "unasked": 1, "unanswered": 1}
    with pytest.raises(ValueError, match="unanswered 1"):
        upkeep.enforce(problems, "duplicates")
    good = spark.createDataFrame([(2, "duplicate", 0.5, "r"), (3, "not_duplicate", 1.0, "r")], answers.schema)
    upkeep.enforce(upkeep.adjudication_problems(audit, good), "duplicates")
    assert {r.incoming_row: r.final_duplicate_status for r in upkeep.merge_adjudication(audit, good).collect()} == {1: "new", 2: "duplicate", 3: "new"}


def test_lookup_of_keys_that_must_stand_once(spark):
    table = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "k string, n int")
    assert upkeep.lookup_unique(spark.createDataFrame([("a",)], "k string"), table, "k").first().n == 1
    for key in ("b", "z"):
        with pytest.raises(ValueError, match="exactly once"):
            upkeep.lookup_unique(spark.createDataFrame([(key,)], "k string"), table, "k")
    with pytest.raises(ValueError, match="1 k value"):
        upkeep.wanted_records(spark.createDataFrame([("a",), ("z",)], "k string"), table, "k")


def test_replacing_a_table_keeps_the_old_one(spark, tmp_path):
    path, archive = str(tmp_path / "master"), str(tmp_path / "archive")
    spark.range(5).write.parquet(path)
    with pytest.raises(ValueError, match="too few"):
        upkeep.replace_table(spark.range(0), path, archive)
    assert spark.read.parquet(path).count() == 5
    old = upkeep.replace_table(spark.range(7), path, archive, stamp="before")
    assert (spark.read.parquet(path).count(), spark.read.parquet(old).count(), os.path.exists(path + ".tmp")) == (7, 5, False)


def test_territories_named_like_a_genus(spark):
    schema = "record_id string, title string, abstract string, final_species string, final_primary_country_iso3c string, countries string"
    rows = [("a", "Anguilla anguilla in ponds", None, None, "AIA; NOR", "Anguilla; Norway"), ("b", "Reefs of Anguilla", None, None, "AIA", "Anguilla"), ("c", "Eels", None, "Anguilla", '["ATG"]', None)]
    new, audit = upkeep.repair_confusions(spark.createDataFrame(rows, schema), "Anguilla", ["AIA", "ATG"], ["Anguilla"], countries="countries")
    assert {r.record_id: (r.final_primary_country_iso3c, r.countries) for r in new.collect()} == {"a": ("NOR", "Norway"), "b": ("AIA", "Anguilla"), "c": ("", None)}
    assert sorted(r.record_id for r in audit.collect()) == ["a", "c"]


def test_sort_keys_pages_and_columns(spark):
    words = ["Pen 10", "pen 9", "Éel 2", "eel 10", "Åre"]
    got = [r.x for r in spark.createDataFrame([(w,) for w in words], "x string").orderBy(dashboard.natural_key(F.col("x"))).collect()]
    assert got == ["Åre", "Éel 2", "eel 10", "pen 9", "Pen 10"]
    assert dashboard.page_of(101, 9, 50) == (3, 3, 101, 101) and dashboard.page_of(0, 0, 50) == (1, 1, 0, 0)
    assert figures.topic_level_columns(["x", "topic_level_2", "Topic level 10", "topic_level_1"]) == ["topic_level_1", "topic_level_2", "Topic level 10"]


def test_species_of_figures_and_of_the_dashboard(spark):
    df = spark.createDataFrame([("Steelhead",), ("rainbow salmon",), ("unspecified trout",), ("Cod",), (None,)], "s string")
    assert [r.x for r in df.select(v.figure_species(F.col("s")).alias("x")).collect()] == ["Rainbow trout", "Rainbow trout", "Unspecified species", "Cod", "Unspecified species"]
    assert df.select(v.canonical_species(F.col("s")).alias("x")).first().x == "Steelhead"


def test_documents_hold_the_records(spark, sf_dir):
    from tidewell.plans import board, upkeep as queries

    view = {r.record_id: r for r in board._view(spark, sf_dir).collect()}
    rows = queries.dashboard_documents(spark, sf_dir).collect()
    assert len(rows) == len(view)
    for r in rows:
        told, own = json.loads(r.document), view[r.record_id]
        assert told["species"] == own.species and told["topic_paths"] == own.paths and told.get("year") == own.year
        assert told["topic_level_1"] == list(dict.fromkeys(p[0] for p in own.paths))


def test_a_batch_that_is_run_again_is_there_once(spark, tmp_path):
    schema = "k string, c timestamp"
    source = tmp_path / "in"
    spark.createDataFrame([("a", dt.datetime(2024, 1, 1)), ("a", dt.datetime(2024, 1, 2)), ("b", dt.datetime(2024, 1, 2))], schema).write.parquet(str(source))
    paths = str(tmp_path / "out"), str(tmp_path / "history")
    for number in (1, 2):  # another checkpoint each time: batch 0 is processed twice
        stream = spark.readStream.schema(schema).parquet(str(source))
        harvest.run_harvest(stream, *paths, str(tmp_path / f"c{number}"), ["k"], "c").awaitTermination(60)
    assert spark.read.parquet(paths[0]).count() == 2
    assert spark.read.parquet(paths[1]).groupBy("run").count().where("count > 1").isEmpty()


def test_manual_files_and_ordinal_ids(spark, tmp_path):
    (tmp_path / "a.ris").write_text("TY - JOUR\nTI - One\nDO - 10.1/a\nER - \nTY - JOUR\nTI - Two\nER - \n")
    rows = ris.read_loose_ris(spark, str(tmp_path / "a.ris"))
    assert [[(i.type, i.value) for i in r.external_ids] for r in rows.orderBy("block").collect()] == [[("doi", "10.1/a")], []]
    assert ris.manual_manifest(rows, "a.ris").first().asDict() == {"source_file": "a.ris", "records": 2, "with_doi": 1, "status": "records_found", "downstream_action": "run_update"}
    assert ris.manual_manifest(rows.where("false"), "a.ris").first().status == "no_records"
    records = spark.createDataFrame([(3, None, "C"), (1, "x", "A"), (2, "", "B")], "n int, record_id string, title string")
    full = records.withColumns({"abstract": F.lit(None).cast("string"), "authors": F.lit(None).cast("array<string>"), "doi": F.lit(None).cast("string"), "year": F.lit(None).cast("int")})
    assert sorted(r.value.split("\n")[1] for r in ris.to_ris(full, "n").collect()) == ["ID  - 2", "ID  - 3", "ID  - x"]


def test_ids_as_texts_and_reference_tables(spark, tmp_path):
    (tmp_path / "h.json").write_text(json.dumps([{"lens_id": "1", "external_ids": ["x", "10.1/z"], "authors": ["A"]}, {"lens_id": "2", "external_ids": [{"type": "DOI", "value": "10.1/y"}]}]))
    got = {r.lens_id: r.doi for r in tables.read_harvest(spark, str(tmp_path / "h.json")).collect()}
    assert got == {"1": "10.1/z", "2": "10.1/y"}
    told = tables.reference_problems(spark.createDataFrame([], "a string"), "places", ["a", "b"]).collect()
    assert [(r.table, r.problem) for r in told] == [("places", "lacks b"), ("places", "has no rows")]


def test_four_outputs_of_deduplication(spark):
    rows = [(i, f"r{i}", title, "S", 2020, "J", "1", "1", "1", None) for i, title in ((1, "T"), (2, "T"), (3, "Other"))]
    schema = "record_sequence int, record_id string, title string, authors string, year int, journal string, volume string, issue string, pages string, doi string"
    got = linkage.deduplicated(spark.createDataFrame(rows, schema), F.col("record_id") == "r2")
    assert got["records"].count() == 3 and [(r.canonical_id, r.duplicate_id) for r in got["automatic_duplicates"].collect()] == [("r2", "r1")]
    assert got["candidates"].count() == got["automatic_duplicates"].count() + got["review_candidates"].count()
