"""Behaviours of the core operators on fixtures of a few rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidewell.functions import text as t
from tidewell.functions import values as v
from tidewell.operators import dashboard, linkage, maintenance, mentions, relevance
from tidewell.sources import ris, tables
from tidewell.streaming import harvest

RECORD = "record_sequence int, record_id string, title string, authors string, year int, journal string, volume string, issue string, pages string, doi string"


def pairs(spark, rows, existing=None):
    df = spark.createDataFrame(rows, RECORD)
    return {(r.record_i, r.record_j): (r.method, r.status) for r in linkage.duplicate_candidates(df, existing=existing).collect()}


def test_bibliographic_passes(spark):
    base = (1, "A", "One title", "Smith, J", 2020, "J", "1", "2", "3-4", "10.1/a")
    assert pairs(spark, [base, (2, "B", *base[2:9], "10.1/b")]) == {(1, 2): ("A_author_year_title_journal", "duplicate")}
    assert pairs(spark, [base, (2, "B", "Other", "X", 1999, "K", "9", "9", "9", "10.1/a")]) == {}
    assert pairs(spark, [(1, "A", "T", "S", 2020, None, None, None, "3–4p", None), (2, "B", "T", "S", 2020, None, None, None, "3 - 4", None)]) == {(1, 2): ("B_author_year_title_pages", "duplicate")}
    assert pairs(spark, [base, (2, "B", "One title", "Other", 1990, "K", "1", "7", "3-4", None)]) == {(1, 2): ("C_title_volume_pages", "review")}


def test_existing_record_is_canonical(spark):
    rows = [(1, "NEW", "T", "S", 2020, "J", "1", "1", "1", None), (2, "OLD", "T", "S", 2020, "J", "1", "1", "1", None)]
    df = spark.createDataFrame(rows, RECORD)
    got = linkage.canonical_pairs(df, F.col("record_id") == "OLD").first()
    assert (got.canonical_id, got.duplicate_id, got.cross_corpus) == ("OLD", "NEW", True)
    assert linkage.canonical_pairs(df, F.lit(False)).first().canonical_id == "NEW"


def test_jaro_winkler_known_values():
    assert linkage.jaro_winkler("martha", "marhta") == pytest.approx(0.961111, abs=1e-6)
    assert linkage.jaro_winkler("dixon", "dicksonx") == pytest.approx(0.813333, abs=1e-6)
    assert linkage.jaro_winkler("", "x") == 0.0


def link(spark, new, master):
    cols = "record_sequence int, record_id string, title string, doi string, authors string, year int"
    return {r.row: r for r in linkage.link_new_records(spark.createDataFrame(new, cols), spark.createDataFrame(master, cols)).collect()}


def test_linkage_priorities(spark):
    master = [(1, "m1", "Health effects of salmon feed", "10.1/x", "A, B", 2001), (2, "m2", "Growth of trout in cages near the coast", None, "C, D", 2002)]
    new = [
        (10, "n1", "Health effects of salmon feed", None, "Z", 1990),
        (11, "n2", "Health effects in salmon feed", "doi:10.1/X", "Z", 1990),
        (12, "n3", "Something else altogether", "10.1/x", "Z", 1990),
        (13, "n4", "Growth of trout in cages near the coasts", None, "C, D", 1999),
        (14, "n5", "Unrelated words", None, "Q", 1980),
    ]
    got = link(spark, new, master)
    assert [got[i].duplicate_status for i in range(10, 15)] == ["duplicate", "duplicate", "doi_conflict_review", "probable_duplicate", "new"]
    assert got[13].duplicate_basis == "same first author" and got[14].matched_id is None
    same_year = link(spark, [(13, "n4", "Growth of trout in cages near the coasts", None, "C, D", 2002)], master)
    assert same_year[13].duplicate_status == "possible_duplicate"  # the first block names the basis


def test_cleaning(spark):
    df = spark.createDataFrame([("Salmon <b>welfare</b>&nbsp;&amp; x", "https://doi.org/10.1234/ABC.1", "c. 2024a", "Müller, A | Smith")], "a string, d string, y string, n string")
    r = df.select(t.clean_html(F.col("a")).alias("a"), t.valid_doi(F.col("d")).alias("d"), t.first_year(F.col("y")).alias("y"), t.first_author_key(F.col("n")).alias("n")).first()
    assert tuple(r) == ("Salmon welfare & x", "10.1234/abc.1", 2024, "muller a")


@pytest.mark.parametrize(("title", "want"), [("Retraction: x", "retraction_notice"), ("RETRACTED notice - x", "retraction_notice"), ("Withdrawn: y", "withdrawal_notice"), ("Erratum. z", "correction_notice"), ("Corrections of z", None), (None, None)])
def test_notices(spark, title, want):
    assert spark.createDataFrame([(title,)], "t string").select(t.notice_type(F.col("t"))).first()[0] == want


def test_values(spark):
    df = spark.createDataFrame([('["a", "NA", "b"]', "A > B → C; ;D/E", "x; X; y")], "l string, p string, s string")
    r = df.select(v.split_values(F.col("l")).alias("l"), v.hierarchy_paths(F.col("p")).alias("p"), t.shorten_terms(F.col("s")).alias("s")).first()
    assert (r.l, r.p, r.s) == (["a", "b"], [["A", "B", "C"], ["D", "E"]], "x; y")


def test_natural_breaks_against_all_cuts():
    from itertools import combinations

    data = [1.0, 2.0, 2.0, 9.0, 10.0, 11.0, 30.0]

    def cost(bounds):
        total, low = 0.0, float("-inf")
        for b in bounds:
            part = [x for x in data if low < x <= b]
            low = b
            total += sum((x - sum(part) / len(part)) ** 2 for x in part) if part else 0
        return total

    levels = sorted(set(data))
    best = min((cost((*c, levels[-1])), (*c, levels[-1])) for c in combinations(levels[:-1], 2))
    assert cost(dashboard.natural_breaks(data, 3)) == pytest.approx(best[0])
    assert dashboard.natural_breaks([0.0], 3) == []


def test_overlapping_mentions_keep_the_longer(spark):
    m = mentions.Matcher([("Zealand", "z"), ("New Zealand", "nz"), ("salmon", "s")])
    assert [h[2] for h in mentions.resolve(m.find("Study in New Zealand salmon, not salmons"))] == ["nz", "s"]


def species(spark, rows):
    df = spark.createDataFrame(rows, "id bigint, species_id string, preferred_name string, is_farmed_candidate boolean, mention_eligible boolean")
    ids = spark.createDataFrame([(1,), (2,)], "id bigint")
    return {r.id: r for r in mentions.assign_species(df, ids, "GENERIC").collect() if r.id == 1}


def test_species_assignment(spark):
    rows = [(1, "ATL", "Atlantic", True, True), (1, "GENERIC", "Unspecified", True, True)]
    assert species(spark, rows)[1].farmed_species == "Atlantic"
    assert species(spark, [(1, "ION", "Ion", False, True)])[1].assignment_reason == "Only non-target species detected"
    assert species(spark, [(1, "GENERIC", "Unspecified", True, True)])[1].assignment_role == "primary"


def geo(spark, rows):
    df = spark.createDataFrame(rows, "id bigint, source string, matched_text string, country_name string, iso3c string, region_name string, context string")
    a, r = mentions.primary_countries(mentions.rank_countries(df))
    return {x.id: x for x in mentions.country_summary(a, r).collect()}


def test_primary_country(spark):
    nor = (1, "title", "Norway", "Norway", "NOR", None, "in norway")
    chl = (1, "abstract", "Chile", "Chile", "CHL", None, "fish industry")
    assert geo(spark, [nor, chl])[1].primary_iso3c == "NOR"
    tied = geo(spark, [chl, (1, "abstract", "Peru", "Peru", "PER", None, "fish industry")])[1]
    assert tied.review_reason == "Abstract candidates remain exactly tied" and tied.primary_country_count == 0
    region = geo(spark, [(1, "title", "Europe", None, None, "Europe", "x"), (1, "abstract", "Norway", "Norway", "NOR", None, "x")])[1]
    assert region.review_required and region.primary_country_count == 0
    assert geo(spark, [(1, "title", "Chile", "Chile", "CHL", None, "chile salmon")]) == {}


def test_publication_status(spark):
    rec = spark.createDataFrame([("LIVE", "x", "10.1/a"), ("RET", "x", "10.1/b"), ("NOTE", "Retraction: y", "10.1/c"), ("NONE", "z", None), ("AGAIN", "x", "10.1/a")], "record_id string, title string, doi string")
    found = maintenance.lookup_dois(rec, lambda part: {d: {"id": d, "is_retracted": d.endswith("b")} for d in part if d != "10.1/c"})
    assert found.count() == 3
    got = {r.record_id: (r.remove_publication_status, r.removal_reason, r.openalex_lookup_status) for r in maintenance.publication_status(rec, found).collect()}
    assert got["RET"] == (True, "retracted_original", "found") and got["NOTE"] == (True, "retraction_notice", "not_queried_notice")
    assert got["NONE"] == (False, None, "not_queried_no_doi") and got["LIVE"][0] is False

    def broken(part):
        raise OSError("down")

    failed = maintenance.publication_status(rec, maintenance.lookup_dois(rec, broken)).where("record_id = 'RET'").first()
    assert failed.openalex_lookup_status == "failed" and not failed.remove_publication_status


def test_ask_keeps_failures_apart(spark):
    q = spark.createDataFrame([("a",), ("b",)], "id string").coalesce(1)
    ok = maintenance.ask(q, lambda rows: [{"id": r["id"], "decision": "retain"} for r in rows], "id", {"decision": "uncertain"}).collect()
    assert all(r.decision == "retain" and not r.llm_failed for r in ok)
    bad = maintenance.ask(q, lambda rows: [{"id": "a", "decision": "retain"}], "id", {"decision": "uncertain"}).collect()
    assert all(r.decision == "uncertain" and r.llm_failed for r in bad)
    assert maintenance.structured_answer('{"output": [{"type": "message", "content": [{"type": "output_text", "text": "{\\"d\\": 1}"}]}]}') == {"d": 1}


def test_metrics_and_decisions(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.2), (0, 0.8), (0, 0.1)], "y int, p double")
    m = relevance.metrics(df, "y", "p", 0.5).first()
    assert (m.tp, m.fp, m.sensitivity, m.precision) == (1, 1, 0.5, 0.5)
    got = spark.createDataFrame([(0.1,), (0.5,), (0.9,), (None,)], "p double").select(relevance.decision(F.col("p"), 0.2, 0.8)).collect()
    assert [r[0] for r in got] == ["automatic_exclude", "review", "automatic_retain", "review"]


def test_training_separates(spark):
    rows = [(1, f"salmon welfare cage trial number {i % 7}") for i in range(60)] + [(0, f"stock price report quarter {i % 7}") for i in range(60)]
    df = spark.createDataFrame(rows, "y int, text string").withColumn("id", F.monotonically_increasing_id())
    model, intercept = relevance.train(df, "y", "text", folds=2, strengths=(0.01,))
    scored = relevance.score(df, model, intercept, "id", "text").join(df, "id")
    # the weights carry their own idf, which score() multiplies by tf
    assert scored.agg(F.avg(((F.col("probability") > 0.5).cast("int") == F.col("y")).cast("int"))).first()[0] > 0.95


RIS = """junk before
TY  - JOUR
ID  - R1
TI  - Salmon <b>welfare</b>
      continued
AU  - Smith, J
AU  - Jones, A
AB  - An &amp; important study.
DO  - https://doi.org/10.1234/ABC.1
PY  - 2024
SP  - 10-20
ER  - 
TY  - JOUR
ID  - R2
ST  - Short
ER  - 
TI  - never ended
"""


def test_ris(spark, tmp_path):
    (tmp_path / "a.ris").write_text(RIS)
    rows = sorted(ris.read_corpus(spark, str(tmp_path / "a.ris")).collect(), key=lambda r: r.record_sequence)
    assert [(r.record_sequence, r.record_id, r.title) for r in rows] == [(1, "R1", "Salmon welfare continued"), (2, "R2", "Short")]
    assert (rows[0].authors, rows[0].doi, rows[0].abstract, rows[0].year) == ("Smith, J | Jones, A", "10.1234/abc.1", "An & important study.", 2024)
    loose = ris.read_loose_ris(spark, str(tmp_path / "a.ris")).collect()
    assert loose[0].authors == ["Smith, J", "Jones, A"]
    assert ris.validate(spark, str(tmp_path / "a.ris")).first().valid
    out = spark.createDataFrame([("X", "T", "A", ["P", "Q"], "10.1/x", 2020)], "record_id string, title string, abstract string, authors array<string>, doi string, year int")
    (tmp_path / "b.ris").write_text(ris.to_ris(out).first().value + "\n")
    again = ris.read_corpus(spark, str(tmp_path / "b.ris")).first()
    assert (again.record_id, again.title, again.authors, again.year) == ("X", "T", "P | Q", 2020)


def test_csv_and_checksums(spark, tmp_path):
    df = spark.createDataFrame([("a", None), ('say "x", y', "b")], "p string, q string")
    tables.write_csv(df, str(tmp_path / "c"))
    assert sorted(map(tuple, tables.read_csv(spark, str(tmp_path / "c"), "p string, q string").collect())) == sorted(map(tuple, df.collect()))
    one = tables.file_checksums(spark, str(tmp_path / "c" / "*.csv"))
    assert tables.changed_files(one, one).count() == 0 and tables.changed_files(one, one.limit(0)).first().state == "missing"


def test_stream_drops_what_was_seen(spark, tmp_path):
    rows = [("a", "2024-01-01 00:00:00", 1), ("a", "2024-01-03 00:00:00", 2), ("b", "2024-01-04 00:00:00", 3)]
    df = spark.createDataFrame(rows, "k string, c string, n int").withColumn("c", F.to_timestamp("c"))
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = harvest.run_harvest(stream, str(tmp_path / "out"), str(tmp_path / "hist"), str(tmp_path / "cp"), ["k"], "c")
    q.awaitTermination(120)
    assert sorted(r.k for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b"]
    assert spark.read.parquet(str(tmp_path / "hist")).agg(F.sum("candidate_results")).first()[0] == 2
    assert harvest.first_seen_batch(df, ["k"], ["c", "n"]).count() == 2


def test_upsert_and_pending(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    new = spark.createDataFrame([("b", 3, "x")], "k string, n int, extra string")
    assert sorted(map(tuple, maintenance.upsert(old, new, "k").collect())) == [("a", 1, None), ("b", 3, "x")]
    done = spark.createDataFrame([("a", "completed"), ("b", "failed")], "k string, status string")
    assert [r.k for r in maintenance.pending(old, done, "k").collect()] == ["b"]
