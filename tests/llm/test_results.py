"""Results on small fixtures, most of them against brute force."""

from __future__ import annotations

import random
from collections import defaultdict
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tidewell.llm import abuse, canonical, contamination, format_duplicates, history, markup, mixing, names, queries, survivorship
from tidewell.llm.graph import least_labels


def screening(spark, rows):
    return spark.createDataFrame(rows, "record_sequence int, record_id string, title string, abstract string, doi string, authors string, batch_id int, source string")


def test_all_queries_run(spark, sf_dir):
    for name, query in queries.QUERIES.items():
        df = query(spark, sf_dir)
        assert not df.isEmpty() or name == "p10_found", name  # few labels at this size
        assert df.count() == df.distinct().count(), name


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_rows_as_sql(spark, sf_dir, name):
    from oracle import connect, difference

    assert difference(queries.QUERIES[name](spark, sf_dir), queries.ORACLES[name], connect(sf_dir)) == ""


def test_shares_and_rates_add_up(spark, sf_dir):
    shares, mix = queries.p9_shares(spark, sf_dir).collect(), queries.p9_mix(spark, sf_dir).collect()
    assert sum(r.mixed_tokens for r in shares) == sum(r.tokens * r.copies for r in mix) and abs(sum(r.actual_share for r in shares) - 1) < 1e-9
    assert all(r.copies <= next(s.max_repeats for s in shares if s.source == r.source) for r in mix)
    rates, found = queries.p10_rates(spark, sf_dir).collect(), queries.p10_found(spark, sf_dir).count()
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert sum(r.documents for r in rates) == documents.count() and sum(r.flagged for r in rates) == found == sum(round(r.rate * r.documents) for r in rates)


# 1. names


def test_names_of_one_author(spark):
    cells = [
        "Mulvaunkem, Elizabeth R. | Mulvaunkem, Beth", "MULVAUNKEM, Elizabeth|E. R. Mulvaunkem; Mulvuankem, Elizabeth R", "Mulvaunkem, Oskar|Mulvaunkem, O",
        "Centre for Fish Health Research, Flemkeimstei|CFHR, Flemkeimstei; Ctr. for Fish Health Research (Flemkeimstei)", "Centre for Marine Research, Flemkeimstei", "Na | n/a | Brondelskar, Rebecca; Brondelskar, Robert; Brondelskar, R",
    ]
    got = {(r.name_a, r.name_b) for r in names.variant_pairs(screening(spark, [(i, None, None, None, None, c, 0, None) for i, c in enumerate(cells)])).collect()}
    groups = [
        ["Mulvaunkem, Elizabeth R.", "Mulvaunkem, Beth", "MULVAUNKEM, Elizabeth", "E. R. Mulvaunkem", "Mulvuankem, Elizabeth R"], ["Mulvaunkem, Oskar", "Mulvaunkem, O"],
        ["Centre for Fish Health Research, Flemkeimstei", "CFHR, Flemkeimstei", "Ctr. for Fish Health Research (Flemkeimstei)"],
    ]
    assert got == {tuple(sorted(p)) for g in groups for p in combinations(g, 2)}


def test_hot_surname_beside_a_rarer_given_name(spark):
    import string

    hot = [f"Hansen, {a}{b}qu{b}wix" for a in string.ascii_uppercase if a != "Z" for b in "abdefg"]
    cells = [*hot, "Zoltan Hansen", "Hansen, Zoltan"]
    got = {(r.name_a, r.name_b) for r in names.variant_pairs(screening(spark, [(i, None, None, None, None, c, 0, None) for i, c in enumerate(cells)])).collect()}
    assert ("Hansen, Zoltan", "Zoltan Hansen") in got


def test_rarity_decides_about_an_initial():
    names_ = ("hansen", ["erik"]), ("hanson", ["e"])
    common, rare = names.Rarity({"hansen": 9_000, "hanson": 5_000, "erik": 4_000}, 30_000), names.Rarity({"hansen": 2, "hanson": 1, "erik": 4_000}, 30_000)
    assert names.compare(*names_, common) < names.NAME_SIMILARITY <= names.compare(*names_, rare)
    assert names.compare(("mulvaunkem", ["oskar"]), ("mulvaunkem", ["erik"]), rare) == 0.0


def test_alike_tokens_against_all_pairs(spark):
    rng = random.Random(3)
    words = {"".join(rng.choice("abcde") for _ in range(rng.randrange(3, 13))) for _ in range(150)}
    for w in sorted(words):
        for _ in range(3):
            v = w
            for _ in range(rng.randrange(1, 3)):
                i, kind = rng.randrange(max(1, len(v) - 1)), rng.randrange(4)
                v = v[:i] + v[i + 1 :] if kind == 0 else v[:i] + rng.choice("abcde") + v[i + (kind == 1) :] if kind < 3 else v[:i] + v[i : i + 2][::-1] + v[i + 2 :]
            words.add(v)
    got = {(r.token, r.other) for r in names.alike_tokens(spark.createDataFrame([(w, "a") for w in words], "token string, initial string")).collect()}
    want = {(x, y) for x, y in combinations(sorted(words), 2) if names._same_family(x, y)}
    assert want - got == set() and len(want) > 300


def test_two_letters_missing_and_words_of_bodies(spark):
    cells = ["Blelplylgrulsen, Margaret", "Blelplylgren, Margaret", "Marine Research Institute, Bergen|MRI, Bergen", *(f"Institute of {a}{b}ology Research, Bergen" for a in ("Bi", "Zo", "Ge", "Hydr") for b in ("a", "e", "i", "u"))]
    got = {(r.name_a, r.name_b) for r in names.variant_pairs(screening(spark, [(i, None, None, None, None, c, 0, None) for i, c in enumerate(cells)])).collect()}
    assert ("MRI, Bergen", "Marine Research Institute, Bergen") in got
    far = names.variant_pairs(screening(spark, [(1, None, None, None, None, "Blelplylgrul, Margaret", 0, None), (2, None, None, None, None, "Blelplylgr, Margaret", 0, None)])).collect()
    assert [tuple(r) for r in far] == [("Blelplylgr, Margaret", "Blelplylgrul, Margaret")]


def test_labels_of_a_long_chain(spark):
    links = spark.createDataFrame([(f"n{i:03}", f"n{i + 1:03}") for i in range(60)] + [("x", "y")], "a string, b string")
    got = {r.node: r.label for r in least_labels(links).collect()}
    assert set(got.values()) == {"n000", "x"} and len(got) == 63


# 2. format duplicates


def test_copies_against_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for i in range(300):
        title, doi = f"Title number {rng.randrange(40)}: an {'' if rng.random() < 0.5 else 'odd '}one", rng.choice([None, "10.1234/a(1)", "10.1234/b"])
        shown = rng.choice([title, title.upper(), title.replace(":", " -"), f"“{title}”", title.replace(" ", "  ")])
        form = doi and rng.choice([doi, "https://doi.org/" + doi, "doi: " + doi.upper(), doi.replace("/", "%2F") + "."])
        a, b = (form, shown) if form and rng.random() < 0.2 else (shown, form)
        rows.append((i + 1, None, a, None, b, None, 0, None, (title.lower(), doi)))
    groups = defaultdict(list)
    for r in rows:
        groups[r[-1]].append(r[0])
    want = {(g[0], s) for g in groups.values() for s in g[1:]}
    df = screening(spark, [r[:-1] for r in rows])
    assert {tuple(r) for r in format_duplicates.copies_of_records(df).collect()} == want
    many = format_duplicates.collapse(df.repartition(7), format_duplicates.record_key(F.col("title"), F.col("doi")), F.col("record_sequence"))
    assert sorted(r.copies for r in many.collect()) == sorted(map(len, groups.values()))


def test_one_run_over_many_partitions(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 < 2, F.lit("same")).otherwise(F.concat(F.lit("t"), F.col("id"))).alias("k"), F.col("id").alias("o"))
    got = format_duplicates.collapse(df, F.col("k"), F.col("o")).where("copies > 1").collect()
    assert [(r.first, r.copies) for r in got] == [(0, 3334)]


@pytest.mark.parametrize(("a", "b", "same"), [("R&D in pens", "R & D in pens", True), ("x & y", "x and y", False), ("net-pen", "net pen", True), ("A (b)", "A [B]", True), ("fish one", "fish once", False)])
def test_title_forms(spark, a, b, same):
    df = screening(spark, [(1, None, a, None, None, None, 0, None), (2, None, b, None, None, None, 0, None)])
    assert (format_duplicates.copies_of_records(df).count() == 1) is same


# 3. survivorship


def test_survivors(spark):
    rows = [
        (1, "a", "155-178", "https://x.example/lens/1-2-3", "10.1234/abc", "2020-01-01"), (1, "b", "e123", "https://x.example/lens/1-2-3-4", "10.1234/ab", "2021-01-01"),
        (1, "c", "p. 155", "https://x.example/lens/1-2...", "10.", "2022-01-01"), (2, "d", "-", "https://x.example/", "doi:", "2020-01-01"), (3, "e", "1-2", None, "https://doi.org/10.1234/z", "2020-01-01"),
        (3, "f", "1-2", "www.x.example/a", "10.1234/z", "2020-01-01"), (None, "g", "1-2", None, None, "2020-01-01"),
    ]
    df = spark.createDataFrame(rows, "duplicate_group bigint, record_id string, pages string, url_raw string, doi string, u string").withColumn("updated_at", F.to_timestamp("u"))
    got = {(r.duplicate_group, r.field_name): r.record_id for r in survivorship.surviving_members(df).collect()}
    assert got == {(1, "pages"): "b", (1, "url_raw"): "b", (1, "doi"): "a", (3, "pages"): "f", (3, "doi"): "e"}


# 4. history


def test_history(spark):
    rows = [
        (1, "a", "Effect of sheltered oxygen on mooring in ember trout from Fjenvik", None, "10.1234/a", None, 0, None), (2, "b", "Book review", None, "10.1234/b", None, 0, None),
        (3, "c", "A note on effect of sheltred oxygen on mooring in ember trout from Fjenvik", None, None, None, 1, None), (4, "d", "Book review", None, "10.1234/c", None, 1, None),
        (5, "e", "Effect of sheltered oxygen on mooring in ember trout from Fjenvik: part II", None, None, None, 1, None), (6, "f", "Another title under that number of record", None, "10.1234/a", None, 2, None),
        (7, "g", "https://doi.org/10.1234/B", None, "BOOK REVIEW.", None, 2, None), (8, "h", "Effect of sheltered oxygen on mooring in ember trout from Fjenvik", None, "10.1234/z", None, 2, None),
        (9, "i", "Correction to: Effect of sheltered oxygen on mooring in ember trout from Fjenvik", None, None, None, 3, None),
    ]
    got = {tuple(r) for r in history.repeated_rows(screening(spark, rows)).collect()}
    assert got == {(1, 3), (2, 7)}


def test_index_finds_what_one_pass_finds(spark, tmp_path):
    rng, rows = random.Random(2), []
    adj, noun = ["cold", "warm", "deep", "wild", "mild", "early", "late", "dense"], ["oxygen", "kidney", "mooring", "liver", "plasma", "sensor", "market", "filter", "spleen"]
    for i in range(60):
        base = f"Effect of {rng.choice(adj)} {rng.choice(noun)} on {rng.choice(noun)} and {rng.choice(noun)} in {rng.choice(adj)} {rng.choice(noun)} from Place{i}vik"
        rows.append((i + 1, f"r{i}", base, None, f"10.1234/x{i}" if i % 3 else None, None, 0, None))
    again = [(100 + r[0], r[1], r[2].upper() if r[0] % 2 else r[2].replace("Effect", "Efect"), None, r[4], None, 1, None) for r in rows[::2]]
    one = {tuple(r) for r in history.repeated_rows(screening(spark, rows + again)).collect()}
    index = history.HistoryIndex(spark, str(tmp_path / "index"), buckets=4)
    assert index.check(screening(spark, rows)).count() == 0
    index.append(screening(spark, rows))
    two = {(r.accepted_sequence, r.new_sequence) for r in index.check(screening(spark, again)).collect()}
    assert one == two and len(one) == 30


def test_index_tells_copies_of_a_batch_and_rows_without_title(spark, tmp_path):
    title, doi = "Oxygen in deep moorings of Place7vik and its spleen sensor", "10.1234/t"
    old = screening(spark, [(1, None, title, None, None, None, 0, None), (2, None, None, None, doi, None, 0, None)])
    new = screening(spark, [(11, None, title, None, None, None, 1, None), (12, None, title.upper(), None, None, None, 1, None), (13, None, None, None, doi, None, 1, None), (14, None, None, None, "10.1234/u", None, 1, None)])
    history.HistoryIndex(spark, str(tmp_path / "index"), buckets=4).append(old)
    index = history.HistoryIndex(spark, str(tmp_path / "index"), buckets=4)
    got = {(r.accepted_sequence, r.new_sequence) for r in index.check(new).collect()}
    assert got == {(1, 11), (1, 12), (2, 13)} == {tuple(r) for r in history.repeated_rows(old.union(new)).collect()}


def test_pieces_meet_in_buckets_without_exchange(spark, tmp_path):
    table = history.Bucketed(spark, str(tmp_path / "pieces"), "part", history._PIECES, 4)
    for at in (0, 50):
        table.append(spark.range(at, at + 100).select((F.col("id") % 70).alias("part"), F.col("id").alias("seq"), F.lit(1).cast("bigint").alias("doi")))
    left, right = table.read().hint("merge"), table.read().hint("merge")
    plan = left.join(right.select("part"), "part", "left_semi")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_titles_within_two_changes_share_a_piece():
    def changed(words):
        for i in range(len(words) + 1):
            yield [*words[:i], f"inserted{i}of{len(words)}", *words[i:]]
            if i < len(words):
                yield [*words[:i], *words[i + 1 :]]
                yield [*words[:i], f"replaced{i}of{len(words)}", *words[i + 1 :]]

    for n in range(3, 13):
        title = [f"content{i}" for i in range(n)]
        for common in (frozenset(), frozenset(title[::3]), frozenset(title[1::2])):
            own = set(history.pieces(title, [], common))
            for one in changed(title):
                for two in changed(one):
                    # In short titles a left out word is no typo.
                    if n >= 5 and len(two) >= 5 or len(two) == n == len(one):
                        assert own & set(history.pieces(two, [], common)), (title, two, common)


@pytest.mark.parametrize(("a", "b"), [("Salmon kidney", "Slamon kidny"), ("Mooring", "Moorign"), ("Kidney mooring plasma", "Kidny morring plasma")])
def test_short_titles_with_typos(spark, a, b):
    df = screening(spark, [(1, None, a, None, None, None, 0, None), (2, None, b, None, None, None, 1, None)])
    assert [tuple(r) for r in history.repeated_rows(df).collect()] == [(1, 2)]


def test_long_titles_with_a_typo_near_each_end():
    words = [f"content{'abcdefghijklmnopqrst'[i] * 3}" for i in range(20)]
    typos = [words[0] + "x", *words[1:-1], words[-1][:-1]]
    assert history.same_title(words, typos) and history.same_title(words, [*typos, "update"])
    assert not history.same_title(words, [typos[0], words[1] + "x", *typos[2:]])


# 6. markup


@pytest.mark.parametrize(
    ("text", "clean", "marked"),
    [
        ("<jats:title>Aims</jats:title><jats:p>We saw <i>x</i> &amp; y.</jats:p>", "# Aims\nWe saw x & y.", True),
        ("== Aims ==\n* One [[fish farm|pen]] ''x''", "# Aims\n- One pen x", True),
        ("**Aims**\n\n* one\n* two `code`", "Aims\n- one\n- two `code`", True),
        ("\\section{Aims} A \\emph{b} at 5\\,\\% with $\\alpha = 1$", "# Aims\nA b at 5 % with $\\alpha = 1$", True),
        ("```r\nfit(x)\n```", "```r\nfit(x)\n```", True),
        ("Costs of $40 and $50, 3 < x < 9, R&D, a_b_c, {as in} pens #3, 5 * 10^3, p <= 0.5, note*", None, False),
    ],
)
def test_markup(text, clean, marked):
    got, number = markup.extract(text)
    assert (number > 0) is marked and got == (clean if marked else text)


def test_losing_paths_go(spark):
    df = spark.createDataFrame([(1, "s", "Prose of the text <ref>key 12</ref> goes on {{citation needed}} here.")], "k int, host string, text string")
    assert markup.cleaned(df, ["k"]).first().clean == "Prose of the text goes on here."


def test_hosts_decide_on_one_path(spark):
    prose = ["Trout were fed twice a day in all pens", "Smolts grew well after their first winter at sea", "Mussels were hung on long lines near the farm"]
    menu = '<div class="menu"><a href="/">Home</a> <a href="/a">About us</a></div>'
    rows = [(i, "shop", f'{p}. {p}.<div class="menu">{menu[18:-6]}</div>') for i, p in enumerate(prose)]
    rows += [(10 + i, "farm", f'Results {i}.<div class="menu">{p}.</div>') for i, p in enumerate(prose)]
    rows += [(20 + i, "copy", f'{p}. {p}.<span class="c">Copyright {2000 + i} by the publisher</span>') for i, p in enumerate(prose)]
    rows += [(30 + i, "own", f'Results {i}.<span class="c">{p}.</span>') for i, p in enumerate(prose)]
    rows += [(40 + i, "notes", f"Pens<ref>{p}</ref> were full.") for i, p in enumerate(prose)] + [(50 + i, "keys", f"Pens<ref>smith201{i}</ref> were full.") for i in range(3)]
    votes = {(r.host, r.path): r.wins for r in markup.path_votes(spark.createDataFrame(rows, "k int, host string, text string")).collect()}
    assert not votes["shop", "html>div.menu"] and votes["farm", "html>div.menu"]
    assert not votes["copy", "html>span.c"] and votes["own", "html>span.c"]
    assert votes["notes", "html>ref"] and not votes["keys", "html>ref"]
    clean = {r.k: r.clean for r in markup.cleaned(spark.createDataFrame(rows, "k int, host string, text string"), ["k"]).collect()}
    links = spark.createDataFrame([(1, "l", "In a [[fish farm|pen]] or [a tank](https://a.b/c) of ![x1](/p1.png) ours")], "k int, host string, text string")
    assert markup.cleaned(links, ["k"]).first().clean == "In a pen or a tank of ours"
    assert "About" not in clean[0] and prose[0] in clean[10] and "Copyright" not in clean[20] and prose[0] in clean[40]


# 7. canonical


def test_trie_finds_what_all_distances_find():
    rng = random.Random(1)
    entries = [(str(i), "".join(rng.choice("abcd") for _ in range(rng.randrange(3, 9)))) for i in range(80)]
    trie = canonical.Trie()
    for key, name in entries:
        trie.add(name, key)
    for _ in range(120):
        word = "".join(rng.choice("abcd") for _ in range(rng.randrange(2, 10)))
        want = {(d, k) for k, n in entries if (d := history.distance(word, n, 2)) <= 2}
        assert set(trie.within(word, 2)) == want


@pytest.mark.parametrize(
    ("value", "want"),
    [("wild Ember truot", "EMB"), ("trout, ember", "EMB"), ("N. ignivagus (farmed)", "EMB"), ("Nordsalmus ignivagus - ember trout", "EMB"), ("Embertrout juveniles?", "EMB"), ("Turbot", None), ("not fish: seaweed", None)],
)
def test_species_values(value, want):
    trie = canonical.build_trie([("EMB", "Ember trout"), ("EMB", "N. ignivagus"), ("EMB", "Nordsalmus ignivagus"), ("UMB", "Umber grayling")])
    assert canonical.lookup(trie, value)[0] == want


# 8. contamination


def passages(seed=3):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("ox", "ki", "mo", "li", "pla", "se", "ma", "fi") for b in ("gen", "ring", "ver", "sma", "nsor", "rket", "lter")]
    return rng, lambda n: [rng.choice(words) for _ in range(n)]


def test_leaks(spark):
    rng, some = passages()
    shared = "Read the following passage about fish farming and answer the question"
    items = [(i, f"{shared}. {' '.join(some(60))}") for i in range(1, 21)]
    docs, want = [], set()
    for d in range(200):
        text = some(80)
        item = rng.choice(items)
        words = item[1].split()[11:]
        kind = d % 5
        if kind == 0:
            at = rng.randrange(0, 30)
            part = words[at : at + 24]
            part[7], part[16] = "changed", "worrd"
            text[40:40] = [w.upper() + "," for w in part]
            want.add((d, item[0]))
        elif kind == 1:
            text[30:30] = words[5:12]
        elif kind == 2:
            text[30:30] = shared.split()
        docs.append((d, " ".join(text), "s"))
    frames = spark.createDataFrame(docs, "doc_id bigint, text string, source string"), spark.createDataFrame(items, "item_id bigint, text string")
    assert {tuple(r) for r in contamination.leaks(*frames).collect()} == want
    assert {tuple(r) for r in contamination.leaks(*frames, broadcast_seeds=10).collect()} == want  # the joined way


def test_layouts_of_one_item_are_one_item(spark):
    _, some = passages(4)
    words, other = some(30), some(30)
    items = [(1, " ".join(words)), (2, "  ".join(words).upper()), (3, ", ".join(words) + "."), (4, " ".join(other))]
    docs = spark.createDataFrame([(1, " ".join(some(20) + words + some(20)), "s")], "doc_id bigint, text string, source string")
    frame = spark.createDataFrame(items, "item_id bigint, text string")
    assert sorted(tuple(r) for r in contamination.leaks(docs, frame).collect()) == [(1, 1), (1, 2), (1, 3)]


def test_phrases_that_many_items_share_still_find(spark):
    _, some = passages(5)
    phrases = [some(4) for _ in range(10)]
    items = [(i, " ".join(w for p in phrases[i % 10 :] + phrases[: i % 10] for w in [*p, f"own{i}a", f"own{i}b", f"own{i}c"])) for i in range(40)]
    docs = spark.createDataFrame([(1, "before " + " ".join(items[7][1].split()[3:25]) + " after", "s")], "doc_id bigint, text string, source string")
    assert [tuple(r) for r in contamination.leaks(docs, spark.createDataFrame(items, "item_id bigint, text string")).collect()] == [(1, 7)]


def test_seeds_of_a_batch_are_those_of_its_texts():
    rng, some = passages(2)
    texts = [" ".join(some(rng.randrange(0, 12))) for _ in range(50)] + [None, ""]
    lists = [contamination.tokens(t or "") for t in texts]
    got = sorted(zip(*(x.tolist() for x in contamination.batch_seeds(lists))))
    coder = contamination.Coder()
    want = [(i, int(p), int(h)) for i, words in enumerate(lists) for at, hs in contamination.seed_hashes(coder(words)) for p, h in zip(at, hs.view("int64"))]
    assert got == sorted(want)


# 9. mixing


@pytest.mark.parametrize("wrong", [(1,), (13,), (7,), (1, 14), (2, 13)])
def test_errors_near_the_ends_of_a_leak(wrong):
    least = 15 + len([w for w in wrong if w == 14])
    item = [f"word{i}" for i in range(40)]
    part = [f"other{i}" if i in wrong else w for i, w in enumerate(item[10 : 10 + least])]
    doc = [f"before{i}" for i in range(20)] + part + [f"after{i}" for i in range(20)]
    told = [True] * len(item)
    assert contamination.leaked(item, doc, told, contamination.Coder(), 15, 0.2)
    assert not contamination.leaked(item, doc[:-21] + doc[-20:], told, contamination.Coder(), least, 0.2)


def test_mix_reaches_its_shares(spark):
    docs = [(i, "word " * (5 + i % 7), "big" if i < 900 else "small" if i < 960 else "unlisted") for i in range(1000)]
    targets = spark.createDataFrame([("big", 0.6, 1), ("small", 0.4, 3), ("gone", 0.2, 2)], "source string, target_share double, max_repeats int")
    used, report = mixing.mixed(spark.createDataFrame(docs, "doc_id bigint, text string, source string"), targets)
    rows = {r.source: r for r in report.collect()}
    assert rows["gone"].state == "no documents" and rows["unlisted"].state == "not listed"
    assert abs(rows["big"].actual_share - 0.6) < 0.01 and abs(rows["small"].actual_share - 0.4) < 0.01
    assert rows["small"].most_copies == 3 and rows["big"].most_copies == 1
    assert used.groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("t")).where("source = 'big'").first().t == rows["big"].mixed_tokens


@pytest.mark.parametrize(("budget", "want"), [(4_000, {"big": 1_000, "small": 3_000}), (400, {"big": 320, "small": 80}), (10**9, {"big": 1_000, "small": 9_000})])
def test_mix_spends_a_given_budget(spark, monkeypatch, budget, want):
    docs = [(i, "word " * 9 + "word", "big" if i < 100 else "small") for i in range(1000)]
    targets = spark.createDataFrame([("big", 0.8, 1), ("small", 0.2, 1)], "source string, target_share double, max_repeats int")
    monkeypatch.setattr(mixing, "RANGE_ROWS", 50)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, source string")
    per = frame.count() and mixing.token_counts(frame).groupBy("source").agg(F.sum("tokens").alias("t")).collect()
    each = {r.source: r.t for r in per}
    assert each == {"big": 1_000, "small": 9_000}
    _, report = mixing.mixed(frame, targets, budget)
    got = {r.source: r.mixed_tokens for r in report.collect()}
    assert all(abs(got[s] - want[s]) <= 10 for s in want) and sum(got.values()) > min(budget, 10_000) - 10


def test_mix_against_plain_queueing(spark, monkeypatch):
    rng = random.Random(12)
    docs = [(i, "word " * rng.randrange(1, 40), rng.choice("aaab") if i % 9 else "c") for i in range(600)]
    share, repeats = {"a": 0.2, "b": 0.5, "c": 0.3}, {"a": 1, "b": 2, "c": 4}
    targets = spark.createDataFrame([(s, share[s], repeats[s]) for s in share], "source string, target_share double, max_repeats int")
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, source string")
    size = {r.doc_id: (r.source, r.tokens) for r in mixing.token_counts(frame).collect()}
    place = {r.doc_id: r.p for r in frame.select("doc_id", F.xxhash64(F.lit(17), "doc_id").alias("p")).collect()}
    monkeypatch.setattr(mixing, "RANGE_ROWS", 40)
    for budget in (700, 9_000, 14_000):
        queue = []
        for s in share:
            total = 0
            for k in range(repeats[s]):
                for d in sorted((d for d in size if size[d][0] == s), key=lambda d: (place[d], d)):
                    total += size[d][1]
                    queue.append((total / share[s], s, d, k))
        want, total = defaultdict(int), 0
        for _, s, d, _ in sorted(queue):
            total += size[d][1]
            if total > budget:
                break
            want[d] += 1
        got = {r.doc_id: r.copies for r in mixing.mixed(frame, targets, budget)[0].collect()}
        assert got == want, budget


def test_running_sum_against_plain_sum(spark):
    rng = random.Random(4)
    rows = [(g, i, rng.randrange(100)) for g in "ab" for i in range(500)]
    df = spark.createDataFrame(rows, "g string, i int, v bigint")
    got = mixing.running_sum(df, ["g"], F.floor(F.col("i") / 37), ["i"], "v", "s")
    total = defaultdict(int)
    for r in sorted(got.collect(), key=lambda r: (r.g, r.i)):
        total[r.g] += r.v
        assert r.s == total[r.g]


# 10. abuse


def test_abuse_on_held_out_documents(spark):
    _, some = passages(8)
    insults = ["You worthless scum, nobody asked you.", "Shut up, you stupid idiot.", "Go and k!ll yourself, you p i g.", "Women are vermin and should be driven out.", "Cállate, imbécil, nadie te quiere aquí."]
    plain = ["The bastard file was cleaned.", "Dumb luck saved the crop.", "It is a damn shame that the pens froze.", "Sex ratio was scored."]
    docs = []
    for i in range(400):
        line = insults[i % 5] if i % 8 == 0 else plain[i % 4]
        docs.append((i, " ".join(some(30)) + ". " + line + " " + " ".join(some(30)), "forum" if i % 2 else "news"))
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, source string")
    labels = spark.createDataFrame([(i, int(i % 8 == 0)) for i in range(120)], "doc_id bigint, toxic int")
    got = {r.doc_id for r in abuse.abusive_documents(frame, labels).collect()}
    assert got == {i for i in range(400) if i % 8 == 0}
    assert sum(r.flagged for r in abuse.rates(frame, labels).collect()) == 50


def test_scores_do_not_depend_on_the_size_of_the_corpus():
    def scores(times):
        counts = (("", 100_000, 500), ("vermin", 40, 4), ("scum", 10, 0), ("plaice", 60, 2))
        total, within = ({word: x[i] * times for word, *x in counts} for i in (0, 1))
        return abuse.next_model(total, within, frozenset()).scores

    small, large = scores(1), scores(10)
    assert all(abs(small[w] - large[w]) < 0.15 for w in ("vermin", "scum", "plaice"))


def test_disguises():
    m = abuse.Model({"stupid": 3.0, "kill": 3.0, "bastard": 3.0}, frozenset(["krill"]))
    for token, word in (("stup1d", "stupid"), ("s****d", "stupid"), ("stuuuupid", "stupid"), ("k!ll", "kill"), ("b@$tard", "bastard"), ("stpuid", "stupid"), ("krill", None), ("oxygen", None)):
        assert m.known(token) == word, token
    assert abuse.raw_tokens("so s t u p i d and s-t-u-p-i-d")[1::2] == ["stupid", "stupid"]


def test_segments_and_best_scores_against_brute_force():
    rng = random.Random(6)
    docs = [[rng.choice([-1.5, -0.6, 0.0, 0.7, 2.0]) for _ in range(rng.randrange(0, 25))] for _ in range(200)]
    names = {-1.5: "a", -0.6: "b", 0.0: "c", 0.7: "d", 2.0: "e"}
    got = abuse._Tokens(abuse.pa.array([" ".join(names[s] for s in d) for d in docs]))
    score_of = {n: s for s, n in names.items()} | {"": 0.0}
    best = got.best(abuse.np.array([score_of[t] for t in got.different])[got.at])
    for d, (doc, top) in enumerate(zip(docs, best)):
        sums = [sum(doc[i:j]) for i in range(len(doc)) for j in range(i + 1, len(doc) + 1)]
        assert abs(max([0.0, *sums]) - top) < 1e-9 and got.lengths[d] == len(doc)
        found = abuse.segments(doc)
        assert not doc or abs(max([s for s, _, _ in found], default=0.0) - top) < 1e-9
        assert all(b <= c for (_, _, b), (_, c, _) in zip(sorted(found, key=lambda x: x[1]), sorted(found, key=lambda x: x[1])[1:]))


def test_calibration_finds_the_k_of_drawn_scores():
    rng, lam, k = random.Random(9), 1.3, 0.02
    drawn = []
    for _ in range(20_000):
        n = rng.randrange(50, 400)
        drawn.append((max(0.0, (abuse.math.log(k * n) - abuse.math.log(-abuse.math.log(rng.random()))) / lam), 1, n))
    drawn += [(20.0, 1, 100)] * 300  # passages beyond chance are censored
    assert abs(abuse.fitted_k(drawn, lam) / k - 1) < 0.1
    assert abs(abuse.expectation([3.0], 100, lam, k) - k * 100 * abuse.math.exp(-lam * 3.0)) < 1e-12
    assert abuse.expectation([3.0, 3.0], 100, lam, k) < abuse.expectation([3.0], 100, lam, k)


def test_no_word_needs_a_list(spark, monkeypatch):
    _, some = passages(8)
    lines = ["Nobody would miss that gleeb crowd.", "They are all zorpish fools."]
    docs = [(i, " ".join(some(30)) + ". " + (lines[i % 2] if i % 7 == 0 else "The pens were full.") + " " + " ".join(some(30)), "s") for i in range(700)]
    labels = spark.createDataFrame([(i, int(i % 7 == 0)) for i in range(300)], "doc_id bigint, toxic int")
    monkeypatch.setattr(abuse, "LISTED", {})
    got = {r.doc_id for r in abuse.abusive_documents(spark.createDataFrame(docs, "doc_id bigint, text string, source string"), labels).collect()}
    assert got == {i for i in range(700) if i % 7 == 0}
