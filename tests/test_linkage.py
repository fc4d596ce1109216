from __future__ import annotations

import random

import pyarrow as pa
from pyspark.sql import functions as F

from tidewell.operators import linkage
from tidewell.plans import links

WORDS = "growth of wild farmed salmon trout char in cold water cages near the coast a study effects feed light gill parasite load smolt density 2019 xylem quiz jaw".split()


def titles(n: int, seed: int) -> list[str]:
    """Titles and, of each, one near it: letters changed, added, dropped or swapped, words moved."""
    r, out = random.Random(seed), set()
    while len(out) < n:
        words = [r.choice(WORDS) for _ in range(r.choice((1, 3, 8, 12, 25)))]
        text = list(" ".join(words))
        out.add("".join(text))
        for _ in range(r.randint(1, 4)):
            at = r.randrange(len(text))
            how = r.randrange(4)
            if how == 0:
                text[at] = r.choice("abcxyz 019")
            elif how == 1:
                text.insert(at, r.choice("aeiouz9"))
            elif how == 2 and len(text) > 1:
                del text[at]
            else:
                text[at:] = text[at + 1 :] + [text[at]]
        out.add(" ".join("".join(text).split()) or "x")
    return sorted(out)


def signed(texts: list[str]) -> pa.Table:
    return pa.Table.from_batches(linkage._signatures(iter([pa.RecordBatch.from_pydict({"title_key": texts})])))


def test_bits_of_signatures_are_at_most_the_letters_in_which_titles_differ():
    texts = titles(150, 1)
    signs = [(x["s1"] % 2**64, x["s2"] % 2**64) for x in signed(texts).to_pylist()]
    assert [len(w) for w in linkage.WORDS] == [64, 64] and not set(linkage.WORDS[0]) & set(linkage.WORDS[1])
    for x, (x1, x2) in zip(texts, signs):
        for y, (y1, y2) in zip(texts, signs):
            assert (x1 ^ y1).bit_count() + (x2 ^ y2).bit_count() <= sum(abs(x.count(c) - y.count(c)) for c in set(x + y))


def test_titles_of_one_year_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(linkage, "TILE", 90)  # several tiles a side
    a, b = titles(240, 2), titles(200, 3)
    b += [x[:-1] + "q" for x in a[::3]] + [x + "s" for x in a[1::3]] + [x[1:] + x[0] for x in a[2::3]]
    sides = [spark.createDataFrame([(y, x) for x in set(t) for y in (2001, None)] + [(2002, t[0])], "year int, title_key string") for t in (a, b)]
    got = linkage.similar_in_year(*(linkage.with_signatures(s) for s in sides), linkage.FUZZY).collect()
    want = {(2001, x, y) for x in set(a) for y in set(b) if linkage.jaro_winkler(x, y) >= linkage.FUZZY}
    want |= {(2002, a[0], b[0])} if linkage.jaro_winkler(a[0], b[0]) >= linkage.FUZZY else set()
    assert {(r.year, r.x, r.y) for r in got} == want and len(got) == len(want) > 100


def test_few_pairs_of_a_year_are_left_to_compare():
    r = random.Random(4)
    a, b = (signed(["".join(r.choices("etaoinshrdlu cmfgpbvyw", k=r.randint(60, 95))) for _ in range(3000)]) for _ in range(2))
    assert sum(len(i) for i, _ in linkage._near_pairs(a, b, linkage.FUZZY)) < 3000 * 3000 / 1000


def test_records_of_one_year_are_not_all_compared(spark, monkeypatch):
    compared, similarity = [], linkage.with_similarity
    monkeypatch.setattr(linkage, "with_similarity", lambda pairs, least: compared.append(pairs.count()) or similarity(pairs, least))
    r, cols = random.Random(5), "record_sequence int, record_id string, title string, doi string, authors string, year int"
    texts = ["".join(r.choices("etaoinshrdlu cmfgpbvyw", k=r.randint(60, 95))) for _ in range(600)]
    rows = [(n, f"r{n}", text, None, f"author {n}", 2001) for n, text in enumerate(texts)]
    new = [*rows[300:], (600, "r600", texts[0] + "s", None, "author", 2001)]
    got = linkage.link_new_records(spark.createDataFrame(new, cols), spark.createDataFrame(rows[:300], cols)).where("matched_id is not null").collect()
    assert [(x.row, x.matched_id, x.duplicate_basis) for x in got] == [(600, "r0", "same year")]
    assert sum(compared) < 600  # all pairs of the year are 90,300


def test_status_counts_of_one_year_compare_few_pairs(spark, tmp_path, monkeypatch):
    compared, similarity = [], linkage.with_similarity
    monkeypatch.setattr(linkage, "with_similarity", lambda pairs, least: compared.append(pairs.count()) or similarity(pairs, least))
    r = random.Random(6)
    texts = ["".join(r.choices("etaoinshrdlu cmfgpbvyw", k=r.randint(60, 95))) for _ in range(400)]
    rows = [(n, f"r{n}", n % 2, text, f"10.1/{n}", f"author {n}", 2001) for n, text in enumerate([*texts, texts[0], texts[2] + "s"], 1)]
    rows[-2], rows[-1] = ((*x[:2], 1, *x[3:]) for x in rows[-2:])
    cols = "record_sequence int, record_id string, batch_id int, title string, doi string, authors string, year int"
    masters = [(*x[:2], 0, *x[3:]) if x[0] in (1, 3) else x for x in rows]
    spark.createDataFrame(masters, cols).write.parquet(f"{tmp_path}/relevance_screening.parquet")
    got = {(x.duplicate_status, x.duplicate_basis): x.records for x in links.link_status_counts(spark, str(tmp_path)).collect()}
    assert got == {("new", ""): 198, ("duplicate", "exact normalised title"): 1, ("possible_duplicate", "same year"): 1}
    assert sum(compared) < 400  # all pairs of the year are about 40,000


def test_status_counts_do_not_join_records_of_a_crowded_first_author(spark, tmp_path, monkeypatch):
    near, crowded = linkage.near, "a n other"

    def joined(l, r, least):  # noqa: E741
        return F.when(F.col(f"{l}.author_key") == crowded, F.raise_error(F.lit("pair of a crowded key joined")).cast("boolean")).otherwise(near(l, r, least))

    monkeypatch.setattr(linkage, "near", joined)
    r = random.Random(7)
    texts = ["".join(r.choices("etaoinshrdlucmfgpbvyw", k=r.randint(60, 95))) for _ in range(700)]
    rows = [(n, f"r{n}", n % 2, text, "A. N. Other | B", 1000 + n) for n, text in enumerate(texts)]  # 122,500 pairs
    assert all(x[0] != x[1] for x in (texts[0], texts[4]))
    swapped = [x[1] + x[0] + x[2:] for x in texts]  # another prefix and other words
    rows += [(700, "r700", 1, swapped[0], "A. N. Other", 1), (701, "r701", 1, texts[2], "A. N. Other", 1002)]
    rows += [(702, "r702", 1, swapped[4], "A rarer one; C", 2), (703, "r703", 0, texts[4] + "s", "a rarer one", 3)]
    cols = "record_sequence int, record_id string, batch_id int, title string, authors string, year int"
    spark.createDataFrame(rows, cols).withColumn("doi", F.lit(None).cast("string")).write.parquet(f"{tmp_path}/relevance_screening.parquet")
    got = {(x.duplicate_status, x.duplicate_basis): x.records for x in links.link_status_counts(spark, str(tmp_path)).collect()}
    assert got == {("new", ""): 350, ("duplicate", "exact normalised title"): 1, ("probable_duplicate", "same first author"): 2}


def test_keys_in_tiles_and_keys_joined_link_alike(spark, sf_dir, monkeypatch):
    linked = []
    for many in (1, 10**15):
        monkeypatch.setattr(linkage, "MANY", many)
        linked.append(sorted(map(str, links.link_new_vs_master(spark, sf_dir).collect())))
    assert linked[0] == linked[1] and sum("same" in x for x in linked[0]) > 0
