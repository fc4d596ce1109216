"""Variant spellings of names typed by people.

Spellings are counted, read into a family part, given names and initials (or, for collective
authors, into the words of a body and its place) and linked where

* their family tokens are alike: a prefix-filtered set-similarity join on the q-grams of the token,
  rarest q-grams first, the prefix and the overlap that is verified being as long as the edits
  allowed ask for (tokens of up to ``SHORT`` letters, of which edits may leave no q-gram, meet in
  their letters less one, and swapped letters in the sorted letters less one); and so are their given names, which meet in their letters less one or
  two, or at least their initials, where one side has no more; and
* the whole agrees: a soft weighted token similarity, each token weighted by its rarity among the
  spellings, in which a token may be misspelt (the less so, the more usual both forms are),
  abbreviated or replaced by a nickname, and a given name that contradicts another counts against.

No hot key joins all its spellings: a given name that is written out meets its likes and the
spellings that have initials only. Collective authors meet in one word and the first letters of
their other words, which an acronym has too.

Spellings with less information (no middle name, initials only) join an author only where exactly
one fits, so a shared surname or an initial never brings two authors together. A plain given name
that is used at least as often as any of its spellings with a middle initial gathers all of them.

Defined results: NULL and empty cells and placeholders hold no names; a spelling that fits two
authors stays alone; one spelling occurring many times is one spelling.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut, spread
from .graph import least_labels
from .history import distance

PLACEHOLDERS = ("na", "n/a", "-", "--", "nan", "null", "none", "unknown", "anonymous", "anon", "anon.", "et al", "et al.", "?", "")

#: Given names and the short forms in use for them.
NICKNAMES = {
    "abigail": "abby abbie gail", "alexander": "alex sasha sandy xander lex", "augusta": "gusta gussie", "carlos": "carlito",
    "charles": "charlie chuck chas", "christina": "chris tina christy chrissy", "dmitri": "dima mitya", "dorothea": "thea dora dot dorrie",
    "edward": "ed eddie ned ted ward", "elizabeth": "liz beth betty lisa eliza lizzie bess", "esther": "essie hester ettie", "frances": "fran fanny",
    "francisco": "fran paco pancho cisco", "frederick": "fred freddy rick fritz", "gabriela": "gabi gaby gabby", "henrietta": "hetty etta hettie harriet",
    "ingeborg": "inga inge borghild", "isabella": "isa bella izzy bel", "james": "jim jimmy jamie", "johannes": "hans jo johan hannes",
    "john": "jack johnny", "jose": "pepe chepe", "katherine": "kate kathy kit katie kat", "lawrence": "larry laurie lars", "leonard": "len leo lenny",
    "lucia": "lucy lu luz", "margaret": "meg peggy maggie greta madge", "michael": "mike mick mickey mischa", "nicholas": "nick klaus nicky colin",
    "oliver": "ollie noll", "patricia": "pat trish patty tricia", "rajesh": "raj raju", "rebecca": "becky becca bex", "richard": "rick dick rich",
    "robert": "rob bob bert bobby robbie", "samuel": "sam sammy", "sigrid": "siri sigga", "susan": "sue susie", "theodore": "ted theo teddy",
    "thomas": "tom tommy", "timothy": "tim timmy", "ulrich": "uli ulli", "victoria": "vicky tori vic vickie", "viktor": "vik vitya",
    "virginia": "ginny ginger gina", "wilhelmina": "mina willa minnie billie", "william": "bill will billy liam willy", "yvonne": "vonnie evie",
    "zacharias": "zach zack zak",
}
_CANONICAL: dict[str, frozenset[str]] = {}
for _full, _short in NICKNAMES.items():
    for _n in _short.split():
        _CANONICAL[_n] = _CANONICAL.get(_n, frozenset()) | {_full}
    _CANONICAL[_full] = _CANONICAL.get(_full, frozenset()) | {_full}

#: What is written around a name, and the words of collective authors.
TITLES = frozenset("dr prof professor mr mrs ms phd md msc bsc jr sr dvm ii iii".split())
BODIES = {
    "department": "dept dpt dep", "centre": "center ctr cent", "institute": "inst institut", "laboratory": "lab labs", "university": "univ",
    "school": "sch", "faculty": "fac", "agency": "", "ministry": "min", "consortium": "", "society": "soc", "council": "", "association": "assoc",
    "group": "grp", "station": "stn", "college": "coll", "academy": "acad", "research": "res rsch",
}
_BODY = {w: full for full, short in BODIES.items() for w in [full, *short.split()]}
_SMALL = frozenset("the of for and in at de la".split())
_MORE_LETTERS = str.maketrans({"ø": "o", "đ": "d", "ł": "l", "ß": "ss", "æ": "ae", "œ": "oe", "þ": "th", "ð": "d"})

#: Least similarity of two whole names.
NAME_SIMILARITY = 0.75
#: Tokens of so many letters and fewer meet in deletions; q-grams lost by one edit but a swap, at most.
SHORT = 6
LOST = 3
MOST_EDITS = 2
#: Similarity of tokens one edit apart, two edits apart, of misspelt given names and of an initial;
#: misspellings lose up to USUAL of it where both forms are frequent.
ONE_EDIT, TWO_EDITS, MISSPELT, INITIAL, USUAL = 0.85, 0.7, 0.8, 0.6, 0.3
#: Spellings of other tables that are assumed beside the given ones, so few spellings make no token frequent.
POPULATION = 10_000
#: Weight of a letter, which one in 26 shares.
LETTER = math.log(27.0)


def fold(text: str) -> str:
    lower = unicodedata.normalize("NFKD", text.lower()).translate(_MORE_LETTERS)
    return "".join(c for c in lower if not unicodedata.combining(c))


def is_body(name: str) -> bool:
    words = re.findall(r"[a-z]+", fold(name))
    if any(w in _BODY and w not in ("min", "res", "soc", "lab", "labs", "group", "cent", "dep") for w in words):
        return True
    if "res" in words and len(words) >= 4 or "lab" in words:
        return True
    raw = re.findall(r"[^\W\d_]+", name)
    short = [w for w in raw if w.isupper() and 3 <= len(w) <= 5]
    return len(raw) == 2 and len(short) == 1 and any(not w.isupper() and len(w) >= 5 for w in raw) and not re.search(r"[A-Z]\.", name)


def tokens_of(name: str) -> list[str]:
    return [t for t in re.findall(r"[a-z]+", fold(name).replace("-", "").replace("'", "")) if t not in TITLES]


def readings(name: str) -> list[tuple[str, list[str]]]:
    """(family part, given parts) as the name may be read: without a comma any long token may be the family."""
    cleaned = re.sub(r",\s*(?:PhD|MD|MSc|Dr|Jr|Sr)\b\.?", "", name)
    if "," in cleaned:
        before, _, after = cleaned.partition(",")
        family, given = tokens_of(before), tokens_of(after)
        if family and given:
            return [("".join(family), _given(given, after))]
        tokens = family or given
    else:
        tokens = tokens_of(cleaned)
    long = [i for i, t in enumerate(tokens) if len(t) >= 3]
    if not long:
        return []
    if len(tokens) == 1:
        return [(tokens[0], [])]
    out = []
    for i in long:
        rest = tokens[:i] + tokens[i + 1 :]
        out.append((tokens[i], _given(rest, cleaned)))
        if i + 1 in long and len(tokens) > 2:
            out.append((tokens[i] + tokens[i + 1], _given(tokens[:i] + tokens[i + 2 :], cleaned)))
    return out


def unread(a: tuple[str, list[str]], b: tuple[str, list[str]], rare: dict[str, int]) -> bool:
    """Does the rarest long token of a stand where b has nothing? Such a reading takes a given name for the family."""
    tokens = [t for t in a[1] if len(t) >= 3]
    extra = [t for t in a[1][len(b[1]) :] if len(t) >= 3]
    least = min((rare.get(t, 1) for t in [a[0], *tokens]), default=0)
    return any(rare.get(t, 1) == least for t in extra) and rare.get(a[0], 1) > least


def _given(tokens: list[str], raw: str) -> list[str]:
    """Given parts; "VN" and "V.N." are two initials."""
    out: list[str] = []
    for t in tokens:
        if len(t) == 2 and re.search(rf"\b{t.upper()}\b", raw):
            out.extend(t)
        else:
            out.append(t)
    return out


def _same_given(x: str, y: str, typos: bool) -> float:
    """1 for the same given name or nickname, less for a misspelling or an initial, -1 for another name."""
    if x == y:
        return 1.0
    cx, cy = _CANONICAL.get(x, frozenset((x,))), _CANONICAL.get(y, frozenset((y,)))
    if len(x) == 1 or len(y) == 1:
        one, other = (x, cy | {y}) if len(x) == 1 else (y, cx | {x})
        return INITIAL if any(n[0] == one for n in other) else -1.0
    if cx & cy:
        return 1.0
    if typos and min(len(x), len(y)) >= 3:
        d = distance(x, y, 2)
        if d == 1 or d == 2 and min(len(x), len(y)) >= 7:
            return MISSPELT
    return -1.0


def edits(n: int) -> int:
    """Edits allowed between family tokens, the shorter of n letters."""
    return 0 if n < 4 else 1 if n < 9 else MOST_EDITS


def _same_family(x: str, y: str) -> float:
    if x == y:
        return 1.0
    d, most = distance(x, y, 2), edits(min(len(x), len(y)))
    return 0.0 if d > most else ONE_EDIT if d == 1 else TWO_EDITS


def level(given: list[str]) -> int:
    """How much a reading tells: 0 one initial, 1 initials, 2 a full given name, 3 also a middle one."""
    if not given:
        return -1
    if len(given[0]) == 1:
        return 1 if len(given) > 1 else 0
    return 3 if len(given) > 1 else 2


class Rarity:
    """Weights of the tokens of two spellings by how many spellings have them."""

    def __init__(self, counts: dict[str, int], total: int):
        self.counts, self.total = counts, total + POPULATION
        self.most = math.log(1.0 + self.total)

    def __call__(self, token: str) -> float:
        return math.log(1.0 + self.total / self.counts.get(token, 1))


def compare(a: tuple[str, list[str]], b: tuple[str, list[str]], rarity: Rarity) -> float:
    """Soft weighted similarity of two readings.

    The weight of a pair of tokens is that of its more usual form; where they differ, the rarer
    form's weight tells how likely it is a slip rather than a name of its own.
    """
    family = _same_family(a[0], b[0])
    if not family or not a[1] or not b[1]:
        return 0.0
    typos = family == 1.0 or family == ONE_EDIT and min(len(a[0]), len(b[0])) >= 8
    if family == ONE_EDIT and (min(len(a[1][0]), len(b[1][0])) < 5 or distance(a[1][0], b[1][0], 1) > 1):
        typos = False  # two slips in one name need long tokens

    def pair(x: str, y: str, same: float) -> tuple[float, float]:
        if len(x) == 1 or len(y) == 1:
            return LETTER, same
        wx, wy = rarity(x), rarity(y)
        return min(wx, wy), same - (USUAL * (1.0 - max(wx, wy) / rarity.most) if 0.0 < same < 1.0 else 0.0)

    parts = [pair(a[0], b[0], family)] + [pair(x, y, _same_given(x, y, typos and not i)) for i, (x, y) in enumerate(zip(a[1], b[1]))]
    if min(s for _, s in parts) < 0 and all(s <= 0 for _, s in parts[1:2]):
        return 0.0  # another first given name
    return sum(w * s for w, s in parts) / sum(w for w, _ in parts)


def _body_words(name: str) -> tuple[list[str], list[str]]:
    """(canonical words, acronyms) of a collective author."""
    acronyms = [w.lower() for w in re.findall(r"\b[A-Z]{3,5}\b", name) if not name.isupper()]
    words = [w for w in re.findall(r"[a-z]+", fold(name)) if w not in _SMALL and w not in acronyms]
    return [_BODY.get(w, w) for w in words], acronyms


def _alike_word(x: str, y: str) -> bool:
    if x == y or min(len(x), len(y)) >= 3 and (x.startswith(y) or y.startswith(x)):
        return True
    return min(len(x), len(y)) >= 4 and distance(x, y, 1) <= 1


def same_body(a: str, b: str) -> float:
    """Share of the rarer body's words that the other has: as a word, its beginning or in an acronym."""
    (wa, aa), (wb, ab) = _body_words(a), _body_words(b)
    if bool(aa) != bool(ab):
        (short, acronym), long = ((wa, aa), wb) if aa else ((wb, ab), wa)
        place = [w for w in long if any(_alike_word(w, s) for s in short)]
        rest = [w for w in long if w not in place]
        return 1.0 if place and len(short) == 1 and "".join(w[0] for w in rest) == acronym[0] else 0.0
    if aa and ab:
        return 1.0 if aa == ab and len(wa) == len(wb) and all(any(_alike_word(x, y) for y in wb) for x in wa) else 0.0
    if len(wa) != len(wb):
        return 0.0
    left, typos = list(wb), 0
    for x in wa:
        hit = next((y for y in left if x == y), None) or next((y for y in left if _alike_word(x, y)), None)
        if hit is None:
            return 0.0
        typos += hit != x and not (x.startswith(hit) or hit.startswith(x))
        left.remove(hit)
    return 1.0 if typos <= 1 else 0.8 if typos == 2 else 0.0


def body_keys(name: str) -> set[tuple[str, str]]:
    """(word, first letters of the other words or of the acronym) of a collective author."""
    words, acronyms = _body_words(name)
    rest = lambda i: "".join(sorted([w[0] for j, w in enumerate(words) if j != i] + [c for a in acronyms for c in a]))
    return {(w, "*" + rest(i)) for i, w in enumerate(words) if len(w) >= 3}


def deletions(word: str, most: int) -> list[str]:
    """The word without up to ``most`` of its letters."""
    out = {word}
    for _ in range(most):
        out |= {w[:i] + w[i + 1 :] for w in out for i in range(len(w))}
    return sorted(out)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (name, token, initial, given, keys) by which a spelling can be found, one per reading and
    initial; keys are the deletions of a given name that is written out."""
    for batch in batches:
        out: tuple[list, ...] = ([], [], [], [], [])
        for name in batch.column("name").to_pylist():
            rows: set[tuple[str, str, str]] = set()
            if is_body(name):
                rows |= {(word, letters, "") for word, letters in body_keys(name)}
            else:
                for family, given in readings(name):
                    for full in _CANONICAL.get(given[0], frozenset((given[0],))) | {given[0]} if given else ():
                        told = full if len(full) > 2 else ""
                        rows |= {(family, full[0], told)} | ({(family, full[1], told)} if told else set())
            for token, initial, told in sorted(rows):
                for column, value in zip(out, (name, token, initial, told, deletions(told, 2 if len(told) >= 7 else 1) if told else [])):
                    column.append(value)
        yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.string()) for x in out[:4]), pa.array(out[4], pa.list_(pa.string()))], names=["name", "token", "initial", "given", "keys"])


def _judge(total: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [])
            columns = [batch.column(c).to_pylist() for c in ("a", "b", "ta", "ca", "tb", "cb")]
            for a, b, ta, ca, tb, cb in zip(*columns):
                ra, rb = dict(zip(ta, ca)), dict(zip(tb, cb))
                if is_body(a) or is_body(b):
                    score, la, lb = (same_body(a, b) if is_body(a) and is_body(b) else 0.0), 9, 9
                else:
                    score, la, lb, rarity = 0.0, 0, 0, Rarity(ra | rb, total)
                    theirs = readings(b)
                    for x in readings(a):
                        for y in theirs:
                            if unread(x, y, ra) or unread(y, x, rb):
                                continue
                            s = compare(x, y, rarity)
                            if s > score:
                                score, la, lb = s, level(x[1]), level(y[1])
                if score >= NAME_SIMILARITY:
                    for column, value in zip(out, (a, b, la, lb)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int32()), pa.array(out[3], pa.int32())],
                names=["a", "b", "la", "lb"],
            )

    return run


def spellings(authors: DataFrame, column: str = "authors") -> DataFrame:
    """(name, uses): the distinct trimmed texts between the delimiters, counted before the shuffle."""
    one = authors.select(F.explode(F.split(F.col(column), r"[|;]")).alias("name"))
    one = one.select(F.regexp_replace("name", r"^[\s\p{Z}]+|[\s\p{Z}]+$", "").alias("name"))
    return one.where(~F.lower("name").isin(list(PLACEHOLDERS))).groupBy("name").agg(F.count("*").alias("uses"))


def _tokens(name: Column) -> Column:
    flat = F.regexp_replace(name, r"[-']", "")
    return F.array_distinct(F.filter(F.split(F.lower(flat), r"[^\p{L}]+"), lambda t: F.length(t) >= 3))


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = batch.column("name").to_pylist()
        tokens = pa.array([sorted({t for t in tokens_of(n) if len(t) >= 3}) for n in names], pa.list_(pa.string()))
        yield pa.RecordBatch.from_arrays([batch.column("name"), tokens], names=["name", "tokens"])


def q_grams(token: str) -> list[str]:
    padded = f"^{token}$"
    return sorted({padded[i : i + 3] for i in range(len(padded) - 2)})


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """q-grams of longer tokens; deletions of short ones and, behind "#", of the sorted letters."""
    for batch in batches:
        grams, keys = [], []
        for token in batch.column("token").to_pylist():
            n = len(token)
            grams.append(q_grams(token) if n >= SHORT else [])
            bag = ["#" + w for w in deletions("".join(sorted(token)), 1)] if n >= 4 else []
            keys.append((deletions(token, 1) if 3 <= n <= SHORT else []) + bag)
        kind = pa.list_(pa.string())
        yield pa.RecordBatch.from_arrays([batch.column("token"), batch.column("initial"), pa.array(grams, kind), pa.array(keys, kind)], names=["token", "initial", "grams", "keys"])


def _allowed(length: Column) -> Column:
    """``edits`` as a column."""
    return F.when(length < 4, 0).when(length < 9, 1).otherwise(MOST_EDITS)


def alike_tokens(tokens: DataFrame) -> DataFrame:
    """(token, other, initial), token < other: the prefix-filtered set-similarity join, the deletions
    of short tokens, and for swaps the sorted letters of all.

    Two edits without a swap lose no more q-grams than the prefix allows for; with a swap among
    them, the sorted letters differ by one replaced, added or missing letter at most.
    """
    length = F.length("token")
    keyed = cut(spread(tokens.select("token", "initial")).mapInArrow(_keyed, "token string, initial string, grams array<string>, keys array<string>"))
    each = keyed.select("token", "initial", F.explode("grams").alias("g"))
    often = each.groupBy("g").agg(F.count("*").alias("df"))
    ordered = each.join(often, "g").groupBy("token", "initial").agg(F.sort_array(F.collect_list(F.struct("df", "g"))).alias("order"))  # the grams of one token
    # Edits lose LOST q-grams each, so tokens within them share one of the LOST * edits + 1 rarest.
    prefix = F.slice("order", F.lit(1), _allowed(length) * LOST + 1)
    first = ordered.select("token", "initial", length.alias("len"), F.transform("order", lambda s: s["g"]).alias("mine"), F.explode(F.transform(prefix, lambda s: s["g"])).alias("g"))
    band = F.sequence(F.col("len") - _allowed(F.col("len")), F.col("len") + _allowed(F.col("len")))
    second = first.select("g", "initial", F.col("token").alias("other"), F.col("mine").alias("its"), F.explode(band).alias("len"))
    met = first.join(second, ["g", "initial", "len"]).where("token < other").where(F.levenshtein("token", "other", 2 * MOST_EDITS) >= 0)
    shorter = _allowed(F.least(length, F.length("other")))
    long = met.where(F.size(F.array_intersect("mine", "its")) >= F.greatest(F.size("mine"), F.size("its")) - LOST * shorter)
    side = keyed.select("token", "initial", F.explode("keys").alias("g"))
    rest = side.join(side.select("g", "initial", F.col("token").alias("other")), ["g", "initial"]).where("token < other")
    found = long.select("token", "other", "initial").union(rest.select("token", "other", "initial"))
    return found.where(F.levenshtein("token", "other", 2 * MOST_EDITS) >= 0).distinct().where(F.levenshtein("token", "other") <= 2 * shorter)


def candidates(named: DataFrame) -> DataFrame:
    """Pairs (a, b) of spellings whose family tokens are alike and whose given names may be."""
    anchors = cut(spread(named.select("name")).mapInArrow(_read, "name string, token string, initial string, given string, keys array<string>"))
    tokens = cut(anchors.select("token", "initial").distinct())
    near = alike_tokens(tokens)
    near = cut(near.union(near.select("other", "token", "initial")).union(tokens.select("token", F.col("token").alias("other"), "initial")))
    x = anchors.select("token", "initial", F.col("given").alias("gx"), F.col("name").alias("x"), F.col("keys").alias("kx"))
    y = anchors.select(F.col("token").alias("other"), "initial", F.col("given").alias("gy"), F.col("name").alias("y"), F.col("keys").alias("ky"))
    # Initials alone meet everything with that initial, names that are written out only their likes.
    bare = x.where("gx = ''").join(near, ["token", "initial"]).join(y, ["other", "initial"]).select("x", "y")
    told = x.where("gx <> ''").join(near, ["token", "initial"]).select("other", "initial", "x", F.explode("kx").alias("key"))
    full = told.join(y.where("gy <> ''").select("other", "initial", "y", F.explode("ky").alias("key")), ["other", "initial", "key"]).select("x", "y")
    pairs = bare.union(full).where("x <> y")
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def linked_names(authors: DataFrame, column: str = "authors") -> DataFrame:
    """(name, author): author is the least spelling of the name's class; names alone in theirs are left out."""
    names = cut(spellings(authors, column))
    total = max(names.count(), 1)
    folded = cut(names.select("name").mapInArrow(_folded, "name string, tokens array<string>"))
    counts = folded.select(F.explode("tokens").alias("t")).groupBy("t").agg(F.count("*").alias("n"))
    weighed = folded.select("name", F.explode_outer("tokens").alias("t")).join(counts, "t", "left").groupBy("name")
    named = cut(weighed.agg(F.collect_list(F.struct("t", F.coalesce("n", F.lit(1)).alias("n"))).alias("w")).select("name", F.col("w.t").alias("tokens"), F.col("w.n").alias("counts")))
    pairs = candidates(named)
    a = named.select(F.col("name").alias("a"), F.col("tokens").alias("ta"), F.col("counts").alias("ca"))
    b = named.select(F.col("name").alias("b"), F.col("tokens").alias("tb"), F.col("counts").alias("cb"))
    judged = cut(spread(pairs.join(a, "a").join(b, "b").select("a", "b", "ta", "ca", "tb", "cb")).mapInArrow(_judge(total), "a string, b string, la int, lb int"))
    labels = least_labels(judged.where("la = lb").select("a", "b"))
    ends = judged.select(F.col("a").alias("name"), F.col("la").alias("l")).union(judged.select("b", "lb"))
    known = cut(ends.distinct().join(labels.withColumnRenamed("node", "name"), "name", "left").select("name", "l", F.coalesce("label", "name").alias("label")))
    # A class that tells less joins one that tells more where exactly one fits.
    both = judged.select("a", "b", "la", "lb").union(judged.select("b", "a", "lb", "la")).where("la < lb").toDF("a", "b", "la", "lb")
    both = cut(both)
    current = known.select("name", "label").distinct()
    for less in (2, 1, 0):
        own = current.select(F.col("name").alias("a"), F.col("label").alias("from"))
        its = current.select(F.col("name").alias("b"), F.col("label").alias("to"))
        step = both.where(F.col("la") == less).join(own, "a").join(its, "b").where("from <> to").select("from", "to").distinct()
        if less == 2:
            # Several middle initials added to one plain name, which is the usual spelling, are all its.
            uses = current.join(names, "name").groupBy("label").agg(F.sum("uses").alias("uses"))
            step = step.join(uses.toDF("from", "own"), "from").join(uses.toDF("to", "its"), "to")
        else:
            step = step.withColumn("own", F.lit(0)).withColumn("its", F.lit(1))
        step = cut(step)
        fits = step.groupBy("from").agg(F.min("to").alias("to"), F.count("*").alias("n"), (F.max("its") <= F.first("own")).alias("usual"))
        single = fits.where("n = 1").select(F.col("from").alias("label"), "to")
        gathered = step.join(fits.where("n > 1 and usual").select("from"), "from").groupBy(F.col("to").alias("label")).agg(F.min("from").alias("to"))
        moves = single.unionByName(gathered)
        current = cut(current.join(moves, "label", "left").select("name", F.coalesce("to", "label").alias("label")))
    least = current.groupBy("label").agg(F.min("name").alias("author"), F.count("*").alias("n")).where("n > 1")
    return current.join(least, "label").select("name", "author")


def variant_pairs(authors: DataFrame) -> DataFrame:
    """Every pair of different spellings of one author, name_a < name_b."""
    named = cut(linked_names(authors))
    a, b = named.select("author", F.col("name").alias("name_a")), named.select("author", F.col("name").alias("name_b"))
    return a.join(b, "author").where("name_a < name_b").select("name_a", "name_b")
