"""Abusive, hateful or sexual content.

Every token gets the log-odds of standing in abusive rather than in other text, under Dirichlet
priors whose weight is a share of the corpus' tokens, so scores do not depend on its size. A
linear scan (Ruzzo and Tompa) finds all maximal scoring segments of a document. Scores become
expectations by extreme-value statistics (Karlin and Altschul): lambda is the root of
mean(exp(lambda * score)) = 1 over the corpus' tokens, K is fitted to the best scores of all
documents, those beyond reach of chance censored; the segments of a document are combined by the
statistic of sums. A document is reported when one of its segments scores enough and is expected
by chance rarely enough.

Training: the first model compares the documents that ``labels`` calls abusive with the corpus;
the next ones compare the segments that the model before finds in all documents with the rest.
All counts are over all documents and made in Spark; the driver gets the words of the model only.

Documents are tokenised once, into a table of the shared folder. A pass over it looks up each
different token of a batch once, so disguises are undone per token and not per occurrence:
look-alike signs, letters spread by spaces or hyphens, stretched letters, masks of asterisks, and
one-letter misspellings of words that count.

Defined results: NULL and empty texts score 0 and have no passages; without labels the list alone
decides; languages need no list where labels exist, and all languages share one table of words.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, written

#: Weight of the prior of the first model, and of its assumed abusive occurrences of a listed word,
#: as shares of the labelled tokens (of a thousandth of the corpus, if those are fewer).
PRIOR, ASSUMED = 0.3, 0.0035
#: The same for the next models, per million tokens of the corpus.
SMOOTH_PER, ASSUMED_PER = 0.3, 2.0
#: Score of words without evidence, and the least and greatest score of any word.
DRIFT = -0.6
LOWEST, HIGHEST = -2.0, 3.5
#: Added to the log-odds: what the segments found so far miss makes words look more ordinary.
LIFT = 1.5
#: How many times its expected number of labelled documents an unlisted word must be in.
LEAST_LIFT = 6.0
#: Words of this share of all tokens are common: never taken for a misspelling of another.
COMMON_SHARE = 2e-5
#: Passes over the corpus after the first model.
ROUNDS = 2
#: A passage scores this much and is expected this rarely; segments from LEAST_PART on are combined.
LEAST_SCORE = 5.0
MOST_EXPECTED = 1e-2
LEAST_PART = 1.0

#: Words that abuse or are obscene by themselves.
LISTED = {
    "en": "arsehole asshole bastard bitch braindead bullshit cocksucker cunt dick dickhead dumbass faggot fuck fucked fucker fucking hooker horny idiot "
    "imbecile moron motherfucker pathetic piss porn porno prick pussy retard scum shit shitty slut stupid subhuman tits twat wanker whore worthless",
    "es": "asquerosa asqueroso cabron cabrones cojones estupido follar furcia gilipollas hijoputa idiota imbecil joder maricon mierda pendejo puta putas "
    "puto retrasado subnormal tetas zorra",
    "no": "dritt drittsekk faen fitte hore horer jævel jævla knulle kuk kukk ludder motbydelig pikk pule rasshøl ræv rævhøl undermennesker",
}
_LOOK = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "l", "€": "e"})
_SPREAD = re.compile(r"(?<![^\W_])(?:[^\W\d_](?:[ \-._*]|·)){2,}[^\W\d_](?![^\W_])")
_WORD = re.compile(r"[^\W_](?:[\w@$!*|€'’]*[\w@$*])?|[@$!*][\w@$!*]*[\w@$*]")


def plain(text: str) -> str:
    if text.isascii():
        return text.lower()
    lower = unicodedata.normalize("NFKD", text.lower())
    return "".join(c for c in lower if not unicodedata.combining(c) or c == "̊").replace("å", "å")


def raw_tokens(text: str) -> list[str]:
    """Words in lower case; letters spread by spaces or signs are put together."""

    def together(m: re.Match) -> str:
        letters = re.sub(r"[^\w]|_", "", m[0])
        if m[0][:2] in ("a ", "i ") and len(letters) > 4:
            return f"{letters[0]} {letters[1:]}"
        return letters

    return _WORD.findall(_SPREAD.sub(together, plain(text)))


def listed_words() -> frozenset[str]:
    return frozenset(w for words in LISTED.values() for w in plain(words).split())


class Model:
    """Scores of words and the tables that undo disguises; lambda and K of their segments."""

    def __init__(self, scores: dict[str, float], common: frozenset[str], ordinary: float = DRIFT, lam: float = 1.0, k: float = 1.0):
        self.scores, self.common, self.ordinary, self.lam, self.k = scores, common, ordinary, lam, k
        self.masks: dict[tuple[str, str, int], str] = {}
        self.near: dict[str, str] = {}
        for w in sorted((w for w, s in scores.items() if s > 0.8 and len(w) >= 3), key=lambda w: (scores[w], w)):
            self.masks[(w[0], w[-1], len(w))] = w
            if len(w) >= 4:
                for i in range(len(w)):
                    self.near[w[:i] + w[i + 1 :]] = w
                self.near[w] = w

    def known(self, token: str) -> str | None:
        """The scored word that a token stands for, or None."""
        table = self.scores
        if token in table:
            return token
        if token in self.common:
            return None  # an ordinary word is no disguise
        if "*" in token and len(token) >= 3:
            hit = self.masks.get((token[0], token[-1], len(token)))
            if hit:
                return hit
        if not token.isalpha():
            if not any(c.isalpha() for c in token) and not any(c in "@$!" for c in token):
                return None
            token = re.sub(r"[^\w]|_", "", token.translate(_LOOK))
            if token in table:
                return token
            one = token.replace("i", "l")
            if one in table and table[one] > 0.8:
                return one
        short = re.sub(r"(.)\1{2,}", r"\1", token)
        if short in table:
            return short
        short = re.sub(r"(.)\1+", r"\1", short)
        if short in table and short != token:
            return short
        if len(token) >= 3:
            if token in self.near:
                return self.near[token]
            if len(token) >= 4:
                u = token.replace("v", "u")
                if u in table and table[u] > 0.8:
                    return u
                for i in range(len(token)):
                    w = self.near.get(token[:i] + token[i + 1 :])
                    if w is not None and abs(len(w) - len(token)) <= 1:
                        return w
        return None

    def score(self, token: str) -> tuple[float, str]:
        """(score, the word it is counted as) of a token."""
        word = self.known(token)
        if word is not None:
            return self.scores[word], word
        return (self.ordinary if token in self.common else DRIFT), token


def segments(scores: list[float]) -> list[tuple[float, int, int]]:
    """All maximal scoring segments (score, from, to) of a sequence, in linear time."""
    kept: list[tuple[int, int, float, float]] = []
    total = 0.0
    for i, s in enumerate(scores):
        if s <= 0:
            total += s
            continue
        start, left, total = i, total, total + s
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= left:
                j -= 1
            if j < 0 or kept[j][3] >= total:
                kept.append((start, i + 1, left, total))
                break
            start, left = kept[j][0], kept[j][2]
            del kept[j:]
    return [(right - left, a, b) for a, b, left, right in kept]


def _tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = pa.array([" ".join(raw_tokens(t)) if t else "" for t in batch.column("text").to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("source"), words], names=["doc_id", "source", "words"])


def tokenised(documents: DataFrame) -> DataFrame:
    """(doc_id, source, words) of every document, words being its tokens joined by spaces."""
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "source", "text")
    return rows.mapInArrow(_tokenise, "doc_id bigint, source string, words string")


class _Tokens:
    """The tokens of a batch: each different one once, and where it stands."""

    def __init__(self, words: pa.Array):
        lists = pc.split_pattern(words, " ")
        coded = lists.flatten().dictionary_encode()
        self.different: list[str] = coded.dictionary.to_pylist()
        self.at = coded.indices.to_numpy(zero_copy_only=False)
        self.starts = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        blank = pc.equal(words, "").to_numpy(zero_copy_only=False)
        self.lengths = np.where(blank, 0, np.diff(self.starts))

    def best(self, scores: np.ndarray) -> np.ndarray:
        """Score of each document's best segment: the greatest rise of the running sum above its
        least value so far, which a deep fall before each document starts anew."""
        if not len(scores):
            return np.zeros(0)
        step = scores.copy()
        fall = float(np.abs(scores).sum()) + 1.0
        runs = np.cumsum(step)
        doc = np.repeat(np.arange(len(self.lengths)), np.diff(self.starts))
        sunk = runs - fall * doc
        before = np.empty_like(sunk)
        before[0] = 0.0
        before[1:] = sunk[:-1]
        first = self.starts[:-1]
        before[first] = sunk[first] - scores[first]
        least = np.minimum.accumulate(before)
        return np.maximum(np.maximum.reduceat(sunk - least, first), 0.0)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counted = pc.value_counts(pc.split_pattern(batch.column("words"), " ").flatten())
        yield pa.RecordBatch.from_arrays([counted.field("values"), counted.field("counts")], names=["word", "n"])


def word_counts(tokens: DataFrame) -> DataFrame:
    """(word, n) of all tokens; "" counts the texts without any."""
    return tokens.select("words").mapInArrow(_word_counts, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _inside(model: Model):
    """(word, y) per batch: occurrences inside segments that score enough; "" counts them all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = _Tokens(batch.column("words"))
            told = [model.score(t) for t in got.different]
            scores = np.array([s for s, _ in told])[got.at] if told else np.zeros(0)
            sums: dict[str, int] = {}
            for d in np.flatnonzero(got.best(scores) >= LEAST_SCORE).tolist():
                first, last = int(got.starts[d]), int(got.starts[d + 1])
                for s, a, b in segments(scores[first:last].tolist()):
                    if s >= LEAST_SCORE:
                        for at in got.at[first + a : first + b].tolist():
                            sums[told[at][1]] = sums.get(told[at][1], 0) + 1
                            sums[""] = sums.get("", 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array(list(sums.values()), pa.int64())], names=["word", "y"])

    return run


def _meant(model: Model):
    """(word, n) of the words that tokens are counted as."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [model.score(t)[1] if t else "" for t in batch.column("word").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), batch.column("n")], names=["word", "n"])

    return run


def first_model(labelled: dict[str, tuple[int, int, int]], own: int, total: int, counts: dict[str, int], common: frozenset[str]) -> Model:
    """Model of the labelled documents and the list.

    ``labelled`` has per word its occurrences and documents among the labelled ones, and its
    occurrences in the corpus. A word that is not listed scores only if it is in more labelled
    documents than chance explains: at the corpus' rate, the Poisson probability of so many must be
    below one in fifty, and they must be LEAST_LIFT times as many as expected (ordinary words next
    to abuse are not).
    """
    listed, table = listed_words(), {}
    base = max(float(own), total / 1000.0, 1.0)
    weight = PRIOR * base
    for w in set(labelled) | listed:
        y, seen, n = labelled.get(w, (0, 0, counts.get(w, 0)))
        share = (n + 0.5) / (total + 0.5)
        if w not in listed and not _beyond_chance(seen, share * own):
            continue
        up, down = y + weight * share + (ASSUMED * base if w in listed else 0.0), n + weight * share
        delta = math.log(up / (own + weight)) - math.log(down / (total + weight))
        table[w] = max(0.0, min(HIGHEST if w in listed else HIGHEST / 1.75, delta))
    return Model(table, common)


def _beyond_chance(n: int, mean: float) -> bool:
    if n < 2 or n < LEAST_LIFT * mean:
        return False
    below, term = 0.0, math.exp(-mean)
    for i in range(n):
        below += term
        term *= mean / (i + 1)
    return 1.0 - below < 0.02


def next_model(total: dict[str, int], within: dict[str, int], common: frozenset[str]) -> Model:
    """Log-odds of standing in abusive rather than in other text, under the Dirichlet prior.

    ``total`` and ``within`` count words in all texts and in abusive segments, "" all tokens. The
    pseudo-counts are in proportion to the tokens, at every count.
    """
    listed, tokens, inside = listed_words(), max(total.get("", 0), 1), within.get("", 0)
    rate = (inside + 1.0) / (tokens + 2.0)
    smooth, assumed = SMOOTH_PER * tokens / 1e6, ASSUMED_PER * tokens / 1e6
    table: dict[str, float] = {}
    for w in {w for w, y in within.items() if w and y > 1} | listed:
        n, y = total.get(w, 0), within.get(w, 0)
        up = y + smooth * rate + (assumed if w in listed else 0.0)
        down = max(n - y, 0) + smooth * (1.0 - rate)
        table[w] = max(LOWEST, min(HIGHEST, math.log(up / down) + LIFT))
    return Model(table, common, LOWEST, _lambda(table, total, tokens))


def _lambda(table: dict[str, float], counts: dict[str, int], total: int) -> float:
    """The positive root of mean(exp(lambda * score)) = 1 over the corpus' tokens."""
    known = [(counts[w] / total, s) for w, s in table.items() if counts.get(w)]
    rest = max(0.0, 1.0 - sum(p for p, _ in known))

    def excess(x: float) -> float:
        return sum(p * math.exp(x * s) for p, s in known) + rest * math.exp(x * DRIFT) - 1.0

    low, high = 0.0, 20.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if excess(mid) < 0 else (low, mid)
    return max(low, 1e-3)


def fitted_k(bins: list[tuple[float, int, int]], lam: float, low: float = LEAST_PART / 2, high: float = LEAST_SCORE) -> float:
    """K by maximum likelihood from (best score, documents, tokens) of all documents; scores below
    ``low`` and from ``high`` on, where chance ends, are censored."""
    middle = [b for b in bins if low <= b[0] < high]
    below = sum(t for s, _, t in bins if s < low) * math.exp(-lam * low)
    above = [(d, t / d * math.exp(-lam * high)) for s, d, t in bins if s >= high and d and t]
    chance = sum(t * math.exp(-lam * s) for s, _, t in middle) + below
    number = sum(d for _, d, _ in middle)
    if not chance:
        return 1.0

    def slope(k: float) -> float:
        return number / k - chance + sum(d * x / math.expm1(min(k * x, 500.0)) for d, x in above)

    a, b = 1e-12, 1e6
    for _ in range(200):
        mid = math.sqrt(a * b)
        a, b = (mid, b) if slope(mid) > 0 else (a, mid)
    return a


def expectation(parts: list[float], tokens: int, lam: float, k: float) -> float:
    """Expected number of documents' worth of chance: the least over the r best segments of
    exp(-T) T^(r-1) / (r! (r-1)!), T being the sum of lambda * score - ln(K tokens), each r at half
    the weight of the one before; one segment's is K tokens exp(-lambda score)."""
    space = max(k * tokens, 1e-12)
    best, sum_, weight = space, 0.0, 1.0
    for r, s in enumerate(sorted(parts, reverse=True), 1):
        sum_ += lam * s - math.log(space)
        if r == 1:
            best = min(best, math.exp(-sum_))
        elif sum_ > 0:
            chance = math.exp(-sum_ + (r - 1) * math.log(sum_) - math.lgamma(r + 1) - math.lgamma(r))
            best = min(best, chance * weight)
        weight *= 2.0
    return best


def train(tokens: DataFrame, labels: DataFrame, rounds: int = ROUNDS) -> Model:
    """Model of the labelled documents, then of the segments that it finds in the whole corpus.

    To the driver come the common words (at most 1 / COMMON_SHARE), the words that labelled
    documents hold beyond chance, and those that stand in abusive segments more than once.
    """
    counts = cut(word_counts(tokens))
    total = int(counts.where("word <> ''").agg(F.sum("n")).first()[0] or 0)
    common = frozenset(r.word for r in counts.where(F.col("n") >= max(5, COMMON_SHARE * total)).select("word").collect()) - {""}
    bad = labels.where("toxic = 1 and doc_id is not null").select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct()
    known = tokens.join(bad, "doc_id", "left_semi").select(F.monotonically_increasing_id().alias("row"), F.split("words", " ").alias("w"))
    per_document = known.select("row", F.explode("w").alias("word")).where("word <> ''").groupBy("row", "word").agg(F.count("*").alias("y"))
    seen = cut(per_document.groupBy("word").agg(F.sum("y").alias("y"), F.count("*").alias("seen")))
    own = int(seen.agg(F.sum("y")).first()[0] or 0)
    listed = sorted(listed_words())
    enough = (F.col("seen") >= 2) & (F.col("seen") >= F.lit(LEAST_LIFT * own / max(total, 1)) * F.col("n")) | F.col("word").isin(listed)
    chosen = seen.join(counts, "word").where(enough).collect()
    listed_counts = {r.word: r.n for r in counts.where(F.col("word").isin(listed)).collect()}
    model = first_model({r.word: (r.y, r.seen, r.n) for r in chosen}, own, total, listed_counts, common)
    for _ in range(rounds):
        inside = tokens.select("words").mapInArrow(_inside(model), "word string, y bigint").groupBy("word").agg(F.sum("y").alias("y")).where("y > 1")
        meant = counts.mapInArrow(_meant(model), "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
        rows = meant.join(inside, "word", "left").where(F.col("y").isNotNull() | F.col("word").isin(listed)).collect()
        within = {r.word: r.y for r in rows if r.y}
        within[""] = sum(within.values())
        model = next_model({r.word: r.n for r in rows} | {"": total}, within, common)
    return model


def _rating(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = _Tokens(batch.column("words"))
            told = [model.score(t)[0] if t else 0.0 for t in got.different]
            scores = np.array(told)[got.at] if told else np.zeros(0)
            best = got.best(scores)
            parts: list[list[float]] = [[] for _ in range(batch.num_rows)]
            for d in np.flatnonzero(best >= LEAST_PART).tolist():
                found = segments(scores[got.starts[d] : got.starts[d + 1]].tolist())
                parts[d] = [s for s, _, _ in found if s >= LEAST_PART]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("source"), pa.array(got.lengths, pa.int64()), pa.array(best, pa.float64()), pa.array(parts, pa.list_(pa.float64()))],
                names=["doc_id", "source", "tokens", "score", "parts"],
            )

    return run


def _expected(lam: float, k: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            expected, passages = [], []
            for n, score, parts in zip(*(batch.column(c).to_pylist() for c in ("tokens", "score", "parts"))):
                expected.append(expectation(parts or [score], n, lam, k))
                passages.append(sum(s >= LEAST_SCORE and k * n * math.exp(-lam * s) <= MOST_EXPECTED for s in parts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("source"), batch.column("score"), pa.array(expected, pa.float64()), pa.array(passages, pa.int32())],
                names=["doc_id", "source", "score", "expected", "passages"],
            )

    return run


def scored(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, source, score, expected, passages) of every document."""
    tokens, remove = written(tokenised(documents))
    model = train(tokens, labels)
    rated = cut(tokens.mapInArrow(_rating(model), "doc_id bigint, source string, tokens bigint, score double, parts array<double>"))
    remove()
    bins = rated.groupBy(F.round("score", 1).alias("s")).agg(F.count("*").alias("d"), F.sum("tokens").alias("t")).collect()  # tenths of a score
    k = fitted_k([(r.s, r.d, r.t) for r in bins], model.lam)
    return rated.mapInArrow(_expected(model.lam, k), "doc_id bigint, source string, score double, expected double, passages int")


def rates(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Per source the documents, those with a significant passage, their rate and mean score."""
    bad = F.col("passages") > 0
    return scored(documents, labels).groupBy("source").agg(
        F.count("*").alias("documents"), F.count_if(bad).alias("flagged"), F.avg(bad.cast("double")).alias("rate"), F.avg("score").alias("mean_score")
    )


def abusive_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id of each document with at least one significant passage."""
    return scored(documents, labels).where("passages > 0").select("doc_id").distinct()
