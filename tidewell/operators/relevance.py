"""Relevance of records: tokens, tf-idf features, logistic scoring, thresholds and training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: English function words left out before n-grams are made.
STOPWORDS = (
    "a about above after again against all am an and any are as at be because been before being below between both but by can cannot could did do does "
    "doing down during each few for from further had has have having he her here hers herself him himself his how i if in into is it its itself me more "
    "most my myself no nor not of off on once only or other ought our ours ourselves out over own same she should so some such than that the their theirs "
    "them themselves then there these they this those through to too under until up very was we were what when where which while who whom why will with would "
    "you your yours yourself yourselves"
).split()


def words(text: Column) -> Column:
    """Lower-case words (letters and digits of any script) without stopwords."""
    bare = F.regexp_replace(F.lower(text), r"https?://\S+", " ")
    return F.filter(F.split(bare, r"[^\p{L}\p{N}]+"), lambda w: (w != "") & ~w.isin(STOPWORDS))


def term_rows(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, term): the words and, joined by "_", the neighbouring ones; the words are made once."""
    made = texts.select(key, words(F.col(text)).alias("_w"))
    pairs = made.select(key, F.explode(F.arrays_zip(F.col("_w").alias("a"), F.slice("_w", F.lit(2), F.greatest(F.size("_w"), F.lit(1))).alias("b"))).alias("p"))
    return pairs.select(key, F.explode(F.array("p.a", F.concat("p.a", F.lit("_"), "p.b"))).alias("term")).where("term is not null")


def term_counts(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, term, tf); counts are merged before the shuffle."""
    return term_rows(texts, key, text).groupBy(key, "term").agg(F.count("*").alias("tf"))


def idf(counts: DataFrame, documents: int, least: int = 3, most: float = 0.98) -> DataFrame:
    """(term, df, idf) of terms in at least ``least`` documents and at most the share ``most``."""
    df = counts.groupBy("term").agg(F.count("*").alias("df")).where((F.col("df") >= least) & (F.col("df") <= most * documents))
    return df.select("term", "df", F.log10(F.lit(float(documents)) / F.col("df")).alias("idf"))


def score(texts: DataFrame, model: DataFrame, intercept: float, key: str, text: str) -> DataFrame:
    """(key, probability): sigmoid of intercept + sum(tf idf coef); a text without a term gets sigmoid(intercept)."""
    met = term_rows(texts, key, text).join(model, "term").groupBy(key).agg(F.sum(F.col("idf") * F.col("coef")).alias("z"))  # terms of the model only
    z = F.lit(intercept) + F.coalesce("z", F.lit(0.0))
    return texts.select(key).join(met, key, "left").select(key, (1 / (1 + F.exp(-z))).alias("probability"))


def decision(probability: Column, exclude: float, include: float) -> Column:
    """Below exclude out, from include on in, else (NULL too) review."""
    return F.when(probability < exclude, "automatic_exclude").when(probability >= include, "automatic_retain").otherwise("review")


def metrics(rows: DataFrame, truth: str, probability: str, threshold: float) -> DataFrame:
    """One row: tp, fp, tn, fn, sensitivity, specificity, precision and npv; NULL over nothing."""
    yes, hit = F.col(truth) == 1, F.col(probability) >= threshold
    counted = rows.where(F.col(truth).isNotNull() & F.col(probability).isNotNull()).agg(
        F.count_if(yes & hit).alias("tp"), F.count_if(~yes & hit).alias("fp"), F.count_if(~yes & ~hit).alias("tn"), F.count_if(yes & ~hit).alias("fn")
    )
    share = lambda a, b: F.try_divide(F.col(a), F.col(a) + F.col(b))
    return counted.select("*", share("tp", "fn").alias("sensitivity"), share("tn", "fp").alias("specificity"), share("tp", "fp").alias("precision"), share("tn", "fn").alias("npv"))


def sweep(rows: DataFrame, truth: str, probability: str) -> DataFrame:
    """threshold, pos, tp, fp, fn for every different probability and the grid of thousandths.

    Thresholds between two probabilities classify alike, so these decide the same operating points.
    The running sums are taken over thousandths first and within them then, so no window holds all
    probabilities.
    """
    known = rows.where(F.col(truth).isNotNull() & F.col(probability).isNotNull())
    grid = known.sparkSession.range(0, 1001).select((F.col("id") / 1000).alias("threshold"), F.lit(0).alias("pos"), F.lit(0).alias("neg"))
    points = known.groupBy(F.col(probability).cast("double").alias("threshold")).agg(F.count_if(F.col(truth) == 1).alias("pos"), F.count_if(F.col(truth) != 1).alias("neg"))
    both = points.unionByName(grid).groupBy("threshold").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).withColumn("_part", F.floor(F.col("threshold") * 1000))
    parts = both.groupBy("_part").agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    higher = Window.orderBy(F.desc("_part")).rowsBetween(Window.unboundedPreceding, -1)  # thousandths
    all_parts = Window.partitionBy()
    offsets = parts.select("_part", F.coalesce(F.sum("_p").over(higher), F.lit(0)).alias("_hp"), F.coalesce(F.sum("_n").over(higher), F.lit(0)).alias("_hn"), F.sum("_p").over(all_parts).alias("_all"))
    inside = Window.partitionBy("_part").orderBy(F.desc("threshold")).rowsBetween(Window.unboundedPreceding, 0)
    summed = both.withColumns({"_ip": F.sum("pos").over(inside), "_in": F.sum("neg").over(inside)}).join(offsets, "_part")
    tp = F.col("_hp") + F.col("_ip")
    return summed.select("threshold", "pos", tp.alias("tp"), (F.col("_hn") + F.col("_in")).alias("fp"), (F.col("_all") - tp).alias("fn"))


def operating_thresholds(rows: DataFrame, truth: str, probability: str, sensitivity: float = 0.99, precision: float = 0.95) -> DataFrame:
    """exclude: the greatest threshold that keeps the sensitivity (else 0); include: the least with
    the precision (else 1); where they cross, include moves above exclude, to the lower quartile of
    the positives (interpolated) at least."""
    s = sweep(rows, truth, probability).withColumn("_n", F.col("tp") + F.col("fn")).withColumn("_rank", F.col("fn") + F.col("pos"))  # positives up to the threshold
    place = (F.col("_n") - 1) * 0.25
    at = lambda k: F.min(F.when((F.col("_rank") >= k + 1) & (F.col("pos") > 0), F.col("threshold")))
    found = s.agg(
        F.coalesce(F.max(F.when(F.try_divide("tp", "_n") >= sensitivity, F.col("threshold"))), F.lit(0.0)).alias("exclude"),
        F.coalesce(F.min(F.when((F.try_divide("tp", F.col("tp") + F.col("fp")) >= precision) & (F.col("tp") > 0), F.col("threshold"))), F.lit(1.0)).alias("include"),
        at(F.floor(place)).alias("low"), at(F.ceil(place)).alias("high"), F.max(place - F.floor(place)).alias("part"),
    )
    quarter = F.col("low") + F.col("part") * (F.col("high") - F.col("low"))
    apart = F.least(F.lit(1.0), F.greatest(F.col("exclude") + 0.05, quarter))
    return found.select("exclude", F.when(F.col("include") <= F.col("exclude"), apart).otherwise(F.col("include")).alias("include"))


def operating_points(rows: DataFrame, truth: str, probability: str, exclude: float, include: float) -> DataFrame:
    """The metrics at the two boundaries, one row each."""
    low = metrics(rows, truth, probability, exclude).withColumn("operating_point", F.lit("automatic-exclude boundary")).withColumn("threshold", F.lit(exclude))
    high = metrics(rows, truth, probability, include).withColumn("operating_point", F.lit("automatic-retain boundary")).withColumn("threshold", F.lit(include))
    return low.unionByName(high)


def train(rows: DataFrame, label: str, text: str, most_rows: int = 50_000, features: int = 20_000, folds: int = 5, strengths: tuple[float, ...] = (0.03, 0.01, 0.003)):
    """(model, intercept): L1 logistic regression on tf-idf, the strongest penalty whose mean log
    loss over deterministic folds is within one standard error of the best.

    It is fitted on at most ``most_rows`` labelled rows, chosen by hash; everything it is applied
    to later is whole.
    """
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import CountVectorizer, IDF

    spark = rows.sparkSession
    known = rows.where(F.col(label).isNotNull()).select(F.col(label).cast("double").alias("label"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    known = known.withColumn("h", F.xxhash64("text")).orderBy("h").limit(most_rows).withColumn("words", words(F.col("text"))).withColumn("fold", F.pmod("h", F.lit(folds)))
    # zip_with, not an index into the words: an outer expression inside a lambda runs once per element
    pairs = F.zip_with("words", F.slice("words", F.lit(2), F.greatest(F.size("words"), F.lit(1))), lambda a, b: F.concat(a, F.lit("_"), b))
    known = known.withColumn("tokens", F.concat("words", F.filter(pairs, lambda p: p.isNotNull())))
    counter = CountVectorizer(inputCol="tokens", outputCol="tf", minDF=3, maxDF=0.98, vocabSize=features).fit(known)
    weigher = IDF(inputCol="tf", outputCol="features").fit(counter.transform(known))
    data = weigher.transform(counter.transform(known)).select("label", "features", "fold").persist()
    fit = lambda part, strength: LogisticRegression(elasticNetParam=1.0, regParam=strength, standardization=False, maxIter=40).fit(part)
    losses = []
    for strength in strengths:
        each = []
        for f in range(folds):
            held = fit(data.where(F.col("fold") != f), strength).transform(data.where(F.col("fold") == f))
            each.append(_log_loss(held))
        mean = sum(each) / len(each)
        error = (sum((x - mean) ** 2 for x in each) / max(1, len(each) - 1)) ** 0.5 / len(each) ** 0.5
        losses.append((mean, error, strength))
    best = min(losses)
    strength = max(s for m, _, s in losses if m <= best[0] + best[1])
    final = fit(data, strength)
    data.unpersist()
    weights = [(t, float(i), float(c)) for t, i, c in zip(counter.vocabulary, weigher.idf.toArray(), final.coefficients.toArray()) if c]
    return spark.createDataFrame(weights or [("", 0.0, 0.0)], "term string, idf double, coef double"), float(final.intercept)


def _log_loss(held: DataFrame) -> float:
    """Mean log loss of a transformed fold."""
    from pyspark.ml.functions import vector_to_array

    p = F.greatest(F.lit(1e-9), F.least(F.lit(1 - 1e-9), vector_to_array("probability")[1]))
    loss = F.when(F.col("label") == 1, -F.log(p)).otherwise(-F.log(1 - p))
    return float(held.agg(F.avg(loss).alias("l")).first().l or 0.0)
