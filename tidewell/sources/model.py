"""A relevance model as it is kept: terms as Parquet, intercept, thresholds and specification as JSON."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t
from ..operators import relevance as rv

TERMS = ("term", "idf", "coef")
THRESHOLDS = ("exclude_threshold", "include_threshold")
#: Terms up to which a model is broadcast to the records it scores.
MOST_TERMS = 500_000


@dataclass
class Bundle:
    """A model that passed the checks of ``load_model``."""

    terms: DataFrame
    intercept: float
    thresholds: dict[str, float]
    specification: dict = field(default_factory=dict)


def save_model(path: str, terms: DataFrame, intercept: float, thresholds: dict[str, float], **specification) -> None:
    """Writes the model below ``path``; an existing one is replaced."""
    spark = terms.sparkSession
    terms.select(*TERMS).write.mode("overwrite").parquet(f"{path}/terms")
    told = json.dumps({"intercept": intercept, "thresholds": thresholds, "specification": specification})
    spark.createDataFrame([(told,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/bundle")


def load_model(spark: SparkSession, path: str) -> Bundle:
    """The model below ``path``; ValueError names what is absent or out of order."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/bundle")
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        raise ValueError(f"relevance model not found: {path}")
    told = json.loads(spark.read.text(f"{path}/bundle").first().value)
    absent = [k for k in ("intercept", "thresholds") if k not in told]
    absent += [k for k in THRESHOLDS if k not in told.get("thresholds", {})]
    terms = spark.read.parquet(f"{path}/terms")
    absent += [c for c in TERMS if c not in terms.columns]
    if absent:
        raise ValueError(f"the relevance model lacks {', '.join(absent)}")
    limits = [float(told["thresholds"][k]) for k in THRESHOLDS]
    if not 0.0 <= limits[0] < limits[1] <= 1.0:
        raise ValueError("the thresholds are not in order between 0 and 1")
    return Bundle(terms, float(told["intercept"]), told["thresholds"], told.get("specification", {}))


def screen(records: DataFrame, bundle: Bundle, key: str = "record_sequence") -> DataFrame:
    """(key, relevance_probability, relevance_decision) of records by title (twice) and abstract."""
    texts = records.select(key, t.screening_text(F.col("title"), F.col("abstract")).alias("_text"))
    terms = bundle.terms.select(*TERMS)
    terms = F.broadcast(terms) if terms.count() <= MOST_TERMS else terms
    scored = rv.score(texts, terms, bundle.intercept, key, "_text")
    limits = [float(bundle.thresholds[k]) for k in THRESHOLDS]
    return scored.select(key, F.col("probability").alias("relevance_probability"), rv.decision(F.col("probability"), *limits).alias("relevance_decision"))
