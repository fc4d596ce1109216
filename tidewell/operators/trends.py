"""Yearly counts, growth of topics against the background, and top lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def by_year(view: DataFrame, column: str, name: str) -> DataFrame:
    """Unique records per year and value of an array column."""
    rows = view.where("year is not null").select("record_id", "year", F.explode(column).alias(name))
    return rows.groupBy("year", name).agg(F.count_distinct("record_id").alias("records"))


def year_topics(view: DataFrame) -> DataFrame:
    """Unique records per year and first level of their paths."""
    return by_year(view.withColumn("roots", F.transform("paths", lambda p: F.get(p, F.lit(0)))), "roots", "topic")


def top_values(counts: DataFrame, column: str, n: int) -> DataFrame:
    return counts.orderBy(F.desc("records"), column).limit(n)


def hierarchy_bars(view: DataFrame) -> DataFrame:
    """Assignments per level_2 and level_3 with the parent's total and its rank within level_1."""
    rows = view.select("record_id", F.explode("paths").alias("p")).where(F.size("p") > 0)
    level = [F.coalesce(F.get("p", F.lit(i)), F.lit("General")).alias(f"level_{i + 1}") for i in range(3)]
    counts = rows.select(*level).groupBy("level_1", "level_2", "level_3").agg(F.count("*").alias("assignments"))
    parents = counts.groupBy("level_1", "level_2").agg(F.sum("assignments").alias("parent_total"))
    ranked = parents.withColumn("parent_index", F.row_number().over(Window.partitionBy("level_1").orderBy(F.desc("parent_total"), "level_2")))
    return counts.join(ranked, ["level_1", "level_2"])


def dense_years(counts: DataFrame, column: str) -> DataFrame:
    """Every value with every year from the first to the last, 0 where nothing was counted."""
    span = counts.agg(F.min("year").alias("a"), F.max("year").alias("z"))
    years = span.select(F.explode(F.sequence("a", "z")).alias("year"))
    grid = counts.select(column).distinct().crossJoin(F.broadcast(years))  # topics times years, both bounded
    return grid.join(counts, [column, "year"], "left").select(column, "year", F.coalesce("records", F.lit(0)).cast("bigint").alias("records"))


def background_trend(view: DataFrame, start: int, base: tuple[int, int]) -> DataFrame:
    """Per year the records, the log-linear fit from ``start`` on, and its index to the base years' mean."""
    yearly = view.where("year is not null").groupBy("year").agg(F.count_distinct("record_id").alias("records"))
    fit = yearly.where((F.col("year") >= start) & (F.col("records") > 0)).agg(
        F.regr_slope(F.log("records"), F.col("year")).alias("slope"), F.regr_intercept(F.log("records"), F.col("year")).alias("intercept")
    )
    fitted = yearly.crossJoin(F.broadcast(fit)).withColumn("fitted", F.exp(F.col("intercept") + F.col("slope") * F.col("year")))
    mean = fitted.agg(F.avg(F.when(F.col("year").between(*base), F.col("fitted"))).alias("mean"))
    return fitted.crossJoin(F.broadcast(mean)).select("year", "records", F.round("fitted", 6).alias("fitted"), F.round(F.col("fitted") / F.col("mean"), 6).alias("index"))


def emerging_topics(view: DataFrame, base: tuple[int, int], recent: tuple[int, int], fast: float = 1.25, slow: float = 0.8) -> DataFrame:
    """Per first-level topic: mean of the base and recent years, growth, growth against all records."""
    dense = dense_years(year_topics(view), "topic")
    inside = lambda span: F.when(F.col("year").between(*span), F.col("records"))
    topics = dense.groupBy("topic").agg(
        F.avg(inside(base)).alias("baseline"), F.avg(inside(recent)).alias("recent"),
        F.min(F.when(F.col("records") > 0, F.col("year"))).alias("first_year"), F.max(F.when(F.col("records") > 0, F.col("year"))).alias("last_year"),
    )
    yearly = view.where("year is not null").groupBy("year").agg(F.count_distinct("record_id").alias("records"))
    whole = yearly.agg((F.avg(inside(recent)) / F.avg(inside(base))).alias("background"))
    rows = topics.crossJoin(F.broadcast(whole)).withColumn("growth", F.try_divide("recent", "baseline"))
    relative = F.try_divide("growth", "background")
    return rows.select(
        "topic", F.round("baseline", 6).alias("baseline"), F.round("recent", 6).alias("recent"), "first_year", "last_year", F.round("growth", 6).alias("growth"),
        F.round(relative, 6).alias("relative"),
        F.when(F.col("growth").isNull(), "new").when(relative >= fast, "faster").when(relative <= slow, "slower").otherwise("as background").alias("class"),
    )
