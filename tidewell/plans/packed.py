"""Queries of the packed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.multivalue import packed_values


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_values(spark.read.parquet(f"{sf_dir}/merge_master_update.parquet"), spark.read.parquet(f"{sf_dir}/build_dashboard.parquet"))


QUERIES = {"p5_found": p5_found}
ORACLES: dict[str, str] = {}
