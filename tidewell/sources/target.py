"""Targets: a configuration file that names a table of records, its checks and its manifest."""

from __future__ import annotations

import datetime as dt
import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REQUIRED = ("record_sequence", "record_id", "title", "abstract")


@dataclass
class Target:
    """A configuration with absolute paths, and its records."""

    name: str
    records_file: str
    annotations: dict[str, str]
    config_file: str
    records: DataFrame


def read_target_config(path: str) -> dict:
    """The ``target`` section of a YAML file; paths in it are taken from the file's folder."""
    import yaml

    if not os.path.exists(path):
        raise ValueError(f"target configuration does not exist: {path}")
    with open(path, encoding="utf-8") as file:
        target = (yaml.safe_load(file) or {}).get("target")
    if not target:
        raise ValueError("target configuration must contain a target section")
    for k in ("name", "records_file"):
        if not target.get(k):
            raise ValueError(f"target configuration must specify target.{k}")
    home = os.path.dirname(os.path.abspath(path))
    place = lambda x: os.path.normpath(os.path.join(home, x)) if isinstance(x, str) and x else x
    return target | {"records_file": place(target["records_file"]), "annotations": {k: place(x) for k, x in (target.get("annotations") or {}).items()}}


def validate_records(records: DataFrame, name: str = "target") -> DataFrame:
    """The records, if all required columns are there, and both keys are present and unique."""
    absent = [c for c in REQUIRED if c not in records.columns]
    if absent:
        raise ValueError(f"{name} lacks {', '.join(absent)}")
    seen = records.agg(F.count("*").alias("n"), *[F.count(c).alias(c) for c in REQUIRED[:2]]).first()
    if not seen.n:
        raise ValueError(f"{name} contains no records")
    for c in REQUIRED[:2]:
        if seen[c] < seen.n or not records.groupBy(c).count().where("count > 1").isEmpty():
            raise ValueError(f"{name} must contain unique, non-missing {c} values")
    return records


def unknown_ids(data: DataFrame, records: DataFrame, column: str = "record_id") -> DataFrame:
    """The different ids of ``data`` that the records do not have; NULL is no id."""
    if column not in data.columns:
        raise ValueError(f"the data lack {column}")
    own = records.select(F.col("record_id").cast("string").alias(column)).distinct()
    return data.select(F.col(column).cast("string").alias(column)).where(F.col(column).isNotNull()).distinct().join(own, column, "left_anti")


def assert_target_ids(data: DataFrame, records: DataFrame, column: str = "record_id", label: str = "data") -> DataFrame:
    """``data``, if all its ids are the records'; else ValueError with their number."""
    outside = unknown_ids(data, records, column).count()
    if outside:
        raise ValueError(f"{label} contains {outside} {column} value(s) outside the declared target")
    return data


def load_target(spark: SparkSession, path: str) -> Target:
    target = read_target_config(path)
    if not os.path.exists(target["records_file"]):
        raise ValueError(f"the records file does not exist: {target['records_file']}")
    rows = spark.read.csv(target["records_file"], header=True, multiLine=True, escape='"')
    rows = rows.withColumn("record_sequence", F.col("record_sequence").try_cast("int")) if "record_sequence" in rows.columns else rows
    return Target(target["name"], target["records_file"], target["annotations"], os.path.abspath(path), validate_records(rows, target["name"]))


def write_manifest(target: Target, folder: str, now: dt.datetime | None = None) -> DataFrame:
    """One row about the target, written as CSV below ``folder`` and returned."""
    stamp = (now or dt.datetime.now(dt.timezone.utc)).strftime("%Y-%m-%d %H:%M:%S UTC")
    row = target.records.agg(
        F.lit(target.name).alias("target_name"), F.lit(target.config_file).alias("config_file"), F.lit(target.records_file).alias("records_file"), F.count("*").alias("n_records"),
        F.min("record_sequence").alias("min_record_sequence"), F.max("record_sequence").alias("max_record_sequence"), F.lit(stamp).alias("created_at_utc"),
    )
    row.coalesce(1).write.mode("overwrite").csv(f"{folder}/target_manifest", header=True)
    return row
