"""CSV, JSON and manifests at the borders: explicit schemas, empty for NULL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.csv(path, schema=schema, header=True, multiLine=True, escape='"', nullValue="")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True, nullValue="", emptyValue="", escape='"')


def read_harvest(spark: SparkSession, path: str) -> DataFrame:
    """A harvest file of objects whose external_ids and authors may be lists of objects or of texts."""
    schema = "lens_id string, title string, abstract string, created timestamp, date_published string, year_published int, publication_type string, doi string, external_ids string, authors string"
    raw = spark.read.json(path, schema=schema, multiLine=True)
    ids = F.from_json("external_ids", "array<struct<type:string,value:string>>")
    texts = F.try_element_at(F.filter(F.from_json("external_ids", "array<string>"), lambda x: x.startswith("10.")), F.lit(1))  # ids given as plain texts
    from_ids = F.try_element_at(F.transform(F.filter(ids, lambda x: F.lower(x["type"]) == "doi"), lambda x: x["value"]), F.lit(1))
    people = F.from_json("authors", "array<struct<display_name:string,name:string,full_name:string>>")
    named = F.filter(F.transform(people, lambda a: F.coalesce(a["display_name"], a["name"], a["full_name"])), lambda x: x.isNotNull())
    return raw.withColumns({"doi": F.coalesce("doi", from_ids, texts), "authors": F.when(F.size(named) > 0, named).otherwise(F.from_json("authors", "array<string>"))}).drop("external_ids")


def reference_problems(table: DataFrame, name: str, columns: list[str]) -> DataFrame:
    """(table, problem) of a reference table: absent columns, no rows."""
    spark = table.sparkSession
    absent = [(name, f"lacks {c}") for c in columns if c not in table.columns]
    return spark.createDataFrame(absent + ([(name, "has no rows")] if table.isEmpty() else []), "table string, problem string")


def file_checksums(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, sha256) of files, for comparing a manifest with what is there."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", "length", F.sha2("content", 256).alias("sha256"))


def changed_files(old: DataFrame, new: DataFrame) -> DataFrame:
    """(path, state) of files that are missing, added or changed between two manifests."""
    both = old.alias("o").join(new.alias("n"), "path", "full")
    state = F.when(F.col("n.sha256").isNull(), "missing").when(F.col("o.sha256").isNull(), "added").when(F.col("o.sha256") != F.col("n.sha256"), "changed")
    return both.select("path", state.alias("state")).where("state is not null")
