"""RIS exports: two readers and a writer.

The strict reader takes the line that ends a record as the text source's delimiter, so one large
file is read in parallel; lines are put in order inside a record only. A record's number is its
place and comes from counts per block of the input, not from a single sort. The loose reader is for
files typed or exported by hand and reads each as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as t
from ..session import cut

#: RIS tags of the fields; several values of one tag are joined by " | ".
TAGS = {
    "type": "TY", "record_id": "ID", "ti": "TI", "short_title": "ST", "abstract_raw": "AB", "authors": "AU", "doi_raw": "DO", "year_raw": "PY",
    "journal": "T2", "volume": "VL", "issue": "IS", "pages": "SP", "url_raw": "UR",
}


def blocks(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, at, body): the text before each line "ER  -", with its block of the input and
    its order there; what follows the last such line of a file is dropped."""
    raw = spark.read.text(path, lineSep="\nER  -").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"), F.replace("value", F.lit("\r")).alias("body")
    )
    last = raw.groupBy("file").agg(F.max(F.struct("start", "at")).alias("last"))
    return raw.join(F.broadcast(last), "file").where(F.struct("start", "at") < F.col("last")).drop("last")  # one row per file


def _fields(body: Column) -> Column:
    """array<struct<tag, value>>: continuation lines joined by a space, lines before a tag dropped."""
    joined = F.regexp_replace(body, r"\n(?![A-Z0-9]{2}\s{2}-)[ \t]*", " ")
    lines = F.filter(F.split(joined, "\n"), lambda x: x.rlike(r"^[A-Z0-9]{2}\s{2}-"))
    return F.transform(lines, lambda x: F.struct(F.substring(x, 1, 2).alias("tag"), F.trim(F.regexp_replace(x, r"^[A-Z0-9]{2}\s{2}-\s?", "")).alias("value")))


def _values(tag: str) -> Column:
    """Values of a tag joined by " | "; NULL where it is absent or empty."""
    found = F.filter("fields", lambda f: f["tag"] == tag)
    return F.nullif(F.array_join(F.transform(found, lambda f: f["value"]), " | "), F.lit(""))


def read_ris(spark: SparkSession, path: str) -> DataFrame:
    """Parsed records: record_sequence from 1 per order of file and place, one column per field."""
    got = blocks(spark, path).withColumn("fields", _fields(F.col("body"))).where(F.size("fields") > 0)
    pick = {n: _values(tag) for n, tag in TAGS.items()}
    counts = got.groupBy("file", "start").agg(F.count("*").alias("n"))
    before = Window.orderBy("file", "start").rowsBetween(Window.unboundedPreceding, -1)  # one row per block
    offsets = counts.select("file", "start", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("file", "start").orderBy("at"))
    rows = got.withColumns(pick).withColumn("place", inside).join(offsets, ["file", "start"])
    names = [n for n in TAGS if n != "ti"]
    return rows.select((F.col("offset") + F.col("place")).cast("int").alias("record_sequence"), F.coalesce("ti", "short_title").alias("title"), *names, F.size("fields").alias("raw_field_count"))


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """``read_ris`` with cleaned and derived columns."""
    p = read_ris(spark, path)
    title, abstract, doi = t.clean_html(F.col("title")), t.clean_html(F.col("abstract_raw")), t.valid_doi(F.col("doi_raw"))
    return p.withColumns(
        {
            "title": title, "abstract": abstract, "doi": doi, "year": t.first_year(F.col("year_raw")), "title_normalised": t.alphanumeric(title),
            "abstract_word_count": t.word_count(abstract), "title_word_count": t.word_count(title), "has_title": title.isNotNull(), "has_abstract": abstract.isNotNull(),
            "has_valid_doi": doi.isNotNull(), "parser_missing_type": F.col("type").isNull(), "parser_missing_id": F.col("record_id").isNull(),
        }
    )


def read_loose_ris(spark: SparkSession, path: str) -> DataFrame:
    """Looser tags ("TI - x"); authors and keywords are arrays, of other tags the last one counts."""
    whole = spark.read.text(path, wholetext=True).select(F.regexp_replace(F.regexp_replace("value", "\r\n?", "\n"), "^﻿", "").alias("value"))
    parts = F.split("value", r"(?m)^ER\s{0,2}[- ]\s?[^\n]*(?:\n|$)")
    bodies = whole.select(F.posexplode(F.slice(parts, F.lit(1), F.size(parts) - 1)).alias("block", "body"))
    joined = F.regexp_replace("body", r"\n {2,}", " ")
    lines = F.filter(F.split(joined, "\n"), lambda x: x.rlike(r"^[A-Z0-9]{2}\s{0,2}[- ]\s?"))
    fields = F.transform(lines, lambda x: F.struct(F.substring(x, 1, 2).alias("tag"), F.trim(F.regexp_replace(x, r"^[A-Z0-9]{2}\s{0,2}[- ]\s?", "")).alias("value")))
    rows = bodies.withColumn("fields", fields)
    some = lambda *tags: F.transform(F.filter("fields", lambda f: f["tag"].isin(*tags)), lambda f: f["value"])
    last = lambda *tags: F.coalesce(*[F.try_element_at(some(tag), F.lit(-1)) for tag in tags])
    out = rows.select(
        "block", last("TI", "T1").alias("title"), last("AB", "N2").alias("abstract"), last("PY", "Y1").alias("year"), last("DO").alias("doi"),
        some("AU", "A1").alias("authors"), some("KW").alias("keywords"), F.lit("manual_ris").alias("source"),
    )
    ids = F.when(F.coalesce("doi", F.lit("")) != "", F.array(F.struct(F.lit("doi").alias("type"), F.col("doi").alias("value")))).otherwise(F.array().cast("array<struct<type:string,value:string>>"))
    return out.withColumn("external_ids", ids).where("coalesce(title, '') <> '' or coalesce(abstract, '') <> ''")


def manual_manifest(rows: DataFrame, name: str) -> DataFrame:
    """One row about a file read by hand: its records, the status and what follows from it."""
    some = F.col("records") > 0
    counted = rows.agg(F.lit(name).alias("source_file"), F.count("*").alias("records"), F.count_if(F.size("external_ids") > 0).alias("with_doi"))
    return counted.withColumns({"status": F.when(some, "records_found").otherwise("no_records"), "downstream_action": F.when(some, "run_update").otherwise("none")})


def to_ris(records: DataFrame, order: str | None = None) -> DataFrame:
    """(value): one RIS record per row of type, record_id, title, abstract, authors (array), doi, year.

    With ``order``, a column whose values are unique, records without an id get their place in that
    order as id: its values are counted by ranges, so no window holds all rows.
    """
    if order is not None:
        ranged = records.repartitionByRange(F.col(order)).sortWithinPartitions(order).withColumn("_part", F.spark_partition_id())
        ranged = cut(ranged)
        sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
        before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
        offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
        place = F.row_number().over(Window.partitionBy("_part").orderBy(order)) + F.col("_before")
        records = ranged.join(offsets, "_part").withColumn("record_id", F.coalesce(F.nullif("record_id", F.lit("")), place.cast("string")))
    line = lambda tag, c: F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(f"{tag}  - "), t.squish(c)))
    authors = F.array_join(F.transform(F.coalesce("authors", F.array().cast("array<string>")), lambda a: F.concat(F.lit("AU  - "), a)), "\n")
    return records.select(
        F.concat_ws(
            "\n", F.lit("TY  - JOUR"), line("ID", F.col("record_id")), line("TI", F.col("title")), F.nullif(authors, F.lit("")), line("AB", F.col("abstract")),
            line("DO", F.col("doi")), line("PY", F.substring(F.col("year").cast("string"), 1, 4)), F.lit("ER  - "),
        ).alias("value")
    )


def validate(spark: SparkSession, path: str, least: int = 1) -> DataFrame:
    """One row: lines, records begun and ended, titles, ids, and whether the file can be read."""
    lines = spark.read.text(path)
    has = lambda tag: F.count_if(F.col("value").rlike(rf"(?i)^{tag}\s*-"))
    counted = lines.agg(F.count("*").alias("lines"), has("TY").alias("ty"), has("ER").alias("er"), has("TI").alias("ti"), has("ID").alias("id"))
    return counted.withColumn("valid", (F.col("er") > 0) & (F.col("ty") >= least) & (F.col("ti") > 0))
