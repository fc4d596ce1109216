"""Session defaults and the one place where lineage is cut."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "tidewell", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the defaults above; ``extra`` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share.

    A cluster names it in ``spark.checkpoint.dir``. Only where that is unset and the master is this
    machine alone, as in tests on local[n], a fresh folder of this machine is used.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or None
    if named is None:
        current = context._jsc.sc().getCheckpointDir()
        if not current.isDefined() and not context.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = current.get() if current.isDefined() else "file://" + tempfile.mkdtemp(prefix="tidewell-")
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from there; survives the loss of executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> tuple[DataFrame, Callable[[], None]]:
    """``df`` as a compressed table of the shared folder, and the function that removes it; for what
    is read several times and is too large to be kept as it lies in memory."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)

    def remove() -> None:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)

    return spark.read.schema(df.schema).parquet(path), remove


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Partitions enough to use every core where the input has too few files."""
    spark = df.sparkSession
    return df.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions", "1"))), *keys)
