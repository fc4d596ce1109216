"""All registered queries of the core, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import board, cleaning, evidence, links, packed, upkeep

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

for _module in (packed, cleaning, links, board, evidence, upkeep):
    QUERIES.update(_module.QUERIES)
    ORACLES.update(_module.ORACLES)
