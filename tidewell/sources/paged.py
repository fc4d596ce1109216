"""A paged source with a cursor: the query object, the walk over its pages, and a Spark data source.

The transport is a callable ``(body, cursor) -> (status, headers, payload)``, so tests and offline
runs bring their own.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

Transport = Callable[[dict, "str | None"], tuple[int, dict, dict]]


@dataclass
class Query:
    """Terms ("*" stands for any ending) of which one must be in title, abstract or keywords,
    publication types that must not be, and the window of the creation time."""

    terms: list[str]
    excluded_types: list[str] = field(default_factory=list)
    start: str | None = None
    end: str | None = None

    def body(self, size: int = 500) -> dict:
        """The request: a boolean query with a page size and a cursor kept for a minute."""
        text = " OR ".join(f"{f}:({w})" for w in self.terms for f in ("title", "abstract", "keyword"))
        must: list[dict] = [{"query_string": {"query": text}}]
        if self.start or self.end:
            must.append({"range": {"created": {k: x for k, x in (("gte", self.start), ("lte", self.end)) if x}}})
        return {"query": {"bool": {"must": must, "must_not": [{"terms": {"publication_type": self.excluded_types}}] if self.excluded_types else []}}, "size": size, "scroll": "1m"}

    def predicate(self, title: Column, abstract: Column, keywords: Column, kind: Column, created: Column) -> Column:
        """The same condition on columns."""
        text = F.lower(F.concat_ws(" ", title, abstract, keywords))
        forms = "|".join("".join(r"\w*" if c == "*" else c if c.isalnum() or c == " " else "\\" + c for c in w.lower()) for w in self.terms)
        found = text.rlike(rf"\b(?:{forms})\b")
        if self.excluded_types:
            found = found & ~F.coalesce(kind.isin(self.excluded_types), F.lit(False))
        if self.start:
            found = found & (created >= F.lit(self.start).cast("timestamp"))
        return found & (created <= F.lit(self.end).cast("timestamp")) if self.end else found


def pages(send: Transport, query: Query, size: int = 500, tries: int = 4, wait: Callable[[float], None] = time.sleep) -> Iterator[dict]:
    """All records of a query: page after page until one is empty or the total is reached.

    204 ends the walk; 429 waits for the time the answer names, two seconds at least, up to
    ``tries`` times; a page without the next cursor before the end is an error.
    """
    cursor, seen = None, 0
    while True:
        for attempt in range(tries):
            status, headers, payload = send(query.body(size), cursor)
            if status != 429:
                break
            if attempt + 1 < tries:
                wait(max(2, int(headers.get("retry-after", 2))))
        if status == 204:
            return
        if status != 200:
            raise OSError(f"the source answered {status}")
        rows = payload.get("data") or []
        yield from rows
        seen += len(rows)
        if not rows or seen >= int(payload.get("total") or 0):
            return
        cursor = payload.get("scroll_id")
        if not cursor:
            raise OSError("the page names no next one")


class PagedSource(DataSource):
    """``spark.read.format("paged")``: records as JSON, one partition per window of creation time.

    Options: ``windows``, a JSON list of [start, end]; ``terms`` and ``excluded_types``, JSON lists.
    ``PagedSource.transport`` is the callable used; it is sent to the tasks.
    """

    transport: Transport | None = None

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return "window_start string, position int, record string"

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
        told = {k: json.loads(self.options.get(k, "[]")) for k in ("windows", "terms", "excluded_types")}
        return _Reader(type(self).transport, told["terms"], told["excluded_types"], told["windows"] or [[None, None]])


class _Reader(DataSourceReader):
    def __init__(self, send: Transport | None, terms: list[str], excluded: list[str], windows: list[list[str | None]]):
        self.send, self.terms, self.excluded, self.windows = send, terms, excluded, windows

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(w) for w in self.windows]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        if self.send is None:
            raise ValueError("PagedSource.transport is not set")
        start, end = partition.value
        for position, row in enumerate(pages(self.send, Query(self.terms, self.excluded, start, end)), 1):
            yield start, position, json.dumps(row)


def read_paged(spark: SparkSession, send: Transport, query: Query, windows: list[tuple[str, str]]) -> DataFrame:
    """The records of all windows, each read by a task of its own."""

    class Bound(PagedSource):
        transport = staticmethod(send)

    spark.dataSource.register(Bound)
    told = {"terms": query.terms, "excluded_types": query.excluded_types, "windows": [list(w) for w in windows]}
    return spark.read.format("paged").options(**{k: json.dumps(x) for k, x in told.items()}).load()
