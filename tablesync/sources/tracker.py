"""Documents of a tracker in the order of their updates, as a Python Data Source.

``spark.read.format("updated_documents")`` (batch) and ``spark.readStream`` (micro-batches
whose offset is the high-water mark) read a search that lists documents by update time and
key.  Offsets over a list that changes while it is read lose and double documents; here

* the time up to the planning moment is cut into **slices** of about
  ``docs_per_partition`` documents (counted by the search itself), read in parallel; a
  document updated meanwhile leaves its slice for the time after it;
* inside a slice a **cursor** moves along (minute, place in the minute).  Every page begins
  with the last document read; if that one has moved away, the minute is read again and
  what was read before is skipped;
* the time from the planning moment on is one open slice.  :func:`fetch_for_sync` reads it
  once all others are written, so whatever moved out of them is found there.

:func:`updated_between` sends bounds on the update time to the search and lets Spark apply
them exactly, as the search knows minutes only.  They travel as options, not as pushed
filters: Spark 4.1 keeps what a query pushed into a Python source for every later query
of the same frame, which then misses rows.

The fetcher is injected as for :mod:`.documents`; minutes are texts ``yyyy/MM/dd HH:mm`` of
the API's zone, and ``before`` may be ``None``:

* ``now() -> minute``, ``first(query) -> minute | None``
* ``count(query, since, before) -> int``: documents with since <= updated < before
* ``search(query, since, before, start_at, limit) -> list[dict | str]`` in ascending order
  of (update time, key)

Rows: ``key string, updated timestamp, raw string``.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Iterator
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
)

from ..functions.times import MARK_ZONE
from ..session import delete_path, scratch_path
from .documents import PAGE_SIZE, load_fetcher

MINUTE = "%Y/%m/%d %H:%M"
DOCS_PER_PARTITION = 2_000
SCHEMA = "key string, updated timestamp, raw string"


def minute_of(stamp: str) -> str:
    """The minute of an API time (``2024-03-05T10:00:00.000+1100``)."""
    return stamp[:16].replace("-", "/").replace("T", " ")


def later(minute: str, minutes: int = 1) -> str:
    return (dt.datetime.strptime(minute, MINUTE) + dt.timedelta(minutes=minutes)).strftime(MINUTE)


def halfway(since: str, before: str) -> str:
    a, b = dt.datetime.strptime(since, MINUTE), dt.datetime.strptime(before, MINUTE)
    return (a + dt.timedelta(minutes=int((b - a).total_seconds() // 120))).strftime(MINUTE)


def local_minute(instant: dt.datetime, zone: str) -> str:
    if instant.tzinfo is None:
        instant = instant.replace(tzinfo=dt.timezone.utc)
    return instant.astimezone(ZoneInfo(zone)).strftime(MINUTE)


def parts_of(doc) -> tuple[str, str, str]:
    """(key, update time, JSON text) of a document."""
    parsed = json.loads(doc) if isinstance(doc, str) else doc
    raw = doc if isinstance(doc, str) else json.dumps(doc, ensure_ascii=False)
    return parsed["key"], parsed["fields"]["updated"], raw


class Slice(InputPartition):
    """Documents with since <= updated < before; an open slice has no ``before``."""

    def __init__(self, since: str, before: str | None):
        super().__init__((since, before))
        self.since, self.before = since, before


def plan_slices(fetcher, query: str, since: str, before: str, docs_per_partition: int) -> list[Slice]:
    """Slices of [since, before) with at most ``docs_per_partition`` documents, but a
    minute is never cut.  About two counts a slice are asked of the search."""
    out, stack = [], [(since, before)]
    while stack:
        a, b = stack.pop()
        if a >= b:
            continue
        n = fetcher.count(query, a, b)
        middle = halfway(a, b)
        if n > docs_per_partition and a < middle < b:
            stack += [(middle, b), (a, middle)]
        elif n:
            out.append(Slice(a, b))
    return out


def read_slice(fetcher, query: str, since: str, before: str | None, page_size: int = PAGE_SIZE) -> Iterator[tuple[str, str, str]]:
    """(key, update time, JSON text) of every document of the slice, each version once."""
    minute, at = since, 0  # documents of ``minute`` and later that are behind the cursor
    seen: set[tuple[str, str]] = set()  # the versions of the cursor's minute
    last: tuple[str, str] | None = None
    while True:
        overlap = 1 if at else 0
        page = [parts_of(d) for d in fetcher.search(query, minute, before, at - overlap, page_size + overlap)]
        if overlap and (not page or page[0][:2] != last):
            at = 0  # something before the cursor has moved away: the minute again, without what was read
            continue
        fresh = page[overlap:]
        if not fresh:
            return
        for doc in fresh:
            if doc[:2] not in seen:
                yield doc
            if minute_of(doc[1]) > minute:
                minute, at, seen = minute_of(doc[1]), 0, set()
            seen.add(doc[:2])
            at += 1
        last = fresh[-1][:2]


class _Options:
    def __init__(self, options: dict, factory=None):
        self.options, self.factory = dict(options), factory
        self.query = self.options.get("query", "")
        self.page_size = int(self.options.get("page_size", PAGE_SIZE))
        self.docs_per_partition = int(self.options.get("docs_per_partition", DOCS_PER_PARTITION))
        self.zone = self.options.get("zone", MARK_ZONE)
        self.since, self.until = self.options.get("since"), self.options.get("until")

    def fetcher(self):
        return load_fetcher(self.options, self.factory)

    def now(self, fetcher) -> str:
        return min(self.until, fetcher.now()) if self.until else fetcher.now()

    def rows_of(self, part: Slice | None) -> Iterator[tuple]:
        """Rows of a slice (none was planned where nothing was updated); with ``since``,
        only of documents updated after that minute began."""
        begin = self.since and self.since.replace("/", "-").replace(" ", "T") + ":00.000"
        if part is not None:
            for key, updated, raw in read_slice(self.fetcher(), self.query, part.since, part.before, self.page_size):
                if not begin or updated[:23] > begin:
                    yield key, dt.datetime.strptime(updated, "%Y-%m-%dT%H:%M:%S.%f%z"), raw


class UpdatedDocumentsReader(_Options, DataSourceReader):
    """Options: ``since`` (documents updated after that minute began), ``until`` (before
    that minute; without it the last slice is open), ``from`` (from that minute on)."""

    def partitions(self):
        fetcher = self.fetcher()
        now = self.now(fetcher)
        low = self.options.get("from") or self.since or fetcher.first(self.query) or now
        slices = plan_slices(fetcher, self.query, low, now, self.docs_per_partition)
        if self.until is None:
            slices.append(Slice(max(low, now), None))
        return slices

    def read(self, partition):
        return self.rows_of(partition)


class UpdatedDocumentsStreamReader(_Options, DataSourceStreamReader):
    """The offset is the minute up to which everything was read.  A batch holds what was
    updated from the last offset on, before the current minute; a document updated while a
    batch is read belongs to a later one, so a replayed batch loses nothing either."""

    def initialOffset(self):
        return {"minute": self.since or self.fetcher().first(self.query) or self.now(self.fetcher())}

    def latestOffset(self):
        return {"minute": self.now(self.fetcher())}

    def partitions(self, start, end):
        return plan_slices(self.fetcher(), self.query, start["minute"], end["minute"], self.docs_per_partition)

    def read(self, partition):
        return self.rows_of(partition)


class UpdatedDocuments(DataSource):
    fetcher_factory = None

    @classmethod
    def name(cls):
        return "updated_documents"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return UpdatedDocumentsReader(self.options, type(self).fetcher_factory)

    def streamReader(self, schema):
        return UpdatedDocumentsStreamReader(self.options, type(self).fetcher_factory)


def register(spark: SparkSession, fetcher=None) -> None:
    """Register ``updated_documents``, bound to a fetcher factory if one is given."""
    bound = UpdatedDocuments
    if fetcher is not None:
        bound = type("UpdatedDocumentsBound", (UpdatedDocuments,), {"fetcher_factory": staticmethod(fetcher)})
    spark.dataSource.register(bound)


def updated_between(spark: SparkSession, after: dt.datetime | None = None, before: dt.datetime | None = None, zone: str = MARK_ZONE, **options) -> DataFrame:
    """The documents with after < updated < before; only their minutes are asked of the search."""
    if after is not None:
        options["from"] = local_minute(after, zone)
    if before is not None:
        options["until"] = later(local_minute(before, zone))
    df = spark.read.format("updated_documents").options(**options).load()
    if after is not None:
        df = df.where(F.col("updated") > F.lit(after))
    return df if before is None else df.where(F.col("updated") < F.lit(before))


def fetch_for_sync(spark: SparkSession, fetcher_factory, **options) -> Callable[[str | None], DataFrame]:
    """``fetch(since)`` for :func:`~tablesync.plans.jobs.sync_documents`.

    All slices up to now are read in parallel and written; then the open slice from that
    moment on is read.  A document that is updated during the first read is in the second,
    one updated during the second is found further on in it, so none is lost; where both
    hold versions of a document, the sync keeps the latest.
    """
    register(spark, fetcher_factory)

    def read(**more) -> DataFrame:
        return spark.read.format("updated_documents").options(**options, **more).load().select("raw")

    kept: list[str] = []  # the last fetch's folder: its sync is over when the next one begins

    def fetch(since: str | None) -> DataFrame:
        until = fetcher_factory(dict(options)).now()
        mark = {"since": since} if since else {}
        path = scratch_path(spark, "fetched")
        read(until=until, **mark).write.parquet(path)
        while kept:
            delete_path(spark, kept.pop())
        kept.append(path)
        settled = spark.read.schema("raw string").parquet(path)
        return settled.unionByName(read(**{"from": until}, **mark))

    return fetch
