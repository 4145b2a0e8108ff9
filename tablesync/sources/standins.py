"""Stand-ins that turn the given tables into the shapes the tools read.

No database server or tracker API is available where the tests run, so
the document operators read documents *derived by Spark* from the given
tables (``orders``, ``events``) and the relational operators read the
given Parquet tables through :class:`~tablesync.sources.relational.TableSource`.
Everything grows with the tables.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import source_text

# Fixed values of the stand-in documents: key prefixes and field ids.
ORDER_KEY_PREFIX = "ORD-"
EVENT_KEY_PREFIX = "EV-"
FIELD_TOTAL = "customfield_10001"
FIELD_CUSTOMER = "customfield_10002"
# Field metadata of the stand-in tracker: (id, display name).
FIELD_NAMES = [
    ("updated", "Mise à jour"),
    ("created", "Créé"),
    (FIELD_TOTAL, "Prix total (XPF)"),
    (FIELD_CUSTOMER, "Client n°"),
    ("summary", "Résumé"),
]


def order_envelope(subtask_types=()) -> Column:
    """One order as a tracker document: key, id, fields{...}, changelog.

    ``subtask_types=None`` leaves the sub-task flag out of the document (the
    flag then comes from the type metadata).
    """
    prio = F.col("o_orderpriority")
    when = source_text(F.col("o_orderdate"))
    if subtask_types is None:
        issuetype = F.struct(prio.alias("name"))
    else:
        issuetype = F.struct(prio.alias("name"), prio.isin(list(subtask_types)).alias("subtask"))
    fields = F.struct(
        issuetype.alias("issuetype"),
        F.struct(F.col("o_orderstatus").alias("name")).alias("status"),
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("summary"),
        when.alias("created"),
        when.alias("updated"),
        F.col("o_totalprice").alias(FIELD_TOTAL),
        F.col("o_custkey").alias(FIELD_CUSTOMER),
        F.array(F.col("o_orderstatus"), prio).alias("labels"),
    )
    changelog = F.struct(
        F.array(
            F.struct(
                when.alias("created"),
                F.array(F.struct(F.lit("status").alias("field"), F.col("o_orderstatus").alias("toString"))).alias("items"),
            )
        ).alias("histories")
    )
    return F.struct(
        F.concat(F.lit(ORDER_KEY_PREFIX), F.col("o_orderkey").cast("string")).alias("key"),
        F.col("o_orderkey").cast("string").alias("id"),
        fields.alias("fields"),
        changelog.alias("changelog"),
    )


def order_documents(orders: DataFrame, subtask_types=()) -> DataFrame:
    """``raw`` JSON text per order (built JVM-side)."""
    return orders.select(F.to_json(order_envelope(subtask_types)).alias("raw"))


def event_documents(events: DataFrame) -> DataFrame:
    """``raw`` JSON text per event, with dates nested in a struct and in a
    list, an empty object ``e`` on every third event, an all-NULL object
    ``n`` and a list holding one empty object ``l``."""
    when = source_text(F.col("ts"))
    body = F.concat(
        F.lit('{"key":"' + EVENT_KEY_PREFIX),
        F.col("event_id").cast("string"),
        F.lit('","id":"'),
        F.col("event_id").cast("string"),
        F.lit('","fields":{"issuetype":{"name":'),
        F.to_json(F.array(F.col("event_type"))).substr(F.lit(2), F.length(F.to_json(F.array(F.col("event_type")))) - 2),
        F.lit('},"updated":"'),
        when,
        F.lit('","nested":{"at":"'),
        when,
        F.lit('","kind":'),
        F.to_json(F.array(F.col("event_type"))).substr(F.lit(2), F.length(F.to_json(F.array(F.col("event_type")))) - 2),
        F.lit('},"history":["'),
        when,
        F.lit('"],"e":'),
        F.when(F.col("event_id") % 3 == 0, F.lit("{}")).otherwise(F.concat(F.lit('{"v":'), F.col("value").cast("string"), F.lit("}"))),
        F.lit(',"n":{"x":null},"l":[{}]},"changelog":{}}'),
    )
    return events.select(body.alias("raw"))


def mixed_documents(events: DataFrame) -> DataFrame:
    """``raw`` JSON text per event whose field ``mixed`` is, by turns, a text, a date, an
    object, a list, an empty object, a number and an object of tricky texts."""
    when = source_text(F.col("ts"))
    kind = F.to_json(F.array(F.col("event_type")))
    kind = F.substr(kind, F.lit(2), F.length(kind) - 2)
    text = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))
    shapes = [
        kind,
        text('"', when, '"'),
        text('{"at":"', when, '","e":{},"deep":{"kind":', kind, ',"list":[{"e":{},"at":"', when, '"},{},[]]}}'),
        text('["', when, '",{},"x",null,', kind, "]"),
        F.lit("{}"),
        F.col("event_id").cast("string"),
        F.lit('{"a\\\\":{},"k\\":{}":"\\":{},\\"","t":":{}","b":[":{}",{"c":{}}]}'),
    ]
    mixed = shapes[-1]
    for k in reversed(range(len(shapes) - 1)):
        mixed = F.when(F.col("event_id") % len(shapes) == k, shapes[k]).otherwise(mixed)
    key = F.col("event_id").cast("string")
    body = text('{"key":"' + EVENT_KEY_PREFIX, key, '","id":"', key, '","fields":{"issuetype":{"name":', kind, '},"mixed":', mixed, "}}")
    return events.select(body.alias("raw"))


class ParquetOrdersFetcher:
    """Fetcher serving a Parquet ``orders`` file as search pages.

    Each call reads only the row groups overlapping its offset range
    (Arrow inside the task); the page after the last one is empty.
    """

    def __init__(self, options: dict):
        import pyarrow.parquet as pq

        self.path = options["path"]
        self.type_list = options.get("types", "[]")
        self.file = pq.ParquetFile(self.path)
        md = self.file.metadata
        self.starts = []
        acc = 0
        for i in range(md.num_row_groups):
            self.starts.append(acc)
            acc += md.row_group(i).num_rows
        self.rows = acc
        self._cache: tuple[int, object] | None = None

    def total(self, query, since):
        return self.rows

    def plan_pages(self, pages: int, page_size: int, max_docs_per_task: int = 50_000):
        """Page ranges that never straddle a row group, at most
        ``max_docs_per_task`` documents each: a task decodes one row group
        and a group is decoded by ceil(rows / max_docs_per_task) tasks."""
        out = []
        for i, first in enumerate(self.starts):
            n = self.file.metadata.row_group(i).num_rows
            lo_page, hi_page = first // page_size, (first + n - 1) // page_size
            step = max(1, max_docs_per_task // page_size)
            for p in range(lo_page, hi_page + 1, step):
                out.append((p, min(p + step - 1, hi_page)))
        # a page straddling two groups may appear at the end of one range and
        # the start of the next: keep each page once
        seen, plan = -1, []
        for a, b in out:
            a = max(a, seen + 1)
            if a <= b:
                plan.append((a, b))
                seen = b
        return plan or [(0, pages - 1)]

    def _group(self, i):
        if self._cache is None or self._cache[0] != i:
            self._cache = (i, self.file.read_row_group(i, columns=["o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice", "o_custkey"]))
        return self._cache[1]

    def page(self, query, start_at, max_results, since):
        end = min(start_at + max_results, self.rows)
        out = []
        for i, first in enumerate(self.starts):
            n = self.file.metadata.row_group(i).num_rows
            lo, hi = max(start_at, first), min(end, first + n)
            if lo >= hi:
                continue
            tbl = self._group(i).slice(lo - first, hi - lo).to_pylist()
            for r in tbl:
                out.append(
                    {
                        "key": f"{ORDER_KEY_PREFIX}{r['o_orderkey']}",
                        "id": str(r["o_orderkey"]),
                        "fields": {
                            "issuetype": {"name": r["o_orderpriority"], "subtask": False},
                            "status": {"name": r["o_orderstatus"]},
                            FIELD_TOTAL: r["o_totalprice"],
                            FIELD_CUSTOMER: r["o_custkey"],
                        },
                        "changelog": {"histories": []},
                    }
                )
        return out

    def fields(self):
        return list(FIELD_NAMES)

    def types(self):
        """The project's types: a JSON list of (name, sub-task flag) in the option ``types``."""
        return [tuple(t) for t in json.loads(self.type_list)]


def parquet_orders_fetcher(options: dict) -> ParquetOrdersFetcher:
    return ParquetOrdersFetcher(options)


def dumps(doc: dict) -> str:
    return json.dumps(doc, ensure_ascii=False)
