"""Registered queries: one per operator of the inventory, each reading the
given tables (or data Spark derives from them), with its DuckDB oracle.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE_SQL[name]``.
Keys without an oracle entry are compared on rows only.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import times
from ..functions.names import clean_identifier, type_table_name_col
from ..functions.sizing import partitions_col
from ..functions.text import value_text
from ..operators import coerce, documents, routing, upsert, watermark
from ..operators.partitioning import size_partitions
from ..session import scratch_path
from ..sources import catalog as cat
from ..sources import documents as paged
from ..sources import standins
from ..sources.relational import (
    TableSource,
    depth_predicates,
    key_bounds,
    range_predicates,
    read_table,
    table_size_bytes,
    tag_scan_partition,
)
from .jobs import copy_schema, copy_table
from .sinks import Sink, read_written, write_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

# Fixed parameters of the registered queries.
EXCLUDED_TABLE = "nation"
ONLY_TABLES = ["nation", "orders", "region"]
CHANGED_SINCE = "1997-01-01"
SYNCED_BEFORE = "2000-01-01"
MOVED_TO_TYPE = "5-LOW"
SCAN_PARTITIONS = 8  # JDBC scan tasks of the check (a cluster picks its own)
BIG_QUANTITY = 45

# The tables of the test folder (the folder catalogue lists them).
GIVEN_TABLES = [
    "benchmark", "conversations", "customer", "documents", "embeddings", "events", "labels",
    "lineitem", "nation", "orders", "pages", "part", "region", "supplier",
]


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE_SQL[name] = oracle
        return fn

    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _clean_sql(expr: str) -> str:
    """DuckDB form of the identifier cleaning for ASCII input."""
    c = f"regexp_replace({expr}, '[^a-zA-Z0-9_]', '_', 'g')"
    return f"left(CASE WHEN regexp_matches({c}, '^[A-Za-z_]') THEN {c} ELSE '_' || {c} END, 128)"


def _utc_text_sql(ts: str) -> str:
    return f"strftime(date_trunc('millisecond', {ts}), '%Y-%m-%d %H:%M:%S.%f')"


# --------------------------------------------------------------------------
# catalogue
# --------------------------------------------------------------------------

def _counts_sql(names) -> str:
    return " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in names)


def _catalog(spark, sf_dir, exclude=None, only=None):
    folder = cat.folder_catalog(spark, sf_dir)
    return cat.filter_catalog(folder, os.path.basename(os.path.normpath(sf_dir)), exclude, only)


def _catalog_counts(spark, sf_dir, exclude=None, only=None):
    """The catalogue's tables and their rows (only the listed tables are read)."""
    names = [r[0] for r in _catalog(spark, sf_dir, exclude, only).collect()]
    return upsert.union_all(
        [table(spark, sf_dir, t).agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("table_name"), "n") for t in names]
    )


@register("catalog_list", _counts_sql(GIVEN_TABLES))
def catalog_list(spark, sf_dir):
    return _catalog_counts(spark, sf_dir)


@register("catalog_exclude", _counts_sql([t for t in GIVEN_TABLES if t != EXCLUDED_TABLE]))
def catalog_exclude(spark, sf_dir):
    return _catalog_counts(spark, sf_dir, exclude=[EXCLUDED_TABLE])


@register("catalog_only", _counts_sql(ONLY_TABLES))
def catalog_only(spark, sf_dir):
    return _catalog_counts(spark, sf_dir, only=ONLY_TABLES)


@register("catalog_only_wins", _counts_sql([EXCLUDED_TABLE]))
def catalog_only_wins(spark, sf_dir):
    return _catalog_counts(spark, sf_dir, exclude=[EXCLUDED_TABLE], only=[EXCLUDED_TABLE])


@register("catalog_count", f"SELECT count(*) AS tables, sum(n)::BIGINT AS n FROM ({_counts_sql(GIVEN_TABLES)})")
def catalog_count(spark, sf_dir):
    return _catalog_counts(spark, sf_dir).agg(F.count(F.lit(1)).alias("tables"), F.sum("n").alias("n"))


# --------------------------------------------------------------------------
# relational scans and type rules
# --------------------------------------------------------------------------

def _source(sf_dir) -> TableSource:
    return TableSource(format="parquet", root=sf_dir)


@register("jdbc_scan", "SELECT * FROM orders")
def jdbc_scan(spark, sf_dir):
    return read_table(spark, _source(sf_dir), "orders")


@register(
    "jdbc_scan_partitioned",
    f"""WITH b AS (SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders),
 w AS (SELECT lo, hi, CAST({SCAN_PARTITIONS} AS BIGINT) AS k FROM b),
 s AS (SELECT lo, greatest(1, CAST(ceil((hi - lo + 1) / k::DOUBLE) AS BIGINT)) AS width, hi, k FROM w),
 p AS (SELECT lo, width, greatest(1, least(k, CAST(ceil((hi - lo + 1) / width::DOUBLE) AS BIGINT))) AS parts FROM s)
SELECT o.*, CAST(CASE WHEN o_orderkey IS NULL THEN 0
  ELSE least(parts - 1, greatest(0, (o_orderkey - lo) // width)) END AS INTEGER) AS scan_part
FROM orders o, p""",
)
def jdbc_scan_partitioned(spark, sf_dir):
    src = _source(sf_dir)
    df = read_table(spark, src, "orders")
    lo, hi, _rows = key_bounds(df.select("o_orderkey"), "o_orderkey")
    preds = range_predicates("o_orderkey", int(lo), int(hi), SCAN_PARTITIONS)
    return tag_scan_partition(df, preds)


@register(
    "equal_depth_scan",
    f"SELECT {SCAN_PARTITIONS} AS ranges, count(*) AS n, count(*) AS in_one_range, true AS balanced FROM lineitem",
)
def equal_depth_scan(spark, sf_dir):
    """The predicates of a scan split at a skewed key's quantiles: every row is in exactly
    one range, and the deepest range has at most twice the rows of the shallowest."""
    src = _source(sf_dir)
    # prices crowd at the low end: the square of a price has its median near a quarter of its range
    li = read_table(spark, src, "lineitem").withColumn("skewed", (F.col("l_extendedprice") * F.col("l_extendedprice")).cast("long"))
    shares = [i / SCAN_PARTITIONS for i in range(1, SCAN_PARTITIONS)]
    points = li.agg(F.percentile_approx("skewed", shares, 100 * SCAN_PARTITIONS)).first()[0]
    preds = depth_predicates("skewed", points)
    hits = F.lit(0)
    for p in preds:
        hits = hits + F.coalesce(F.expr(p), F.lit(False)).cast("int")
    per_range = tag_scan_partition(li.withColumn("hits", hits), preds).groupBy("scan_part").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("hits") == 1, 1)).alias("one")
    )
    return per_range.agg(
        F.count(F.lit(1)).cast("int").alias("ranges"),
        F.sum("n").alias("n"),
        F.sum("one").alias("in_one_range"),
        (F.max("n") <= 2 * F.min("n")).alias("balanced"),
    )


@register(
    "string_cleanup",
    "SELECT p_partkey, nullif(trim(p_name), '') AS p_name, nullif(trim(p_brand), '') AS p_brand, "
    "nullif(trim(p_type), '') AS p_type, p_size, p_retailprice FROM part",
)
def string_cleanup(spark, sf_dir):
    return coerce.clean_strings(table(spark, sf_dir, "part"))


@register(
    "decimal_to_float",
    "SELECT l_orderkey, l_linenumber, "
    "CAST(CAST(CAST(l_quantity AS DECIMAL(12,2)) AS FLOAT) AS DOUBLE) AS l_quantity, "
    "CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS FLOAT) AS DOUBLE) AS l_extendedprice, "
    "CAST(CAST(CAST(l_discount AS DECIMAL(4,2)) AS FLOAT) AS DOUBLE) AS l_discount, "
    "l_tax, l_returnflag FROM lineitem",
)
def decimal_to_float(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_quantity").cast(T.DecimalType(12, 2)).alias("l_quantity"),
        F.col("l_extendedprice").cast(T.DecimalType(18, 2)).alias("l_extendedprice"),
        F.col("l_discount").cast(T.DecimalType(4, 2)).alias("l_discount"),
        "l_tax",
        "l_returnflag",
    )
    out = coerce.decimals_to(li, "float")
    return out.select(*[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.FloatType) else F.col(f.name) for f in out.schema.fields])


def _wide_part(spark, sf_dir) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.withColumn("p_blob", F.encode(F.col("p_name"), "UTF-8")).withColumn(
        "p_tags", F.array(F.col("p_size"))
    ).withColumn("p_attrs", F.create_map(F.col("p_brand"), F.col("p_size")))


@register("drop_types", "SELECT * FROM part")
def drop_types(spark, sf_dir):
    return coerce.drop_types(_wide_part(spark, sf_dir))


# --------------------------------------------------------------------------
# documents
# --------------------------------------------------------------------------

def _order_docs(spark, sf_dir, subtask_types=()) -> DataFrame:
    return documents.parse(standins.order_documents(table(spark, sf_dir, "orders"), subtask_types))


def _flat_orders(spark, sf_dir, field_map=None, exclude_fields=(), protected=(documents.KEY_COLUMN,)):
    docs, ft, ct = documents.staged(standins.order_documents(table(spark, sf_dir, "orders")))
    return documents.flatten(docs, ft, ct, field_map, exclude_fields, protected=protected)


def _field_map(spark, sf_dir) -> dict[str, str]:
    paged.register(spark, standins.parquet_orders_fetcher)
    fields = (
        spark.read.format("paged_documents")
        .option("resource", "fields")
        .option("path", os.path.join(sf_dir, "orders.parquet"))
        .load()
    )
    return documents.field_map_of(fields)


@register(
    "flatten_envelope",
    "SELECT 'ORD-' || o_orderkey AS jira, CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS status_name, "
    "o_orderpriority AS type_name, 'order ' || o_orderkey AS summary, o_totalprice AS customfield_10001, "
    f"o_custkey AS customfield_10002, {_utc_text_sql('o_orderdate')} AS created, "
    "o_orderstatus || '|' || o_orderpriority AS labels FROM orders",
)
def flatten_envelope(spark, sf_dir):
    flat = _flat_orders(spark, sf_dir)
    return flat.select(
        "jira",
        "id",
        F.col("status.name").alias("status_name"),
        F.col("issuetype.name").alias("type_name"),
        "summary",
        "customfield_10001",
        "customfield_10002",
        "created",
        F.array_join("labels", "|").alias("labels"),
    )


@register(
    "rename_by_map",
    f"SELECT 'ORD-' || o_orderkey AS jira, {_utc_text_sql('o_orderdate')} AS Mise_a_jour, "
    f"{_utc_text_sql('o_orderdate')} AS Cree, o_totalprice AS Prix_total__XPF_, o_custkey AS Client_n_, "
    "'order ' || o_orderkey AS Resume FROM orders",
)
def rename_by_map(spark, sf_dir):
    flat = _flat_orders(spark, sf_dir, field_map=_field_map(spark, sf_dir))
    return flat.select("jira", "Mise_a_jour", "Cree", "Prix_total__XPF_", "Client_n_", "Resume")


@register(
    "exclude_fields",
    f"SELECT 'ORD-' || o_orderkey AS jira, {_utc_text_sql('o_orderdate')} AS Mise_a_jour, "
    "o_totalprice AS Prix_total__XPF_, o_custkey AS Client_n_ FROM orders",
)
def exclude_fields(spark, sf_dir):
    # names are matched after renaming; the key column is protected
    return _flat_orders(
        spark,
        sf_dir,
        field_map=_field_map(spark, sf_dir),
        exclude_fields=["jira", "id", "issuetype", "status", "labels", "changelog", "Cree", "Resume"],
    )


@register(
    "clean_names",
    "SELECT o_orderkey AS _1re_cle, o_orderdate AS Mise_a_jour, o_totalprice AS Cout__k__, "
    "o_orderstatus AS Sous_tache, o_orderpriority AS _uvre FROM orders",
)
def clean_names(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("1re clé"),
        F.col("o_orderdate").alias("Mise à jour"),
        F.col("o_totalprice").alias("Coût (k€)"),
        F.col("o_orderstatus").alias("Sous-tâche"),
        F.col("o_orderpriority").alias("œuvre"),
    )
    return documents.clean_columns(o)


@register(
    "clean_text",
    "SELECT doc_id, " + _clean_sql("strip_accents(text)") + " AS c FROM documents",
)
def clean_text(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", clean_identifier(F.col("text")).alias("c"))


@register(
    "array_to_text",
    "SELECT o_orderkey, o_orderkey || ', ' || o_custkey AS c, o_orderstatus || ', None' AS c2, "
    "CASE WHEN o_orderstatus = 'F' THEN 'True' ELSE 'False' END AS c3, "
    "CAST(o_totalprice AS VARCHAR) || ', None' AS c4 FROM orders",
)
def array_to_text(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    a = F.array(F.col("o_orderkey"), F.col("o_custkey"))
    nested = F.array(F.array(F.col("o_orderstatus")), F.array(F.lit(None).cast("string")))
    flag = F.array(F.col("o_orderstatus") == F.lit("F"))
    return o.select(
        "o_orderkey",
        value_text(a, T.ArrayType(T.LongType())).alias("c"),
        value_text(nested, T.ArrayType(T.ArrayType(T.StringType()))).alias("c2"),
        value_text(flag, T.ArrayType(T.BooleanType())).alias("c3"),
        value_text(F.array(F.col("o_totalprice"), F.lit(None).cast("double")), T.ArrayType(T.DoubleType())).alias("c4"),
    )


@register("to_utc", f"SELECT event_id, {_utc_text_sql('ts')} AS c FROM events")
def to_utc(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select("event_id", times.to_utc_text(times.source_text(F.col("ts"))).alias("c"))


def _event_docs_flat(spark, sf_dir) -> DataFrame:
    return documents.flatten(*documents.staged(standins.event_documents(table(spark, sf_dir, "events"))))


@register(
    "deep_to_utc",
    f"SELECT event_id, u AS upd, u AS nested_at, event_type AS kind, u AS hist FROM "
    f"(SELECT *, {_utc_text_sql('ts')} AS u FROM events)",
)
def deep_to_utc(spark, sf_dir):
    flat = _event_docs_flat(spark, sf_dir)
    return flat.select(
        F.col("id").cast("bigint").alias("event_id"),
        F.col("updated").alias("upd"),
        F.col("nested.at").alias("nested_at"),
        F.col("nested.kind").alias("kind"),
        F.array_join("history", "|").alias("hist"),
    )


@register(
    "empty_struct_to_null",
    "SELECT event_id, (event_id % 3 = 0) AS e_null, false AS n_null, CAST(1 AS INTEGER) AS l_size, "
    "true AS changelog_null, CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS e_v FROM events",
)
def empty_struct_to_null(spark, sf_dir):
    flat = _event_docs_flat(spark, sf_dir)
    return flat.select(
        F.col("id").cast("bigint").alias("event_id"),
        F.col("e").isNull().alias("e_null"),
        F.col("n").isNull().alias("n_null"),
        F.size("l").alias("l_size"),
        F.col("changelog").isNull().alias("changelog_null"),
        F.col("e.v").alias("e_v"),
    )


@register(
    "mixed_shapes",
    "SELECT event_id, CASE event_id % 7 WHEN 0 THEN event_type WHEN 1 THEN u WHEN 4 THEN NULL WHEN 5 THEN event_id::VARCHAR "
    "WHEN 2 THEN '{\"at\":\"' || u || '\",\"deep\":{\"kind\":\"' || event_type || '\",\"list\":[{\"at\":\"' || u || '\",\"e\":null},{},[]]},\"e\":null}' "
    "WHEN 3 THEN '[\"' || u || '\",{},\"x\",null,\"' || event_type || '\"]' "
    "ELSE '{\"a\\\\\":null,\"b\":[\":{}\",{\"c\":null}],\"k\\\":{}\":\"\\\":{},\\\"\",\"t\":\":{}\"}' END AS mixed "
    f"FROM (SELECT *, {_utc_text_sql('ts')} AS u FROM events)",
)
def mixed_shapes(spark, sf_dir):
    """A field whose shape differs by document: dates are converted and empty
    objects nulled inside its objects and lists, too."""
    flat = documents.flatten(*documents.staged(standins.mixed_documents(table(spark, sf_dir, "events"))))
    return flat.select(F.col("id").cast("bigint").alias("event_id"), "mixed")


# --------------------------------------------------------------------------
# high-water mark
# --------------------------------------------------------------------------

@register(
    "watermark_max",
    "SELECT max(m) AS last_update FROM (SELECT o_orderdate AS m FROM orders UNION ALL SELECT l_shipdate FROM lineitem)",
)
def watermark_max(spark, sf_dir):
    targets = [
        table(spark, sf_dir, "orders").select(F.col("o_orderdate").alias(watermark.UPDATED_COLUMN)),
        table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").alias(watermark.UPDATED_COLUMN)),
    ]
    return watermark.high_water_mark(targets)


@register("watermark_format", "SELECT event_id, strftime(ts + INTERVAL 11 HOUR, '%Y/%m/%d %H:%M') AS c FROM events")
def watermark_format(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select("event_id", times.format_mark(F.col("ts")).alias("c"))


@register("watermark_parse", "SELECT event_id, date_trunc('millisecond', ts) AS t FROM events")
def watermark_parse(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select("event_id", times.parse_mark(times.source_text(F.col("ts"))).alias("t"))


@register(
    "incremental_filter",
    "SELECT * FROM orders WHERE o_orderdate > date_trunc('minute', "
    f"(SELECT max(o_orderdate) FROM orders WHERE o_orderdate < TIMESTAMP '{SYNCED_BEFORE}'))",
)
def incremental_filter(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    synced = o.where(F.col("o_orderdate") < F.lit(SYNCED_BEFORE).cast(T.TimestampNTZType())).select(
        F.col("o_orderdate").alias(watermark.UPDATED_COLUMN)
    )
    mark = watermark.mark_text(watermark.high_water_mark([synced]))
    # the mark is one scalar (as in the API's query text): read it once and
    # filter with a literal, which reaches the Parquet scan as a pushed filter
    since = mark.select(times.mark_text_to_utc(F.col("mark_text")).alias("since")).first()["since"]
    return watermark.since(o, F.lit(since).cast(T.TimestampNTZType()), "o_orderdate")


@register("paged_scan", "SELECT o_orderkey FROM orders")
def paged_scan(spark, sf_dir):
    paged.register(spark, standins.parquet_orders_fetcher)
    raw = (
        spark.read.format("paged_documents")
        .option("path", os.path.join(sf_dir, "orders.parquet"))
        .option("page_size", str(paged.PAGE_SIZE))
        .load()
    )
    docs = documents.parse(raw)
    key = F.try_variant_get(F.col("doc"), "$.key", "string")
    return docs.select(F.regexp_extract(key, r"(\d+)$", 1).cast("bigint").alias("o_orderkey"))


# --------------------------------------------------------------------------
# delete / upsert / refresh
# --------------------------------------------------------------------------

def _big_quantity_keys(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.where(F.col("l_quantity") > BIG_QUANTITY).select(F.col("l_orderkey").alias("o_orderkey"))


@register(
    "delete_by_keys",
    f"SELECT o.* FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_quantity > {BIG_QUANTITY})",
)
def delete_by_keys(spark, sf_dir):
    return upsert.delete_by_keys(table(spark, sf_dir, "orders"), _big_quantity_keys(spark, sf_dir), "o_orderkey")


@register(
    "deleted_count",
    f"SELECT count(*) AS n FROM orders o WHERE EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_quantity > {BIG_QUANTITY})",
)
def deleted_count(spark, sf_dir):
    return upsert.deleted_count(table(spark, sf_dir, "orders"), _big_quantity_keys(spark, sf_dir), "o_orderkey")


UPSERT_SQL = (
    f"WITH ch AS (SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '{CHANGED_SINCE}') "
    "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM ch) "
    "UNION ALL SELECT o_orderkey, 'X' AS o_orderstatus, o_totalprice FROM ch"
)


@register("upsert", UPSERT_SQL)
def upsert_query(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    target = o.select("o_orderkey", "o_orderstatus", "o_totalprice")
    changed = o.where(F.col("o_orderdate") > F.lit(CHANGED_SINCE).cast(T.TimestampNTZType())).select(
        "o_orderkey", F.lit("X").alias("o_orderstatus"), "o_totalprice"
    )
    return upsert.upsert(target, changed, "o_orderkey")


@register(
    "upsert_type_move",
    "SELECT " + _clean_sql(f"CASE WHEN o_orderdate > TIMESTAMP '{CHANGED_SINCE}' THEN '{MOVED_TO_TYPE}' ELSE o_orderpriority END") + " AS t, o_orderkey FROM orders",
)
def upsert_type_move(spark, sf_dir):
    """Changed documents leave whatever table they were in and enter their new type's: one pass."""
    o = table(spark, sf_dir, "orders")
    target = o.select(F.col("o_orderpriority").alias("_type"), "o_orderkey")
    changed = o.where(F.col("o_orderdate") > F.lit(CHANGED_SINCE).cast(T.TimestampNTZType())).select(
        F.lit(MOVED_TO_TYPE).alias("_type"), "o_orderkey"
    )
    moved = upsert.upsert(target, changed, "o_orderkey")
    # names are cleaned once per type, not once per row
    types = target.select("_type").distinct().union(spark.createDataFrame([(MOVED_TO_TYPE,)], "_type string")).distinct()
    return moved.join(types.withColumn("t", type_table_name_col(F.col("_type"))), "_type").select("t", "o_orderkey")


@register(
    "full_refresh",
    f"SELECT o_orderpriority, o_orderkey, CASE WHEN o_orderpriority = '{MOVED_TO_TYPE}' THEN 'old' ELSE 'new' END AS src FROM orders",
)
def full_refresh(spark, sf_dir):
    """The types of the batch replace their tables; the table of an absent type stays: one pass."""
    o = table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderkey")
    old = o.withColumn("src", F.lit("old"))
    batch = o.where(F.col("o_orderpriority") != MOVED_TO_TYPE).withColumn("src", F.lit("new"))
    return upsert.refresh(old, batch, "o_orderpriority")


# --------------------------------------------------------------------------
# routing
# --------------------------------------------------------------------------

@register(
    "route_counts",
    "SELECT " + _clean_sql("o_orderpriority") + " AS t, count(*) AS n FROM orders GROUP BY 1",
)
def route_counts(spark, sf_dir):
    return routing.route_counts(_order_docs(spark, sf_dir))


@register(
    "exclude_types",
    "SELECT " + _clean_sql("o_orderpriority") + f" AS t, count(*) AS n FROM orders WHERE o_orderpriority NOT IN ('{MOVED_TO_TYPE}') GROUP BY 1",
)
def exclude_types(spark, sf_dir):
    return routing.route_counts(_order_docs(spark, sf_dir), exclude_types=[MOVED_TO_TYPE])


@register(
    "route_names",
    "SELECT DISTINCT " + _clean_sql("o_orderpriority") + f" || CASE WHEN o_orderpriority = '{MOVED_TO_TYPE}' THEN '_subtask' ELSE '' END AS t FROM orders",
)
def route_names(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    docs = documents.parse(standins.order_documents(o, subtask_types=None))  # flag not in the documents
    types = o.select(F.col("o_orderpriority").alias("name")).distinct().withColumn("subtask", F.col("name") == MOVED_TO_TYPE)
    return routing.route_names(docs, types=types)


@register(
    "type_metadata",
    "SELECT " + _clean_sql("o_orderpriority") + f" || CASE WHEN o_orderpriority = '{MOVED_TO_TYPE}' THEN '_subtask' ELSE '' END AS t, "
    "count(*) AS n FROM orders GROUP BY 1",
)
def type_metadata(spark, sf_dir):
    """Type metadata read through the paged source decides the flag of documents that carry none."""
    paged.register(spark, standins.parquet_orders_fetcher)
    names = sorted(r[0] for r in table(spark, sf_dir, "orders").select("o_orderpriority").distinct().collect())
    types_ = json.dumps([(name, name == MOVED_TO_TYPE) for name in names])  # a project's types: metadata
    options = {"resource": "types", "path": os.path.join(sf_dir, "orders.parquet"), "types": types_}
    types = spark.read.format("paged_documents").options(**options).load()
    docs = documents.parse(standins.order_documents(table(spark, sf_dir, "orders"), subtask_types=None))
    return routing.route_counts(docs, types=types)


# --------------------------------------------------------------------------
# sizing
# --------------------------------------------------------------------------

@register(
    "partition_count",
    "SELECT o_orderstatus, greatest(1, CAST((sum(100 * o_orderkey) + 9437183) // 9437184 AS BIGINT)) AS n FROM orders GROUP BY 1",
)
def partition_count(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    sizes = o.groupBy("o_orderstatus").agg(F.sum(F.col("o_orderkey") * 100).alias("size_bytes"))
    return sizes.select("o_orderstatus", partitions_col("size_bytes").alias("n"))


@register("repartition_rows", "SELECT * FROM lineitem")
def repartition_rows(spark, sf_dir):
    src = _source(sf_dir)
    df = read_table(spark, src, "lineitem")
    return size_partitions(df, table_size_bytes(spark, src, "lineitem"))


# --------------------------------------------------------------------------
# sinks and copies (write under the checkpoint root, read back)
# --------------------------------------------------------------------------

@register("sink_overwrite", "SELECT * FROM lineitem")
def sink_overwrite(spark, sf_dir):
    sink = Sink(format="parquet", root=scratch_path(spark, "sink"))
    lineitem = table(spark, sf_dir, "lineitem")
    write_table(lineitem, sink, "lineitem", mode="overwrite")
    write_table(lineitem, sink, "lineitem", mode="overwrite")  # second run replaces, no duplicates
    return read_written(spark, sink, "lineitem")


@register(
    "sink_append_evolve",
    "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority, NULL::VARCHAR AS segment FROM orders "
    "UNION ALL SELECT NULL, c_custkey, c_acctbal, NULL, c_mktsegment FROM customer",
)
def sink_append_evolve(spark, sf_dir):
    # the appended rows bring a new column and leave others out
    sink = Sink(format="parquet", root=scratch_path(spark, "sink"))
    kept = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"]
    write_table(table(spark, sf_dir, "orders").select(*kept), sink, "t", mode="overwrite")
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_acctbal").alias("o_totalprice"), F.col("c_mktsegment").alias("segment")
    )
    write_table(customers, sink, "t", mode="append", evolve=True)
    return read_written(spark, sink, "t").select(*kept, "segment")


@register("copy_table", "SELECT * FROM orders")
def copy_table_query(spark, sf_dir):
    sink = Sink(format="parquet", root=scratch_path(spark, "copy"))
    copy_table(spark, _source(sf_dir), "orders", sink)
    return read_written(spark, sink, "orders")


COPY_COUNTS_SQL = _counts_sql(GIVEN_TABLES)


@register("copy_schema", COPY_COUNTS_SQL)
def copy_schema_query(spark, sf_dir):
    sink = Sink(format="parquet", root=scratch_path(spark, "copy"))
    res = copy_schema(spark, _source(sf_dir), _catalog(spark, sf_dir), sink)
    return res.select("table_name", F.col("rows").alias("n"))


@register("row_counts", COPY_COUNTS_SQL)
def row_counts(spark, sf_dir):
    sink = Sink(format="parquet", root=scratch_path(spark, "copy"))
    res = copy_schema(spark, _source(sf_dir), list(GIVEN_TABLES), sink, parallelism=3)
    return res.where(F.col("status") == "ok").select("table_name", F.col("rows").alias("n"))


@register(
    "copy_schema_drop_types",
    "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice, "
    "CAST(CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS FLOAT) AS DOUBLE) AS p_price_dec FROM part",
)
def copy_schema_drop_types(spark, sf_dir):
    wide_root = scratch_path(spark, "wide")
    wide = _wide_part(spark, sf_dir).withColumn("p_price_dec", F.col("p_retailprice").cast(T.DecimalType(12, 2)))
    wide.write.parquet(os.path.join(wide_root, "part_wide.parquet"))
    sink = Sink(format="parquet", root=scratch_path(spark, "copy"))
    src = TableSource(format="parquet", root=wide_root)
    res = copy_schema(spark, src, ["part_wide"], sink, drop_unsupported=True)
    if res.where(F.col("status") != "ok").limit(1).count():
        raise RuntimeError(res.collect())
    out = read_written(spark, sink, "part_wide")
    return out.withColumn("p_price_dec", F.col("p_price_dec").cast("double"))


# --------------------------------------------------------------------------
# the whole document job: full refresh, then an incremental batch
# --------------------------------------------------------------------------

def _changed_order_docs(o: DataFrame) -> DataFrame:
    """Orders changed after CHANGED_SINCE: status X, moved to MOVED_TO_TYPE."""
    changed = o.where(F.col("o_orderdate") > F.lit(CHANGED_SINCE).cast(T.TimestampNTZType())).select(
        "o_orderkey", "o_custkey", F.lit("X").alias("o_orderstatus"), "o_totalprice", "o_orderdate",
        F.lit(MOVED_TO_TYPE).alias("o_orderpriority"),
    )
    return standins.order_documents(changed)


@register(
    "document_sync",
    "SELECT "
    + _clean_sql(f"CASE WHEN o_orderdate > TIMESTAMP '{CHANGED_SINCE}' THEN '{MOVED_TO_TYPE}' ELSE o_orderpriority END")
    + " AS t, 'ORD-' || o_orderkey AS jira, "
    f"CASE WHEN o_orderdate > TIMESTAMP '{CHANGED_SINCE}' THEN 'X' ELSE o_orderstatus END AS status, "
    f"{_utc_text_sql('o_orderdate')} AS Mise_a_jour, o_totalprice AS Prix_total__XPF_ FROM orders",
)
def document_sync(spark, sf_dir):
    """Full refresh of all orders as documents, then an incremental batch in
    which later orders change status and move to another type; returns the
    committed state of every type table."""
    from .jobs import sync_documents
    from .sinks import TableFamily

    o = table(spark, sf_dir, "orders")
    family = TableFamily(spark, scratch_path(spark, "family"))
    field_map = _field_map(spark, sf_dir)
    batches = iter([standins.order_documents(o), _changed_order_docs(o)])
    fetch = lambda _since: next(batches)  # noqa: E731 - the stand-in API ignores the filter text
    sync_documents(spark, fetch, family, field_map=field_map)
    sync_documents(spark, fetch, family, field_map=field_map)
    return upsert.union_all(
        [
            df.select(F.lit(t).alias("t"), "jira", F.col("status.name").alias("status"), "Mise_a_jour", "Prix_total__XPF_")
            for t, df in sorted(family.read_all().items())
        ]
    )


def _hard_documents(orders: DataFrame) -> DataFrame:
    """Orders as hard documents: types and keys that differ by case, no type,
    an empty type, text that does not parse, a repeated key, and a type listed
    both as task and as sub-task without a flag in the document."""
    k = F.col("o_orderkey")
    typ = (
        F.when(k % 7 == 0, F.lower("o_orderpriority"))
        .when(k % 11 == 0, F.lit(""))
        .when(k % 13 != 0, F.col("o_orderpriority"))
    )
    issue = F.when(typ.isNotNull(), F.struct(typ.alias("name"), F.when(typ != MOVED_TO_TYPE, F.lit(False)).alias("subtask")))
    lower = F.when(k % 2 == 0, F.col("o_custkey"))
    upper = F.when(k % 2 == 1, F.col("o_custkey"))
    body = lambda updated, mark: F.to_json(
        F.struct(
            F.concat(F.lit("ORD-"), k.cast("string")).alias("key"),
            F.struct(
                issue.alias("issuetype"),
                F.lit(updated).alias("updated"),
                F.lit(mark).alias("mark"),
                F.struct(F.coalesce(lower, upper).alias("v")).alias("inner"),
            ).alias("fields"),
        )
    )
    # half of the documents spell a key differently
    spelled = lambda text: F.when(k % 2 == 0, text).otherwise(F.replace(text, F.lit('"v":'), F.lit('"V":')))
    first = F.when(k % 17 == 0, F.lit("{not json")).otherwise(spelled(body("2024-01-01T10:00:00.000+1100", "old")))
    newer = orders.where((k % 5 == 0) & (k % 17 != 0)).select(spelled(body("2024-01-02T10:00:00.000+1100", "new")).alias("raw"))
    return orders.select(first.alias("raw")).unionByName(newer)


@register(
    "sync_hard_documents",
    "WITH d AS (SELECT *, CASE WHEN o_orderkey % 7 = 0 THEN lower(o_orderpriority) WHEN o_orderkey % 11 = 0 THEN '' "
    "WHEN o_orderkey % 13 <> 0 THEN o_orderpriority END AS typ FROM orders) "
    "SELECT CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE 'ORD-' || o_orderkey END AS jira, "
    "CASE WHEN o_orderkey % 17 = 0 THEN 'not a JSON document' WHEN coalesce(typ, '') = '' THEN 'no type' "
    f"WHEN typ = '{MOVED_TO_TYPE}' THEN 'task or sub-task' ELSE lower({_clean_sql('typ')}) END AS place, "
    f"CASE WHEN o_orderkey % 17 = 0 OR coalesce(typ, '') IN ('', '{MOVED_TO_TYPE}') THEN NULL "
    "WHEN o_orderkey % 5 = 0 THEN 'new' ELSE 'old' END AS mark, "
    f"CASE WHEN o_orderkey % 17 = 0 OR coalesce(typ, '') IN ('', '{MOVED_TO_TYPE}') THEN NULL ELSE o_custkey END AS v FROM d",
)
def sync_hard_documents(spark, sf_dir):
    """Every order once: in the table of its type, or among the rejects."""
    from .jobs import sync_documents
    from .sinks import TableFamily

    o = table(spark, sf_dir, "orders")
    family = TableFamily(spark, scratch_path(spark, "family"))
    names = o.select(F.col("o_orderpriority").alias("name")).distinct()
    both = names.where(F.col("name") == MOVED_TO_TYPE)
    types = names.withColumn("subtask", F.lit(False)).unionByName(both.withColumn("subtask", F.lit(True)))
    sync_documents(spark, lambda _since: _hard_documents(o), family, types=types)
    written = [
        df.select("jira", F.lit(t.lower()).alias("place"), "mark", F.col(f"inner.{_field(df, 'inner', 'v')}").alias("v"))
        for t, df in sorted(family.read_all().items())
    ]
    none = F.lit(None)
    rejects = spark.read.parquet(family.rejects).select(
        "jira", F.col("reason").alias("place"), none.cast("string").alias("mark"), none.cast("bigint").alias("v")
    )
    return upsert.union_all([*written, rejects])


def _field(df: DataFrame, struct: str, name: str) -> str:
    return next(f.name for f in df.schema[struct].dataType.fields if f.name.lower() == name)


@register(
    "fetched_documents",
    "SELECT " + _clean_sql("o_orderpriority") + " AS t, count(*) AS rows, (SELECT count(*) FROM orders) AS fetched FROM orders GROUP BY 1",
)
def fetched_documents(spark, sf_dir):
    """The job's running counts: documents read, and rows written per table."""
    from .jobs import sync_documents
    from .sinks import TableFamily

    family = TableFamily(spark, scratch_path(spark, "family"))
    result = sync_documents(spark, lambda _since: standins.order_documents(table(spark, sf_dir, "orders")), family)
    return result.select(F.col("table_name").alias("t"), "rows", "fetched")


LANDED_DOCUMENTS = 250_000  # documents in a landed file, at most


@register("stream_sync", ORACLE_SQL["document_sync"])
def stream_sync(spark, sf_dir):
    """The same two batches landed as JSON-lines files by Spark and applied
    by the streaming form (foreachBatch, available-now trigger)."""
    from ..streaming.incremental import start_sync
    from .sinks import TableFamily

    o = table(spark, sf_dir, "orders")
    landing = scratch_path(spark, "landing")
    family = TableFamily(spark, scratch_path(spark, "family"))
    checkpoint = scratch_path(spark, "stream-checkpoint")
    field_map = _field_map(spark, sf_dir)
    for batch in (standins.order_documents(o), _changed_order_docs(o)):
        # a compressed file is read by one task, so a file holds a bounded number of documents
        batch.write.mode("append").option("compression", "gzip").option("maxRecordsPerFile", LANDED_DOCUMENTS).text(landing)
        query = start_sync(spark, landing, family, checkpoint=checkpoint, field_map=field_map)
        query.awaitTermination()
        if query.exception() is not None:
            raise RuntimeError(str(query.exception()))
    return upsert.union_all(
        [
            df.select(F.lit(t).alias("t"), "jira", F.col("status.name").alias("status"), "Mise_a_jour", "Prix_total__XPF_")
            for t, df in sorted(family.read_all().items())
        ]
    )


@register(
    "dedupe_latest",
    f"SELECT 'ORD-' || o_orderkey AS jira, CASE WHEN o_orderdate > TIMESTAMP '{CHANGED_SINCE}' THEN 'X' ELSE o_orderstatus END AS status, "
    f"CASE WHEN o_orderdate > TIMESTAMP '{CHANGED_SINCE}' THEN {_utc_text_sql('o_orderdate + INTERVAL 1 DAY')} "
    f"ELSE {_utc_text_sql('o_orderdate')} END AS updated FROM orders",
)
def dedupe_latest(spark, sf_dir):
    """A batch holding every order and, for the later ones, a newer version
    (status X, updated a day later): one document per key, the newest."""
    from .jobs import latest_per_key

    o = table(spark, sf_dir, "orders")
    newer = o.where(F.col("o_orderdate") > F.lit(CHANGED_SINCE).cast(T.TimestampNTZType())).select(
        "o_orderkey", "o_custkey", F.lit("X").alias("o_orderstatus"), "o_totalprice",
        (F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("o_orderdate"), "o_orderpriority",
    )
    # newer versions first: the order of arrival must not matter
    raw = standins.order_documents(newer).unionByName(standins.order_documents(o))
    docs = latest_per_key(routing.with_type(documents.parse(raw).select("doc")))
    docs, ft, ct = documents.stage(docs)  # parsed and reduced once
    flat = documents.flatten(docs, ft, ct)
    return flat.select("jira", F.col("status.name").alias("status"), "updated")
