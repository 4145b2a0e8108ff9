"""Whole-table scans of a relational source.

A :class:`TableSource` names where tables live: a database over JDBC, or a
columnar folder (``format`` + ``root``).  :func:`read_table` gives the same
lazy ``DataFrame`` either way, so every later step is source-agnostic.

JDBC scans are split into ``num_partitions`` key ranges of equal depth
(:func:`depth_predicates`) or hash buckets (:func:`hash_predicates`), one
task each: a single-partition read of a big table is one task on one
executor holding one connection, however big the cluster.
"""

from __future__ import annotations

import logging
import math
from dataclasses import dataclass, field
from decimal import Decimal

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog import sql_literal

log = logging.getLogger(__name__)


def quoted(identifier: str) -> str:
    """A database identifier in double quotes (PostgreSQL, Oracle)."""
    return '"' + identifier.replace('"', '""') + '"'


@dataclass(frozen=True)
class TableSource:
    """Where tables are read from.

    ``format='jdbc'``: ``url`` + ``driver`` (+ ``fetchsize``, ``schema`` used
    to qualify names).  Any other format: ``root`` folder holding
    ``<table><suffix>`` entries.
    """

    format: str = "jdbc"
    url: str | None = None
    driver: str | None = None
    schema: str | None = None
    fetchsize: int | None = None
    root: str | None = None
    suffix: str = ".parquet"
    options: dict = field(default_factory=dict)

    def qualified(self, table: str) -> str:
        """The table's quoted name: catalogues give names as they are, so mixed
        case and special characters must not be folded."""
        return ".".join(quoted(p) for p in (self.schema, table) if p)

    @property
    def sized(self) -> bool:
        """Whether the database tells the bytes of a table."""
        return self.format == "jdbc" and self.driver == POSTGRESQL_DRIVER

    def jdbc_properties(self) -> dict[str, str]:
        props = dict(self.options)
        if self.driver:
            props["driver"] = self.driver
        if self.fetchsize:
            props["fetchsize"] = str(self.fetchsize)
        return props


# The JDBC drivers of the two supported databases and the
# Oracle fetch size.
POSTGRESQL_DRIVER = "org.postgresql.Driver"
ORACLE_DRIVER = "oracle.jdbc.driver.OracleDriver"
ORACLE_FETCHSIZE = 10000


def jdbc_url(url: str) -> str:
    """Prefix ``jdbc:`` when missing."""
    return url if url.startswith("jdbc:") else "jdbc:" + url


def read_table(spark: SparkSession, source: TableSource, table: str, predicates: list[str] | None = None) -> DataFrame:
    """Lazy scan of one whole table; with ``predicates`` one task per predicate."""
    if source.format == "jdbc":
        props = source.jdbc_properties()
        if predicates:
            return spark.read.jdbc(source.url, source.qualified(table), predicates=predicates, properties=props)
        return spark.read.jdbc(source.url, source.qualified(table), properties=props)
    # File sources split themselves by spark.sql.files.maxPartitionBytes;
    # key predicates only matter for a database connection.
    reader = spark.read.format(source.format).options(**source.options)
    return reader.load(f"{source.root.rstrip('/')}/{table}{source.suffix}")


def tag_scan_partition(df: DataFrame, predicates: list[str], column: str = "scan_part") -> DataFrame:
    """Add the index of the predicate that selects each row (NULL if none).

    Checks on real data that a predicate set is exhaustive and disjoint.
    """
    tag = F.lit(None).cast("int")
    for i in reversed(range(len(predicates))):
        tag = F.when(F.expr(predicates[i]), F.lit(i)).otherwise(tag)
    return df.withColumn(column, tag)


def key_bounds(df: DataFrame, key: str) -> tuple:
    """(min, max, rows) of a key: one small aggregate (pushed to the source
    on JDBC as ``SELECT MIN, MAX, COUNT``; answered from footers on Parquet)."""
    r = df.agg(F.min(key), F.max(key), F.count(F.lit(1))).first()
    return r[0], r[1], r[2]


def range_predicates(key: str, lower: int, upper: int, num_partitions: int) -> list[str]:
    """Disjoint, exhaustive predicates over ``[lower, upper]``; NULL keys go
    to the first range, values outside the bounds to the first/last one."""
    n = max(1, int(num_partitions))
    width = max(1, math.ceil((upper - lower + 1) / n))
    n = max(1, min(n, math.ceil((upper - lower + 1) / width)))
    preds = []
    for i in range(n):
        lo = lower + i * width
        hi = lo + width
        conds = []
        if i > 0:
            conds.append(f"{key} >= {lo}")
        if i < n - 1:
            conds.append(f"{key} < {hi}")
        body = " AND ".join(conds) if conds else "1 = 1"
        preds.append(f"({body}) OR {key} IS NULL" if i == 0 and conds else body)
    return preds


def _point(value) -> str:
    """A split point as a literal of the database."""
    if isinstance(value, bool) or not isinstance(value, (int, float, Decimal, str)):
        raise ValueError(f"keys of type {type(value).__name__} cannot be split into ranges; use a hash")
    return sql_literal(value) if isinstance(value, str) else f"{value:f}" if isinstance(value, Decimal) else str(value)


def depth_predicates(key: str, points) -> list[str]:
    """Disjoint, exhaustive predicates between ascending split points: one range more than
    points.  Equal points (a key that fills several ranges) are one; NULLs are in the first."""
    points = sorted({p for p in points if p is not None})
    if not points:
        return ["1 = 1"]
    cuts = [_point(p) for p in points]
    first = f"({key} < {cuts[0]}) OR {key} IS NULL"
    return [first, *(f"{key} >= {a} AND {key} < {b}" for a, b in zip(cuts, cuts[1:])), f"{key} >= {cuts[-1]}"]


def hash_predicates(key_expr_sql: str, num_partitions: int) -> list[str]:
    """Bucket predicates for keys that are not numeric: ``MOD(<hash>, n) = i``.

    ``key_expr_sql`` must be a non-negative integer expression in the
    database's dialect (e.g. ``ORA_HASH(id)`` or ``abs(hashtext(id))``).
    NULL hashes go to bucket 0.
    """
    n = max(1, int(num_partitions))
    preds = [f"MOD({key_expr_sql}, {n}) = {i}" for i in range(n)]
    preds[0] = f"({preds[0]}) OR ({key_expr_sql}) IS NULL"
    return preds


def partitions_for_rows(rows: int, rows_per_partition: int = 1_000_000) -> int:
    """How many scan tasks for a table of ``rows`` rows."""
    return max(1, math.ceil(rows / rows_per_partition))


def bounds_sql(table: str, key: str) -> str:
    """One-row bounds statement run by the database itself (a plain JDBC
    read does not push aggregates down, so ``MIN/MAX`` over a scan would
    stream the whole key column through one task)."""
    return f"(SELECT MIN({key}) AS lo, MAX({key}) AS hi, COUNT(*) AS n FROM {table}) b"


def source_bounds(spark: SparkSession, source: TableSource, table: str, key: str) -> tuple:
    """(min, max, rows) of an integer key, computed where the data lives."""
    if source.format == "jdbc":
        r = spark.read.jdbc(source.url, bounds_sql(source.qualified(table), key), properties=source.jdbc_properties()).first()
        return r[0], r[1], r[2]
    return key_bounds(read_table(spark, source, table).select(key), key)


def split_sql(table: str, key: str, ranges: int, sample: str = "") -> str:
    """Statement for the smallest key of each of ``ranges`` equally deep ranges, run by the
    database itself; ``sample`` is its own sampling clause (``TABLESAMPLE SYSTEM (1)`` or
    ``SAMPLE BLOCK (1)``), for tables too large to sort."""
    tiles = f"SELECT {key} AS k, NTILE({int(ranges)}) OVER (ORDER BY {key}) AS t FROM {table}{' ' + sample if sample else ''} WHERE {key} IS NOT NULL"
    return f"(SELECT MIN(k) AS lo FROM ({tiles}) q GROUP BY t) b"


def split_points(spark: SparkSession, source: TableSource, table: str, key: str, ranges: int, sample: str = "") -> list:
    """Up to ``ranges - 1`` ascending keys between which about as many rows lie."""
    if source.format == "jdbc":
        statement = split_sql(source.qualified(table), quoted(key), ranges, sample)
        found = sorted(r[0] for r in spark.read.jdbc(source.url, statement, properties=source.jdbc_properties()).collect())
        return found[1:]
    shares = [i / ranges for i in range(1, ranges)]
    if not shares:
        return []
    return read_table(spark, source, table).agg(F.percentile_approx(key, shares, 100 * ranges)).first()[0] or []


def read_table_partitioned(
    spark: SparkSession,
    source: TableSource,
    table: str,
    key: str,
    num_partitions: int | None = None,
    rows_per_partition: int = 1_000_000,
    hash_expr: str | None = None,
    sample: str = "",
    equal_width: bool = False,
) -> DataFrame:
    """Scan split into ranges of a key that hold about as many rows each, however the key
    is distributed, or -- with ``hash_expr`` (e.g. ``ORA_HASH(code)``), for keys that have
    no order to use -- into hash buckets.  Sized from a row count in the database.

    ``equal_width`` cuts an integer key's range evenly instead: one cheap probe, for keys
    known to be spread evenly."""
    if source.format != "jdbc":
        return read_table(spark, source, table)  # files split themselves
    if equal_width and hash_expr is None:
        lower, upper, rows = source_bounds(spark, source, table, quoted(key))
        if lower is None:
            return read_table(spark, source, table)
        n = num_partitions or partitions_for_rows(int(rows), rows_per_partition)
        return read_table(spark, source, table, predicates=range_predicates(quoted(key), int(lower), int(upper), n))
    n = num_partitions
    if n is None:
        counting = f"(SELECT COUNT(*) AS n FROM {source.qualified(table)}) c"
        rows = spark.read.jdbc(source.url, counting, properties=source.jdbc_properties()).first()[0]
        n = partitions_for_rows(int(rows or 0), rows_per_partition)
    if hash_expr is not None:
        return read_table(spark, source, table, predicates=hash_predicates(hash_expr, n))
    if n == 1:
        return read_table(spark, source, table)
    points = split_points(spark, source, table, key, n, sample)
    return read_table(spark, source, table, predicates=depth_predicates(quoted(key), points))


def size_sql(table: str) -> str:
    """PostgreSQL size probe, aliased (Spark wraps it as a subquery)."""
    return f"(SELECT pg_total_relation_size({sql_literal(table)}) AS size_bytes) AS s"


def table_size_bytes(spark: SparkSession, source: TableSource, table: str) -> int:
    """Bytes of one table: PostgreSQL asks the database, files sum their
    lengths; a failure, which is logged, or NULL gives 0 ("unknown")."""
    try:
        if source.format == "jdbc":
            row = spark.read.jdbc(source.url, size_sql(source.qualified(table)), properties=source.jdbc_properties()).first()
            return int(row[0]) if row and row[0] else 0
        path = f"{source.root.rstrip('/')}/{table}{source.suffix}"
        row = (
            spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
            .agg(F.sum("length")).first()
        )
        return int(row[0]) if row and row[0] else 0
    except (PySparkException, Py4JError) as exc:  # the size is only a hint
        log.warning("size of %s unknown: %s", table, exc)
        return 0
