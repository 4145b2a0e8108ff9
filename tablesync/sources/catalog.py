"""Catalogue scan: the tables of one schema, minus ``exclude``, within ``only``.

Three catalogue sources share one filter:

* a relational database over JDBC (``information_schema.tables`` on
  PostgreSQL, ``all_tables`` on Oracle) -- :func:`jdbc_catalog`;
* a Spark catalog namespace -- :func:`spark_catalog`;
* a folder of tables on shared storage (one table per top-level entry)
  -- :func:`folder_catalog`.

``None``, ``""`` and ``[]`` all mean "no filter"; a non-empty ``only``
makes ``exclude`` void.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _as_list(names) -> list[str]:
    if names is None or names == "":
        return []
    if isinstance(names, str):
        return [n.strip().strip("'").strip('"') for n in names.split(",") if n.strip()]
    return [str(n) for n in names]


def resolve_filters(exclude=None, only=None) -> tuple[list[str], list[str]]:
    """Normalise the lists; a non-empty ``only`` wins over ``exclude``."""
    excl, onl = _as_list(exclude), _as_list(only)
    if onl:
        excl = []
    return excl, onl


def sql_literal(value: str) -> str:
    """Quote a SQL string literal (single quotes doubled)."""
    return "'" + str(value).replace("'", "''") + "'"


def _in_list(values: list[str]) -> str:
    return ", ".join(sql_literal(v) for v in values)


def catalog_sql(schema: str, exclude=None, only=None, dialect: str = "postgresql") -> str:
    """The catalogue statement for a database (literals escaped).

    With no filters the PostgreSQL text is exactly
    ``SELECT table_name FROM information_schema.tables where table_schema = '<schema>'``.
    """
    excl, onl = resolve_filters(exclude, only)
    if dialect == "postgresql":
        q = f"SELECT table_name FROM information_schema.tables where table_schema = {sql_literal(schema)}"
    elif dialect == "oracle":
        q = f"SELECT table_name FROM all_tables where owner = {sql_literal(schema)}"
    else:
        raise ValueError(f"unknown dialect {dialect!r}")
    if excl:
        q += f" and table_name not in ({_in_list(excl)})"
    if onl:
        q += f" and table_name in ({_in_list(onl)})"
    return q


def filter_catalog(catalog: DataFrame, schema: str | None, exclude=None, only=None, keep=()) -> DataFrame:
    """Apply schema equality, ``NOT IN exclude`` and ``IN only`` to a
    ``(table_schema, table_name)`` frame; returns ``table_name`` (and the columns ``keep``)."""
    excl, onl = resolve_filters(exclude, only)
    out = catalog
    if schema is not None:
        out = out.where(F.col("table_schema") == F.lit(schema))
    if excl:
        out = out.where(~F.col("table_name").isin(excl))
    if onl:
        out = out.where(F.col("table_name").isin(onl))
    return out.select("table_name", *keep)


def jdbc_catalog(spark: SparkSession, url: str, schema: str, exclude=None, only=None, dialect: str = "postgresql", properties: dict | None = None) -> DataFrame:
    """Catalogue read from a database; the filters travel inside the statement.

    Oracle returns ``TABLE_NAME``; the column is renamed to ``table_name``.
    """
    reader = spark.read.format("jdbc").option("url", url).option("query", catalog_sql(schema, exclude, only, dialect))
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    df = reader.load()
    return df.select(F.col(df.columns[0]).alias("table_name"))


def keys_sql(schema: str, dialect: str = "postgresql") -> str:
    """Statement for (table, column): the first column of each primary key, where it is a number."""
    if dialect == "postgresql":
        return (
            "SELECT k.table_name, k.column_name FROM information_schema.table_constraints c "
            "JOIN information_schema.key_column_usage k ON k.constraint_schema = c.constraint_schema "
            "AND k.constraint_name = c.constraint_name AND k.table_name = c.table_name "
            "JOIN information_schema.columns d ON d.table_schema = k.table_schema AND d.table_name = k.table_name "
            "AND d.column_name = k.column_name "
            f"WHERE c.constraint_type = 'PRIMARY KEY' AND c.table_schema = {sql_literal(schema)} "
            "AND k.ordinal_position = 1 AND d.data_type IN ('smallint', 'integer', 'bigint', 'numeric')"
        )
    if dialect == "oracle":
        return (
            "SELECT k.table_name, k.column_name FROM all_constraints c "
            "JOIN all_cons_columns k ON k.owner = c.owner AND k.constraint_name = c.constraint_name "
            "JOIN all_tab_columns d ON d.owner = k.owner AND d.table_name = k.table_name AND d.column_name = k.column_name "
            f"WHERE c.constraint_type = 'P' AND c.owner = {sql_literal(schema)} AND k.position = 1 AND d.data_type = 'NUMBER'"
        )
    raise ValueError(f"unknown dialect {dialect!r}")


def jdbc_keys(spark: SparkSession, url: str, schema: str, dialect: str = "postgresql", properties: dict | None = None) -> dict[str, str]:
    """{table: key column} of a schema: one row a table, metadata of the database."""
    reader = spark.read.format("jdbc").option("url", url).option("query", keys_sql(schema, dialect))
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    return {r[0]: r[1] for r in reader.load().collect()}


def spark_catalog(spark: SparkSession, namespace: str, exclude=None, only=None) -> DataFrame:
    """Catalogue of a Spark catalog namespace (``SHOW TABLES``)."""
    shown = spark.sql(f"SHOW TABLES IN {namespace}")
    cat = shown.select(F.col("namespace").alias("table_schema"), F.col("tableName").alias("table_name"))
    return filter_catalog(cat, None, exclude, only)


def folder_catalog(spark: SparkSession, root: str, suffix: str = ".parquet") -> DataFrame:
    """``(table_schema, table_name, files, bytes)`` of a folder of tables.

    A table is a top-level entry ``<name><suffix>`` (a file or a folder of
    part files).  File listing only -- contents are not read (the binary
    source skips the content column when it is not selected) -- and the
    per-table roll-up is a normal aggregation, so a folder with millions
    of part files is listed by the cluster, not by the driver.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path", "length")
    )
    root_name = os.path.basename(os.path.normpath(root))
    rel = F.regexp_extract(F.col("path"), r"[^/]+" + _re_escape(suffix) + r"(?=/|$)", 0)
    return (
        files.withColumn("entry", rel)
        .where(F.col("entry") != "")
        .groupBy("entry")
        .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
        .select(
            F.lit(root_name).alias("table_schema"),
            F.expr(f"substring(entry, 1, length(entry) - {len(suffix)})").alias("table_name"),
            "files",
            "bytes",
        )
    )


def _re_escape(s: str) -> str:
    import re

    return re.escape(s)


def preview(catalog: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` rows, for a log line (the limit is the feature)."""
    return catalog.limit(n)
