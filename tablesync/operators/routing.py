"""Route documents to one target table per (type name, sub-task flag)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import type_table_name_col
from .documents import SUBTASK_PATH, TYPE_PATH


def with_type(docs: DataFrame, doc: str = "doc") -> DataFrame:
    """Add ``_type`` (type name) and ``_subtask`` (flag, may be NULL)."""
    return docs.withColumn("_type", F.try_variant_get(F.col(doc), TYPE_PATH, "string")).withColumn(
        "_subtask", F.try_variant_get(F.col(doc), SUBTASK_PATH, "boolean")
    )


def route(docs: DataFrame, types: DataFrame | None = None, exclude_types=()) -> DataFrame:
    """Add ``_target`` = cleaned type name (+ ``_subtask``).

    The flag comes from the document when it carries one; otherwise from the
    type metadata ``types(name, subtask)``.  Excluded type names are filtered
    out first.
    """
    if "_type" not in docs.columns:
        docs = with_type(docs)
    if exclude_types:
        docs = docs.where(~F.col("_type").isin(list(exclude_types)) | F.col("_type").isNull())
    if types is not None:
        docs = attach_subtask(docs, types)
    return docs.withColumn("_target", type_table_name_col(F.col("_type"), F.col("_subtask"))).drop("_ambiguous")


def route_names(docs: DataFrame, types: DataFrame | None = None, exclude_types=()) -> DataFrame:
    """The distinct target tables ``t`` of a batch: names are cleaned once per
    distinct (type, flag), not once per document."""
    if "_type" not in docs.columns:
        docs = with_type(docs)
    return route(docs.select("_type", "_subtask").distinct(), types, exclude_types).select(F.col("_target").alias("t")).distinct()


def attach_subtask(docs: DataFrame, types: DataFrame) -> DataFrame:
    """Fill a missing sub-task flag from type metadata ``(name, subtask)``.

    The metadata is reduced to one row per name first, so the join never
    multiplies documents.  A name listed both as task and as sub-task says
    nothing: such a document keeps its own flag, or none.  The join strategy
    is left to Spark.
    """
    meta = (
        types.groupBy(F.col("name").alias("_meta_name"))
        .agg(F.min("subtask").alias("_lo"), F.max("subtask").alias("_hi"))
        .select("_meta_name", F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).alias("_meta_subtask"), (F.col("_lo") != F.col("_hi")).alias("_meta_both"))
    )
    docs = docs.join(meta, docs["_type"] == meta["_meta_name"], "left")
    return (
        docs.withColumn("_ambiguous", F.col("_subtask").isNull() & F.coalesce(F.col("_meta_both"), F.lit(False)))
        .withColumn("_subtask", F.coalesce(F.col("_subtask"), F.col("_meta_subtask")))
        .drop("_meta_name", "_meta_subtask", "_meta_both")
    )


def route_counts(docs: DataFrame, types: DataFrame | None = None, exclude_types=()) -> DataFrame:
    """Rows per target table.

    Counts are taken per raw (type, flag) first -- partial counts per
    partition, one small shuffle -- and only the few resulting rows go
    through the name cleaning, so no per-row Python work is done.  Names
    that clean to the same table are summed.
    """
    if "_type" not in docs.columns:
        docs = with_type(docs)
    per_type = docs.groupBy("_type", "_subtask").agg(F.count(F.lit(1)).alias("n"))
    routed = route(per_type, types=types, exclude_types=exclude_types)
    return routed.groupBy(F.col("_target").alias("t")).agg(F.sum("n").alias("n"))


def target_names(pairs, existing=()) -> dict[tuple, str]:
    """Driver-side table names for distinct (type, flag) pairs (metadata).

    Names that differ by case only are one table -- the existing one, else the
    first in order -- as they would be in a case-insensitive warehouse.
    """
    from ..functions.names import type_table_name

    known = {t.lower(): t for t in existing}
    out = {}
    for t, s in sorted(pairs, key=str):
        name = type_table_name(t, bool(s))
        out[(t, s)] = known.setdefault(name.lower(), name)
    return out
