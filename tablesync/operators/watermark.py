"""High-water mark over a family of target tables and the incremental filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import times

# Fixed value: the update-time column the targets carry (cleaned name).
UPDATED_COLUMN = "Mise_a_jour"


def high_water_mark(targets: list[DataFrame], column: str = UPDATED_COLUMN, alias: str = "last_update") -> DataFrame:
    """One row: max of ``column`` over the union of all targets (UTC ``timestamp_ntz``).

    Each target contributes only its one column (pruned into the scan), the
    union feeds a partial max per partition and one final max, so nothing
    but partial aggregates is shuffled.  Targets lacking the column are
    skipped; no target at all gives NULL.
    """
    parts = [
        t.select(times.mark_as_utc(F.col(f"`{column}`"), t.schema[column].dataType).alias("m"))
        for t in targets
        if column in t.columns
    ]
    if not parts:
        raise ValueError("no target carries the update column; use None as the mark")
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return union.agg(F.max("m").alias(alias))


def mark_text(mark: DataFrame, column: str = "last_update", zone: str = times.MARK_ZONE) -> DataFrame:
    """Add the API filter text (local zone, minute grain) of the mark."""
    return mark.withColumn("mark_text", times.format_mark(F.col(column), zone))


def since(df: DataFrame, mark, column: str = UPDATED_COLUMN) -> DataFrame:
    """Rows updated strictly after ``mark`` (a literal or a Column)."""
    m = mark if not isinstance(mark, str) else F.lit(mark).cast(T.TimestampNTZType())
    return df.where(F.col(f"`{column}`") > m)
