"""Type rules applied to a scanned table before it is written."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: type names whose columns the target cannot hold.
UNSUPPORTED_TYPE_NAMES = ("binary", "map", "array")

_TARGETS = {"float": T.FloatType(), "double": T.DoubleType()}


def decimals_to(df: DataFrame, to: str = "float") -> DataFrame:
    """Cast every top-level decimal column to ``float`` (default) or ``double``.

    One projection built from the schema (no per-column ``withColumn``
    chain).  Decimals nested in arrays or structs are left alone, as in the
    source tool.  ``to='keep'`` returns the frame unchanged.
    """
    if to == "keep":
        return df
    target = _TARGETS[to]
    cols = [
        F.col(f"`{f.name}`").cast(target).alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ]
    return df.select(*cols)


def drop_types(df: DataFrame, type_names: tuple[str, ...] = UNSUPPORTED_TYPE_NAMES) -> DataFrame:
    """Drop top-level columns whose type name is in ``type_names``.

    The projection is pushed into the scan, so dropped columns are never read.
    """
    keep = [f"`{f.name}`" for f in df.schema.fields if f.dataType.typeName() not in type_names]
    return df.select(*keep)


def clean_strings(df: DataFrame) -> DataFrame:
    """Opt-in string clean-up: trim spaces, empty string -> NULL."""
    cols = [
        F.nullif(F.trim(F.col(f"`{f.name}`")), F.lit("")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ]
    return df.select(*cols)
