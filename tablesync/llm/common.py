"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.session import scratch_path

# A word is a run of characters other than these six (fixed by the contracts).
SPACE = "\\x20\\x09-\\x0D"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts the lineage in a way that survives the loss of any executor.
    """
    path = scratch_path(df.sparkSession, f"llm-{purpose}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def few(df: DataFrame, most: int = 10_000) -> DataFrame:
    """A stored table, marked for broadcast if it is counted and has few rows; beyond
    that a join with it shuffles, and Spark splits the large keys' partitions."""
    return F.broadcast(df) if df.count() <= most else df


def utf8(text: str | None) -> bytes:
    """UTF-8 of a text; a null reads as empty, a lone surrogate is kept."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def text_slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches cut to a few rows each, so that a task holds few Python strings at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, lengthened until no column of ``df`` has that name in any case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted
