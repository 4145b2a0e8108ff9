"""Incremental document sync driven by a file stream.

Raw documents land as JSON-lines files (one document per line) in a folder
-- written by whatever polls the API.  A streaming query picks up new files
and applies each micro-batch as an upsert (``foreachBatch``): a batch of files
never replaces a table, and a late file with an older version of a document
does not overwrite a newer row.  Re-running a micro-batch after a failure is
safe: the upsert is idempotent (delete by key, then insert) and a family
version only becomes visible at its commit.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.jobs import sync_documents
from ..plans.sinks import TableFamily
from ..session import checkpoint_root
from ..sources import tracker


def document_stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming frame ``raw`` over JSON-lines files in ``folder``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(folder).select(F.col("value").alias("raw")).where(F.length(F.trim("raw")) > 0)


def tracker_stream(spark: SparkSession, fetcher_factory, **options) -> DataFrame:
    """Streaming frame ``raw`` of the documents updated at the tracker; the
    offset in the query's checkpoint is the high-water mark."""
    tracker.register(spark, fetcher_factory)
    return spark.readStream.format("updated_documents").options(**options).load().select("raw")


def start_sync(
    spark: SparkSession,
    source: str | DataFrame,
    family: TableFamily,
    checkpoint: str | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
    **sync_kw,
) -> StreamingQuery:
    """Start the streaming sync of a folder or of a stream with a column ``raw``;
    ``available_now`` processes what is there and stops (a scheduled job),
    otherwise it runs every ``processing_time``."""
    stream = document_stream(spark, source, max_files_per_trigger) if isinstance(source, str) else source

    def apply(batch: DataFrame, epoch_id: int) -> None:
        if batch.isEmpty():
            return
        # the files are the changes: no API filter text is needed; several
        # files in one micro-batch may repeat a key, so keep the latest
        kw = {"dedupe_keys": True, "upsert_only": True, "keep_newest": True, **sync_kw}
        sync_documents(batch.sparkSession, lambda _since: batch, family, **kw)

    ckpt = checkpoint or os.path.join(checkpoint_root(spark), "tablesync", "streams", os.path.basename(family.root.rstrip("/")))
    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", ckpt)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
