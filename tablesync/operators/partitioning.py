"""Output partition sizing applied to a frame."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.sizing import TARGET_PARTITION_BYTES, partitions_for


def size_partitions(df: DataFrame, size_bytes: int | None, target: int = TARGET_PARTITION_BYTES) -> DataFrame:
    """ceil(size / target) partitions when the size is known.

    A scan (a frame without shuffles) that has at least as many is coalesced, which
    shuffles nothing; only one with fewer partitions is dealt out round-robin.  When it is not (``None``/0), ask AQE to rebalance toward
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` instead of guessing:
    a ``REBALANCE`` hint splits big partitions and merges small ones from
    the runtime shuffle statistics.
    """
    n = partitions_for(size_bytes, target)
    if n is None:
        return df.hint("rebalance")
    return df.coalesce(n) if n <= df.rdd.getNumPartitions() else df.repartition(n)
