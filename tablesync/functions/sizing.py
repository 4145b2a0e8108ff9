"""Output partition sizing: ceil(bytes / target), at least 1."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: target bytes per output partition (9 MiB, under a 10 MB limit).
TARGET_PARTITION_BYTES = 9 * 1024 * 1024


def partitions_for(size_bytes: int | None, target: int = TARGET_PARTITION_BYTES) -> int | None:
    """Driver form for one table; ``None`` means "leave the partitioning"."""
    if not size_bytes or size_bytes <= 0:
        return None
    return max(1, (size_bytes + target - 1) // target)


def partitions_col(size_bytes: Column | str, target: int = TARGET_PARTITION_BYTES) -> Column:
    """Column form for a whole catalogue of sizes (NULL when size <= 0)."""
    b = F.col(size_bytes) if isinstance(size_bytes, str) else size_bytes
    n = F.greatest(F.lit(1).cast("bigint"), F.floor((b.cast("bigint") + F.lit(target - 1)) / F.lit(target)).cast("bigint"))
    return F.when(b > 0, n)
