"""Session settings that follow from the size of the input."""

from __future__ import annotations

import math

_MIB = 1024 * 1024


def session_settings(input_bytes: int, *, partition_bytes: int = 512 * _MIB) -> dict[str, str]:
    """Settings for ``SparkSession.builder.config``; the caller owns the session.

    The one wide shuffle of a run carries about the input once, so its width is
    the input over the partition size. Adaptive execution merges what turns out
    small and splits what turns out skewed in joins.
    """
    width = max(200, min(200_000, math.ceil(input_bytes / partition_bytes)))
    scan_bytes = 128 * _MIB if input_bytes < 1024**4 else partition_bytes
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.files.maxPartitionBytes": str(scan_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # The gated table has two partitions: two open files spare a sort before it.
        "spark.sql.maxConcurrentOutputFileWriters": "8",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
    }
