"""Keyed sums: unwindowed (global window) and per event-time window.

Both are one ``groupBy``: Spark runs a partial aggregate before the shuffle, so a
hot key costs one row per map partition, not its row count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sum_per_key(scores: DataFrame, key: str = "key", value: str = "score") -> DataFrame:
    """Global window: one row per key, ``value`` = sum (BIGINT, no wrap-around)."""
    return scores.groupBy(key).agg(F.sum(F.col(value).cast("bigint")).alias("value"))


def fixed_window_sum(scores: DataFrame, size: str, key: str = "key", value: str = "score",
                     ts: str = "event_ts", offset: str | None = None) -> DataFrame:
    """Tumbling windows ``[start, start+size)`` aligned to the epoch (plus ``offset``)."""
    win = F.window(ts, size, size, offset) if offset else F.window(ts, size)
    return (scores.groupBy(key, win.alias("w"))
            .agg(F.sum(F.col(value).cast("bigint")).alias("value"))
            .select(key, F.col("w.start").alias("w_start"), F.col("w.end").alias("w_end"), "value"))
