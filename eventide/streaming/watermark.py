"""Source-asserted watermarks for Structured Streaming.

Spark's own watermark is the greatest event time seen less a delay.  Here a row says what
the source's watermark is, in column ``wm_ts``: data rows carry the one in force, a row
without an event time only moves it.  The column is given to Spark one second ahead of a delay of
one second, so the watermark becomes exactly the greatest ``wm_ts`` and no row is ever
behind it.  What is late is for the operator to judge, by its own windows.

Rows without an event time (or other payload) form a group of their own, which the operators
pass over.  One such row moves the watermark for all keys.  A row with a payload but without a
key is data like any other, under the null key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.functions.timefmt import dur_us

#: 2260-01-01 in milliseconds: a watermark at or beyond means that the input is complete.
COMPLETE_MS = 9_151_488_000_000


def asserted(stream: DataFrame, wm: str = "wm_ts") -> DataFrame:
    # Capped an hour after completion, so that times at the watermark stay within what pandas can hold.
    last = F.timestamp_millis(F.lit(COMPLETE_MS + 3_600_000))
    capped = F.least(F.col(wm).cast("timestamp"), last)
    return stream.withColumn("_wm", capped + F.expr("INTERVAL 1 SECOND")).withWatermark("_wm", "1 second")


#: How far behind the watermark a row may come and still reach the operators, which judge lateness themselves.
HORIZON = "3650 days"


def observed(stream: DataFrame, ts: str, delay: str) -> DataFrame:
    """Spark's usual watermark, the greatest event time seen less ``delay``, under which late rows still arrive.

    The column given to Spark is ``HORIZON`` ahead of the event time, and so is its delay: the
    watermark is the same, but only rows later than ``HORIZON`` are behind it.
    """
    ahead, late = dur_us(HORIZON) // 1_000_000, dur_us(HORIZON) + dur_us(delay)
    return stream.withColumn("_wm", F.col(ts).cast("timestamp") + F.expr(f"INTERVAL {ahead} SECOND")).withWatermark(
        "_wm", f"{late} microseconds")


def keyed(key: str) -> tuple[Column, Column]:
    """The key, and ``no_key``: whether it is null.  Neither is null, as state keys must be."""
    return F.coalesce(key, F.lit("")).alias(key), F.col(key).isNull().alias("no_key")


def original_key(key: str = "key") -> Column:
    """The key as it came, from the columns of ``keyed``."""
    return F.when(~F.col("no_key"), F.col(key)).alias(key)


def steps(*payload: str) -> Column:
    """Whether a row only moves the watermark: its ``payload`` columns (the event time) are all null."""
    out = F.lit(True)
    for c in payload or ("event_ts",):
        out = out & F.col(c).isNull()
    return out
