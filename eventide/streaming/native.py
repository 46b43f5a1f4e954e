"""Triggered window sums with Spark's own streaming operators.

``withWatermark`` + ``groupBy(key, window)``: in ``append`` mode each window is
emitted once, when Spark's watermark (max event time minus ``delay``) passes its
end: the watermark trigger.  In ``update`` mode each micro-batch emits the
windows it changed: the aligned processing-time (micro-batch) trigger, with
``Trigger.ProcessingTime(period)`` on the query.  State is kept per (key, window)
in the state store and dropped behind the watermark, and so are rows that come later; the ``..._and_late``
forms give the same sums with those rows as output.

Spark watermarks need a TIMESTAMP column; event times are TIMESTAMP_NTZ read as
UTC, so a UTC TIMESTAMP copy carries the watermark and bounds go back to NTZ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.functions.timefmt import dur_us
from eventide.plans.spec import PaneSpec
from eventide.streaming.panes import stream_ledger
from eventide.streaming.sessions import stream_session_panes


def _with_event_time(stream: DataFrame, ts: str, delay: str) -> DataFrame:
    return stream.withColumn("_ets", F.col(ts).cast("timestamp")).withWatermark("_ets", delay)


def stream_window_sums(stream: DataFrame, size: str, delay: str, key: str = "key", value: str = "score",
                       ts: str = "event_ts") -> DataFrame:
    w = F.window("_ets", size)
    return (_with_event_time(stream, ts, delay).groupBy(F.col(key).alias("key"), w.alias("w"))
            .agg(F.sum(F.col(value).cast("bigint")).alias("value"))
            .select("key", F.col("w.start").cast("timestamp_ntz").alias("w_start"),
                    F.col("w.end").cast("timestamp_ntz").alias("w_end"), "value"))


def stream_session_sums(stream: DataFrame, gap: str, delay: str, key: str = "key", value: str = "score",
                        ts: str = "event_ts") -> DataFrame:
    """Sessions where touching proto-windows do not merge.

    Spark's ``session_window`` merges windows that touch, so the gap is given one
    microsecond shorter and the end moved back out by one microsecond.
    """
    g = dur_us(gap) - 1
    sw = F.session_window("_ets", f"{g} microseconds")
    return (_with_event_time(stream, ts, delay).groupBy(F.col(key).alias("key"), sw.alias("w"))
            .agg(F.sum(F.col(value).cast("bigint")).alias("value"))
            .select("key", F.col("w.start").cast("timestamp_ntz").alias("w_start"),
                    F.timestamp_micros(F.unix_micros("w.end") + F.lit(1)).cast("timestamp_ntz").alias("w_end"),
                    "value"))


def _sums_and_late(panes: DataFrame) -> DataFrame:
    return panes.select("kind", "key", "w_start", "w_end", "value", "event_ts")


def stream_window_sums_and_late(stream: DataFrame, size: str, delay: str, lateness: str = "0 seconds") -> DataFrame:
    """``kind, key, w_start, w_end, value, event_ts`` from ``key, score, event_ts``: sums (``pane``) and late rows (``dropped``).

    Under the watermark that ``withWatermark(event_ts, delay)`` gives.  With ``lateness`` a window
    stays open for that long and every late row puts out its new sum.
    """
    return _sums_and_late(stream_ledger(stream, PaneSpec(size=size, lateness=lateness), delay=delay))


def stream_session_sums_and_late(stream: DataFrame, gap: str, delay: str, lateness: str = "0 seconds") -> DataFrame:
    """As ``stream_window_sums_and_late`` for sessions; touching ones do not merge."""
    return _sums_and_late(stream_session_panes(stream, gap, PaneSpec(lateness=lateness), delay=delay))
