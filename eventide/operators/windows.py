"""Event-time windows whose bounds depend on the data: sessions and validity windows.

Both are ordered scans per key.  They run on the bucketed scans of
``eventide.plans.scan`` so a key holding a third of all rows is spread over
many tasks (one per key and time bucket) instead of landing in one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.functions.timefmt import dur_us, plus, to_us
from eventide.plans.scan import running_sums, with_next, with_prev


def _bucket(ts: str, width: str) -> F.Column:
    return F.floor(to_us(ts) / F.lit(dur_us(width)))


def session_ids(scores: DataFrame, gap: str, key: str = "key", ts: str = "event_ts", tie: str = "seq",
                bucket: str = "1 hour") -> DataFrame:
    """Every row with ``_sid``, the number of its final session within its key (1-based)."""
    rows = with_prev(scores.withColumn("_b", _bucket(ts, bucket)), [key], [ts, tie], "_b", ts, "_prev")
    opens = F.when(F.col("_prev").isNull() | (to_us(ts) - to_us("_prev") >= dur_us(gap)), 1).otherwise(0)
    return running_sums(rows, [key], [ts, tie], "_b", {"_sid": opens.cast("long")}).drop("_b", "_prev")


def session_sum(scores: DataFrame, gap: str, key: str = "key", value: str = "score", ts: str = "event_ts",
                bucket: str = "1 hour") -> DataFrame:
    """Sessions: each element opens ``[t, t+gap)``; windows that overlap merge.

    Touching windows (next element exactly ``gap`` later) do not merge.  Output
    ``key, w_start, w_end, value`` with ``w_end = last element + gap``.

    One scan and no join: rows are summed into sessions inside each (key, bucket); of these,
    only a bucket's first and last can go on in another bucket, and only they meet per key.
    """
    g = dur_us(gap)
    base = scores.select(F.col(key).alias("key"), F.col(value).cast("bigint").alias("score"), F.col(ts).alias("_t"),
                         _bucket(ts, bucket).alias("_b"))
    return _merge_sessions(base, g).select(F.col("key").alias(key), "w_start", plus("_last", g / 1e6).alias("w_end"), "value")


def _merge_sessions(rows: DataFrame, gap_us: int) -> DataFrame:
    """(key, score, _t, _b) to (key, w_start, _last, value): sums of runs with gaps below ``gap_us``."""
    def numbered(df: DataFrame, part: list[str], start: str, last: str) -> DataFrame:
        w = Window.partitionBy(*part).orderBy(start)
        before = F.lag(last).over(w)
        df = df.withColumn("_gap", F.when(before.isNull() | (to_us(start) - to_us(before) >= gap_us), 1).otherwise(0))
        return df.withColumn("_sid", F.sum("_gap").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))

    local = numbered(rows.withColumn("_u", F.col("_t")), ["key", "_b"], "_t", "_u").groupBy("key", "_b", "_sid").agg(
        F.min("_t").alias("w_start"), F.max("_t").alias("_last"), F.sum("score").alias("value"))
    ends = Window.partitionBy("key", "_b")
    edge = (F.col("_sid") == 1) | (F.col("_sid") == F.max("_sid").over(ends))
    local = local.withColumn("_part", F.when(edge, F.lit(None).cast("long")).otherwise(F.col("_b").cast("long")))
    merged = numbered(local.drop("_sid"), ["key", "_part"], "w_start", "_last")
    return merged.groupBy("key", "_part", "_sid").agg(
        F.min("w_start").alias("w_start"), F.max("_last").alias("_last"), F.sum("value").alias("value")).drop(
            "_part", "_sid")


def validity_windows(scores: DataFrame, key: str = "key", value: str = "score", ts: str = "event_ts",
                     bucket: str = "1 hour") -> DataFrame:
    """A value at X is valid over ``[X, next X)``; the newest one is open-ended (``w_end`` NULL).

    Elements with equal timestamps share a window and are summed.
    """
    per_ts = (scores.groupBy(F.col(key).alias("key"), F.col(ts).alias("w_start"))
              .agg(F.sum(F.col(value).cast("bigint")).alias("value"))
              .withColumn("_b", _bucket("w_start", bucket)))
    out = with_next(per_ts, ["key"], ["w_start"], "_b", "w_start", "w_end")
    return out.select("key", "w_start", "w_end", "value")
