"""The parquet tables and the score / arrival-log views derived from ``events``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.plans.spec import TickWatermark

# Arrival of an event: its event time plus a deterministic lag of up to two hours.
ARRIVAL_LAG_MULTIPLIER = 7919
ARRIVAL_LAG_MODULUS_S = 7200
# Heuristic watermark of the derived log: at each whole hour of processing time,
# the watermark is one hour behind it.
EVENT_WATERMARK = TickWatermark(tick="1 hour", lag="1 hour")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scores_from_events(events: DataFrame, key: str = "event_type") -> DataFrame:
    """``key, score, event_ts`` plus ids; score = value in cents, exact as BIGINT."""
    return events.select(
        F.col(key).cast("string").alias("key"),
        F.round(F.col("value") * 100).cast("bigint").alias("score"),
        F.col("ts").alias("event_ts"),
        F.col("event_id"), F.col("user_id"),
    )


def arrival_ts_of(ts: str = "ts", event_id: str = "event_id") -> F.Column:
    lag_s = F.pmod(F.col(event_id) * ARRIVAL_LAG_MULTIPLIER, F.lit(ARRIVAL_LAG_MODULUS_S))
    return F.timestamp_micros(F.unix_micros(F.col(ts).cast("timestamp")) + lag_s * 1_000_000).cast("timestamp_ntz")


def arrival_log_from_events(events: DataFrame, key: str = "event_type",
                            watermark: TickWatermark = EVENT_WATERMARK) -> DataFrame:
    """Arrival log ``key, score, event_ts, arrival_ts, seq, wm_ts``.

    ``seq`` is the event id: a per-row tie breaker for equal arrival times, never
    a global position.  ``wm_ts`` is the watermark in force when the row arrived.
    """
    s = scores_from_events(events, key)
    return s.select("key", "score", "event_ts", arrival_ts_of("event_ts").alias("arrival_ts"),
                    F.col("event_id").alias("seq")).withColumn("wm_ts", watermark.wm_at(F.col("arrival_ts")))


__all__ = ["load", "scores_from_events", "arrival_log_from_events", "arrival_ts_of", "EVENT_WATERMARK"]
