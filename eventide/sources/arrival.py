"""Visits and impressions as one keyed stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VISIT = T.StructType([T.StructField("url", T.StringType()), T.StructField("ts", T.TimestampNTZType()),
                      T.StructField("referer", T.StringType()), T.StructField("is_goal", T.BooleanType())])
IMPRESSION = T.StructType([T.StructField("id", T.LongType()), T.StructField("source_url", T.StringType()),
                           T.StructField("target_url", T.StringType()), T.StructField("ts", T.TimestampNTZType())])


def tag_and_merge(visits: DataFrame, impressions: DataFrame, key: str = "user") -> DataFrame:
    """Visits and impressions as one keyed stream: ``key, visit STRUCT, impression STRUCT`` (one non-null).

    Extra columns common to both sides (arrival time, sequence, watermark) are kept.
    """
    v_cols = [c for c in visits.columns if c not in (key, "url", "ts", "referer", "is_goal")]
    i_cols = [c for c in impressions.columns if c not in (key, "id", "source_url", "target_url", "ts")]
    v = visits.select(key, F.struct("url", "ts", "referer", "is_goal").alias("visit"), *v_cols)
    i = impressions.select(key, F.struct("id", "source_url", "target_url", "ts").alias("impression"), *i_cols)
    return v.unionByName(i, allowMissingColumns=True)
