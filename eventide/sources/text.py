"""Text line sources and sinks, and the score-line format.

Score line: ``user, team, score, event_time, arrival_time`` separated by commas,
fields padded with blanks or tabs.  A time with a leading ``T`` and no date is on
1970-01-01; otherwise it is a full ISO timestamp.  All times are UTC.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_text(spark: SparkSession, path: str, streaming: bool = False, **options: str) -> DataFrame:
    """Lines of a file, directory or glob as column ``value``."""
    reader = spark.readStream if streaming else spark.read
    return reader.options(**options).text(path)


def write_text(df: DataFrame, path: str, column: str = "value", mode: str = "overwrite") -> None:
    """Write one string column as text files (one part file per partition)."""
    df.select(F.col(column).alias("value")).write.mode(mode).text(path)


def stream_text(df: DataFrame, path: str, checkpoint: str, column: str = "value", shards: int | None = None,
                trigger: dict | None = None):
    """Write one string column of a stream as text files, each line exactly once; the started query.

    Files count once the sink's log in ``path`` names them, and a query that starts again from
    ``checkpoint`` writes only batches that are not named, so readers of the folder see neither
    half batches nor repeated ones.  ``shards``: files a micro-batch.  ``trigger``: arguments of
    ``DataStreamWriter.trigger``.
    """
    lines = df.select(F.col(column).alias("value"))
    if shards:
        lines = lines.repartition(shards)
    writer = lines.writeStream.format("text").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def _strip(c: Column) -> Column:
    # Blank, tab and control characters at both ends, like a Java String.trim.
    return F.regexp_replace(c, r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def _instant(c: Column) -> Column:
    s = _strip(c)
    full = (F.when(s.startswith("T"), F.concat(F.lit("1970-01-01"), s))
            .when(s.rlike(r"^\d{1,2}:\d{2}"), F.concat(F.lit("1970-01-01T"), s))
            .otherwise(s))
    return F.try_to_timestamp(full).cast("timestamp_ntz")


def parse_score_lines(lines: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """(``user, team, score, event_ts, arrival_ts``, rejected lines as ``value``).

    A line goes to the rejects if it has no third field or its score or event time does not
    parse; short and empty lines do not fail the job.
    """
    parts = F.split(F.col(column), ",")
    field = lambda i: _strip(F.get(parts, F.lit(i)))
    parsed = lines.select(
        F.col(column).alias("_line"),
        field(0).alias("user"),
        field(1).alias("team"),
        field(2).try_cast("bigint").alias("score"),
        _instant(F.get(parts, F.lit(3))).alias("event_ts"),
        _instant(F.get(parts, F.lit(4))).alias("arrival_ts"),
    )
    ok = F.col("team").isNotNull() & F.col("score").isNotNull() & F.col("event_ts").isNotNull()
    return parsed.where(ok).drop("_line"), parsed.where(~ok).select(F.col("_line").alias("value"))


def score_lines(scores: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Inverse of ``parse_score_lines`` for rows ``user, team, score, event_ts, arrival_ts``; ``keep`` columns go along."""
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    return scores.select(*keep, F.concat_ws(
        ",\t", F.col("user"), F.col("team"), F.col("score").cast("string"),
        F.date_format("event_ts", iso), F.date_format("arrival_ts", iso)).alias("value"))
