"""Streaming forms: the goldens and rules through Structured Streaming, state across micro-batches."""

import time
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

import fixtures
import session_machine
from goldens import GOLDEN
from eventide.functions.timefmt import format_attribution, format_pane
from eventide.operators.panes import pane_ledger
from eventide.plans.catalog import PANE_SPECS
from eventide.sources.tables import EVENT_WATERMARK, arrival_log_from_events, load
from eventide.streaming import (stream_attribution, stream_panes, stream_session_sums, stream_validity_windows,
                                stream_window_sums)


def _run(spark, tmp_path, df, mode="append"):
    name = f"q_{uuid.uuid4().hex[:8]}"
    q = (df.writeStream.format("memory").queryName(name).outputMode(mode)
         .option("checkpointLocation", str(tmp_path / f"ck_{name}")).start())
    q.processAllAvailable()
    q.stop()
    return spark.sql(f"SELECT * FROM {name}")


def _texts(df):
    t = format_pane("w_start", "w_end", "key", "value", "timing", "pane_index", "on_time_index", "is_first", "is_last")
    return Counter(r[0] for r in df.select(t).collect())


def _as_stream(spark, path, log, marks):
    """A file stream with one micro-batch for each watermark step; a step is one row without a key."""
    marks = marks.orderBy("seq").collect()
    after = -1
    for m in marks:
        rows = log.where((F.col("seq") > after) & (F.col("seq") < m.seq)).drop("arrival_ts")
        step = spark.createDataFrame([(m.seq, m.wm_ts)], "seq long, wm_ts timestamp_ntz")
        rows.unionByName(step, allowMissingColumns=True).coalesce(1).write.mode("append").parquet(str(path))
        after = m.seq
        time.sleep(0.02)
    schema = log.drop("arrival_ts").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(path))


@pytest.mark.parametrize("case,wm", [("2-6left", "PERFECT"), ("2-6right", "HEURISTIC")])
def test_stream_watermark_panes(spark, tmp_path, case, wm):
    log, marks = fixtures.score_log(spark, wm, False)
    out = _run(spark, tmp_path, stream_panes(_as_stream(spark, tmp_path / "in", log, marks), "2 minutes"))
    panes = out.where("kind = 'pane'")
    assert _texts(panes) == Counter(GOLDEN[case])
    # Kept and dropped rows together are the input.
    dropped = out.where("kind = 'dropped'")
    total = log.agg(F.sum("score")).first()[0]
    assert panes.agg(F.sum("value")).first()[0] + (dropped.agg(F.sum("value")).first()[0] or 0) == total


def test_stream_late_panes_and_close(spark, tmp_path):
    """Lateness of two minutes: late rows refine the on-time pane, rows after the close come out as dropped."""
    def at(text):
        return F.lit(f"1970-01-01 {text}").cast("timestamp_ntz")
    steps = [(0, "k", 1, "12:00:10", "12:00:00"), (2, "k", 2, "12:00:20", "12:02:30"), (3, "k", 4, "12:01:00", "12:02:30"),
             (5, "k", 8, "12:00:30", "12:04:10")]
    log = spark.createDataFrame(steps, "seq long, key string, score long, e string, w string").select(
        "seq", "key", "score", F.concat(F.lit("1970-01-01 "), "e").cast("timestamp_ntz").alias("event_ts"),
        F.concat(F.lit("1970-01-01 "), "w").cast("timestamp_ntz").alias("wm_ts"), at("12:00:00").alias("arrival_ts"))
    marks = spark.createDataFrame([(1, "12:02:30"), (4, "12:04:10"), (6, "12:30:00")], "seq long, w string").select(
        "seq", F.concat(F.lit("1970-01-01 "), "w").cast("timestamp_ntz").alias("wm_ts"))
    for mode, values in (("accumulating", [1, 3, 7]), ("discarding", [1, 2, 4])):
        out = _run(spark, tmp_path, stream_panes(_as_stream(spark, tmp_path / mode, log, marks), "2 minutes", "2 minutes",
                                                 mode=mode)).collect()
        panes = sorted((r.pane_index, r.on_time_index, r.timing, r.value) for r in out if r.kind == "pane")
        assert panes == [(0, 0, "ON_TIME", values[0]), (1, 1, "LATE", values[1]), (2, 2, "LATE", values[2])]
        assert [(r.value, r.event_ts.strftime("%H:%M:%S")) for r in out if r.kind == "dropped"] == [(8, "12:00:30")]


def test_stream_early_panes_on_the_wall_clock(spark, tmp_path):
    """An early pane comes half a second after the first element, before the watermark gets there."""
    schema = "key string, score long, event_ts timestamp_ntz, wm_ts timestamp_ntz"
    row = spark.createDataFrame([("k", 5)], "key string, score long").select(
        "key", "score", F.lit("1970-01-01 12:00:10").cast("timestamp_ntz").alias("event_ts"),
        F.lit("1970-01-01 12:00:00").cast("timestamp_ntz").alias("wm_ts"))
    src = tmp_path / "in"
    row.write.parquet(str(src))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(src))
    q = (stream_panes(stream, "2 minutes", early_delay="500 milliseconds", poll="300 milliseconds").writeStream
         .format("memory").queryName("early_panes").option("checkpointLocation", str(tmp_path / "ck"))
         .trigger(processingTime="300 milliseconds").start())
    try:
        def panes():
            return [(r.timing, r.value) for r in spark.sql("SELECT * FROM early_panes ORDER BY pane_index").collect()]
        for want in (["EARLY"], ["EARLY", "ON_TIME"]):
            end = time.monotonic() + 60
            while [t for t, _ in panes()] != want and time.monotonic() < end:
                time.sleep(0.3)
            assert panes() == [(t, 5) for t in want]
            step = spark.createDataFrame([(None, None)], "key string, score long").select(
                "key", "score", F.lit(None).cast("timestamp_ntz").alias("event_ts"),
                F.lit("1970-01-01 12:05:00").cast("timestamp_ntz").alias("wm_ts"))
            step.write.mode("append").parquet(str(src))
    finally:
        q.stop()


def test_native_window_sums_append(spark, tmp_path):
    src = tmp_path / "scores"
    batch = fixtures.scores_batch(spark)
    batch.coalesce(1).write.parquet(str(src / "a"))
    # A far-future row moves Spark's watermark past every window, then is filtered out.
    flush = spark.createDataFrame([("Flush", 0)], "key string, score long").withColumn(
        "event_ts", F.lit("1970-01-02 00:00:00").cast("timestamp_ntz"))
    flush.write.parquet(str(src / "b"))
    stream = spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(str(src / "*"))
    out = _run(spark, tmp_path, stream_window_sums(stream, "2 minutes", "0 seconds")).where("key = 'TeamX'")
    got = sorted((r.w_start.strftime("%H:%M"), r.value) for r in out.collect())
    assert got == [("12:00", 14), ("12:02", 18), ("12:04", 4), ("12:06", 12)]


def test_native_sessions_do_not_merge_touching(spark, tmp_path):
    src = tmp_path / "sess"
    rows = spark.createDataFrame([("k", 1, "12:00:00"), ("k", 2, "12:01:00"), ("k", 4, "12:01:59"),
                                  ("z", 0, "23:00:00")], "key string, score long, t string")
    rows.select("key", "score", F.concat(F.lit("1970-01-01 "), "t").cast("timestamp_ntz").alias("event_ts")) \
        .write.parquet(str(src))
    stream = spark.readStream.schema("key string, score long, event_ts timestamp_ntz").parquet(str(src))
    out = _run(spark, tmp_path, stream_session_sums(stream, "1 minute", "0 seconds")).where("key = 'k'")
    got = sorted((r.w_start.strftime("%H:%M:%S"), r.w_end.strftime("%H:%M:%S"), r.value) for r in out.collect())
    assert got == [("12:00:00", "12:01:00", 1), ("12:01:00", "12:02:59", 6)]


def test_ledger_equals_state_machine_on_events(spark):
    """Two independent implementations of early/on-time/late fixed-window panes agree on real data."""
    log = arrival_log_from_events(load(spark, "/root/testdata/sf0.001", "events"))
    spec = PANE_SPECS["accumulating_panes"]
    cols = ["key", "w_start", "w_end", "pane_index", "on_time_index", "timing", "is_first", "is_last", "value",
            "fire_ts"]
    batch = pane_ledger(log, spec, EVENT_WATERMARK).select(*cols)
    machine = session_machine.session_panes(log, None, "10 minutes", spec.lateness, EVENT_WATERMARK, size=spec.size).select(*cols)
    a = sorted(tuple(r) for r in batch.collect())
    b = sorted(tuple(r) for r in machine.collect())
    assert a == b


def test_stream_attribution_golden(spark, tmp_path):
    log, marks = fixtures.attribution_log(spark)
    out = _run(spark, tmp_path, stream_attribution(_as_stream(spark, tmp_path / "in", log, marks)))
    imp = F.struct(F.col("imp_id").alias("id"), "source_url")
    goal = F.struct(F.col("goal_url").alias("url"), F.col("goal_ts").alias("ts"))
    assert Counter(r[0] for r in out.select(format_attribution(imp, F.col("trail"), goal)).collect()) == Counter(
        GOLDEN["attribution"])


def test_native_update_mode_refines_per_micro_batch(spark, tmp_path):
    """Update mode: every micro-batch re-emits the windows it changed (the micro-batch trigger)."""
    src = tmp_path / "upd"
    rows = fixtures.scores_batch(spark)
    early = rows.where(F.col("event_ts") < F.lit("1970-01-01 12:03:00").cast("timestamp_ntz"))
    late = rows.where(F.col("event_ts") >= F.lit("1970-01-01 12:03:00").cast("timestamp_ntz"))
    early.coalesce(1).write.parquet(str(src / "a"))
    late.coalesce(1).write.parquet(str(src / "b"))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(src / "*"))
    out = _run(spark, tmp_path, stream_window_sums(stream, "2 minutes", "1 hour"), mode="update")
    got = sorted((r.w_start.strftime("%H:%M"), r.value) for r in out.collect())
    # W2 is emitted twice: 7 after the first micro-batch, 18 after the second.
    assert got == [("12:00", 14), ("12:02", 7), ("12:02", 18), ("12:04", 4), ("12:06", 12)]


def test_stream_validity_windows_golden(spark, tmp_path):
    log, marks = fixtures.score_log(spark, "PERFECT")
    out = _run(spark, tmp_path, stream_validity_windows(_as_stream(spark, tmp_path / "in", log, marks)))
    last = out.where("kind = 'pane'")
    for name, value in (("pane_index", F.lit(0)), ("on_time_index", F.lit(0)), ("timing", F.lit("ON_TIME")),
                        ("is_first", F.lit(True)), ("is_last", F.lit(True))):
        last = last.withColumn(name, value)
    assert _texts(last) == Counter(GOLDEN["validity"])
    assert out.where("kind = 'dropped'").count() == 0
