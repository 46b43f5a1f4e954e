"""Invariants of the pane ledger on real events (all sizes behave alike; sf0.001 keeps tests fast)."""

import datetime as dt
import time

from pyspark.sql import Window
from pyspark.sql import functions as F

from eventide.functions.timefmt import dur_us
from eventide.operators.panes import _with_delay_starts, pane_ledger, split_rows
from eventide.operators.windows import session_sum, validity_windows
from eventide.plans.catalog import PANE_SPECS
from eventide.plans.spec import PaneSpec, Trigger
from eventide.sources.tables import EVENT_WATERMARK, arrival_log_from_events, load

SF = "/root/testdata/sf0.001"


def _log(spark):
    return arrival_log_from_events(load(spark, SF, "events"))


def test_discarding_panes_sum_to_last_accumulating(spark):
    log = _log(spark)
    acc = pane_ledger(log, PANE_SPECS["accumulating_panes"], EVENT_WATERMARK)
    dis = pane_ledger(log, PANE_SPECS["discarding_panes"], EVENT_WATERMARK)
    last = (acc.withColumn("_r", F.row_number().over(Window.partitionBy("key", "w_start").orderBy(F.desc("pane_index"))))
            .where("_r = 1").select("key", "w_start", F.col("value").alias("acc")))
    total = dis.groupBy("key", "w_start").agg(F.sum("value").alias("dis"))
    bad = last.join(total, ["key", "w_start"], "full").where(~F.col("acc").eqNullSafe(F.col("dis")))
    assert bad.count() == 0


def test_kept_plus_dropped_is_input(spark):
    log = _log(spark)
    for spec in (PANE_SPECS["on_time_panes"], PANE_SPECS["accumulating_panes"], PaneSpec(size="1 hour")):
        kept, dropped = split_rows(log, spec, EVENT_WATERMARK)
        assert kept.count() + dropped.count() == log.count()


def test_pane_numbering_is_dense_and_on_time_index_rises(spark):
    p = pane_ledger(_log(spark), PANE_SPECS["early_on_time_late"], EVENT_WATERMARK)
    w = Window.partitionBy("key", "w_start").orderBy("pane_index")
    chk = p.select("*", F.lag("pane_index").over(w).alias("pi"), F.lag("on_time_index").over(w).alias("po"),
                   F.lag("timing").over(w).alias("pt"))
    assert chk.where(F.col("pi").isNotNull() & (F.col("pane_index") != F.col("pi") + 1)).count() == 0
    assert chk.where(F.col("po").isNotNull() & (F.col("on_time_index") != F.col("po") + 1)).count() == 0
    # EARLY panes never follow ON_TIME/LATE ones, and only the first pane is first.
    assert chk.where((F.col("timing") == "EARLY") & (F.col("pt") != "EARLY")).count() == 0
    assert p.where(F.col("is_first") != (F.col("pane_index") == 0)).count() == 0
    assert p.groupBy("key", "w_start").agg(F.sum(F.col("timing").eqNullSafe("ON_TIME").cast("int")).alias("n")) \
        .where("n > 1").count() == 0


def test_validity_windows_tile_the_timeline(spark):
    log = _log(spark)
    v = validity_windows(log)
    w = Window.partitionBy("key").orderBy("w_start")
    nxt = v.select("*", F.lead("w_start").over(w).alias("n"))
    assert nxt.where(F.col("n").isNotNull() & (F.col("w_end") != F.col("n"))).count() == 0
    assert nxt.where(F.col("n").isNull() & F.col("w_end").isNotNull()).count() == 0
    assert v.agg(F.sum("value")).first()[0] == log.agg(F.sum("score")).first()[0]


def test_delay_panes_match_a_plain_scan(spark):
    """The pointer-doubling cover against a loop over each window's arrivals; ``seq`` numbers rows per key only."""
    log = _log(spark)
    per_key = Window.partitionBy("key").orderBy("arrival_ts", "seq")
    log = log.withColumn("seq", F.row_number().over(per_key).cast("long"))
    spec = PANE_SPECS["unaligned_delay_panes"]
    kept, _ = split_rows(log, spec, EVENT_WATERMARK.resolve(log))
    kept = kept.withColumn("_early", F.col("wm_ts") < F.col("w_end"))
    got = {}
    for r in _with_delay_starts(kept, {True: dur_us("10 minutes"), False: dur_us("10 minutes")}, "5 minutes").collect():
        got.setdefault((r.key, r.w_start, r._early), []).append((r.arrival_ts, r.seq, r._start))
    for rows in got.values():
        start = None
        for at, _, given in sorted(rows):
            if start is None or at >= start + dt.timedelta(minutes=10):
                start = at
            assert given == start
    panes = pane_ledger(log, spec, EVENT_WATERMARK)
    again = pane_ledger(_log(spark), spec, EVENT_WATERMARK)
    assert sorted(tuple(r) for r in panes.collect()) == sorted(tuple(r) for r in again.collect())


def test_many_rows_in_one_bucket(spark):
    """200,000 arrivals of one window within one carry bucket: passes are linear, so this takes seconds."""
    n = 200_000
    at = F.timestamp_micros(F.lit(1_704_067_200_000_000) + F.col("id") * 1000).cast("timestamp_ntz")
    log = spark.range(n).select(F.lit("k").alias("key"), F.lit(1).cast("long").alias("score"), at.alias("event_ts"),
                                at.alias("arrival_ts"), F.col("id").alias("seq"),
                                EVENT_WATERMARK.wm_at(at).alias("wm_ts"))
    began = time.monotonic()
    panes = pane_ledger(log, PaneSpec(size="1 hour", trigger=Trigger.unaligned("20 seconds")), EVENT_WATERMARK).collect()
    assert [r.value for r in sorted(panes, key=lambda r: r.pane_index)][:10] == [20_000 * (k + 1) for k in range(10)]
    assert time.monotonic() - began < 60


def test_count_panes_run_over_early_and_late_rows(spark):
    """Two early rows and a late one fill one pane of three, fired by the late row."""
    def t(hm):
        return dt.datetime(2024, 1, 1, *map(int, hm.split(":")))
    rows = [("k", 1, t("00:10"), t("00:20"), 1, t("00:00")), ("k", 2, t("00:15"), t("00:25"), 2, t("00:00")),
            ("k", 4, t("00:30"), t("02:30"), 3, t("01:00")), ("k", 8, t("00:40"), t("02:40"), 4, t("01:00"))]
    log = spark.createDataFrame(rows, "key string, score long, event_ts timestamp_ntz, arrival_ts timestamp_ntz, seq long, "
                                "wm_ts timestamp_ntz")
    p = pane_ledger(log, PaneSpec(size="1 hour", trigger=Trigger.count(3), lateness="3 hours"), EVENT_WATERMARK)
    got = [(r.timing, r.value, r.is_last, r.fire_ts) for r in sorted(p.collect(), key=lambda r: r.pane_index)]
    assert got == [("LATE", 7, False, t("02:30")), ("LATE", 15, True, t("03:00"))]


def test_one_scan_per_plan(spark):
    log = _log(spark)
    for df in (session_sum(log, "30 minutes"), validity_windows(log)):
        text = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(
            "simple"))
        assert text.count("FileScan") == 1
