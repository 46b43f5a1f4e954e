"""Merging session windows: the published golden, and consistency with the batch session sum."""

import random
from collections import Counter
from functools import partial

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import fixtures
import session_machine
from goldens import GOLDEN
from eventide.functions.timefmt import format_pane
from eventide.operators import session_panes as sessions
from eventide.operators.session_panes import session_panes
from eventide.operators.windows import session_sum
from eventide.plans.catalog import SESSION_PANES
from eventide.plans.spec import StepWatermark, TickWatermark
from eventide.sources.tables import EVENT_WATERMARK, arrival_log_from_events, load

SF = "/root/testdata/sf0.001"


def test_session_golden(spark):
    log, marks = fixtures.score_log(spark, "HEURISTIC")
    p = session_panes(log, "1 minute", "1 minute", "1000 days", StepWatermark(marks))
    text = format_pane("w_start", "w_end", "key", "value", "timing", "pane_index", "on_time_index", "is_first",
                       "is_last")
    assert Counter(r[0] for r in p.select(text).collect()) == Counter(GOLDEN["4-3"])


def test_final_sessions_equal_batch_sessions(spark):
    log = arrival_log_from_events(load(spark, SF, "events"))
    panes = session_panes(log, watermark=EVENT_WATERMARK, **SESSION_PANES)
    last = (panes.withColumn("_r", F.row_number().over(
        Window.partitionBy("key", "w_start", "w_end").orderBy(F.desc("pane_index"))))
        .where("_r = 1").select("key", "w_start", "w_end", "value"))
    # Windows later merged into a larger one are not final.
    inner = last.alias("a").join(
        last.alias("b"),
        (F.col("a.key") == F.col("b.key")) & (F.col("b.w_start") <= F.col("a.w_start"))
        & (F.col("a.w_end") <= F.col("b.w_end"))
        & ((F.col("b.w_start") < F.col("a.w_start")) | (F.col("a.w_end") < F.col("b.w_end"))), "left_semi")
    final = last.subtract(inner)
    expected = session_sum(log, SESSION_PANES["gap"])
    got = sorted(tuple(r) for r in final.collect())
    want = sorted(tuple(r) for r in expected.collect())
    assert got == want


def test_no_session_overlaps_in_final_panes(spark):
    log = arrival_log_from_events(load(spark, SF, "events"))
    s = session_sum(log, SESSION_PANES["gap"])
    w = Window.partitionBy("key").orderBy("w_start")
    bad = s.withColumn("_next", F.lead("w_start").over(w)).where(F.col("_next") < F.col("w_end"))
    assert bad.count() == 0


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _both(log, watermark=EVENT_WATERMARK, **how):
    """The plan's panes and those of the row-by-row machine."""
    return _rows(session_panes(log, watermark=watermark, **how)), _rows(session_machine.session_panes(
        log, watermark=watermark, split="key", **how))


def test_equal_to_the_machine_on_events(spark):
    log = arrival_log_from_events(load(spark, SF, "events"))
    plan, machine = _both(log, **SESSION_PANES)
    assert plan == machine and {r[5] for r in plan} == {"EARLY", "ON_TIME", "LATE"}


def test_no_rows_no_panes(spark):
    log = arrival_log_from_events(load(spark, SF, "events"))
    for rows in (log.where("false"), log.withColumn("wm_ts", F.lit("2100-01-01 00:00:00").cast("timestamp_ntz"))):
        panes, dropped = session_panes(rows, watermark=EVENT_WATERMARK, with_dropped=True, **SESSION_PANES)
        assert panes.count() == 0 and dropped.count() == rows.count()


def _random_log(spark, seed, n, span, lag, keys=("a", "b", None)):
    """Arrivals up to ``lag`` seconds late, many at equal times; the hourly heuristic watermark's rules at one minute."""
    rng = random.Random(seed)
    rows = []
    for seq in range(n):
        t = rng.randrange(span)
        rows.append((rng.choice(keys), rng.randrange(-5, 50), seq, t, t + int(lag * rng.random() ** 3)))
    at = lambda c: F.timestamp_seconds(F.lit(1_704_067_200) + F.col(c)).cast("timestamp_ntz")
    df = spark.createDataFrame(rows, "key string, score long, seq long, t long, a long").select(
        "key", "score", "seq", at("t").alias("event_ts"), at("a").alias("arrival_ts"))
    return df.withColumn("wm_ts", FAST.wm_at(F.col("arrival_ts")))


FAST = TickWatermark(tick="1 minute", lag="2 minutes")


@pytest.mark.parametrize("seed,n,span,lag,how", [
    (1, 700, 9000, 1500, dict(gap="1 minute", early_delay="90 seconds", lateness="3 minutes")),
    (2, 700, 40000, 1500, dict(gap="100 seconds", early_delay="2 minutes", lateness="0 seconds")),
    (3, 1500, 3000, 600, dict(gap="5 seconds", early_delay="20 seconds", lateness="30 seconds", mode="discarding")),
    (4, 900, 9000, 4000, dict(gap="2 minutes", early_delay=None, lateness="10 minutes", mode="discarding")),
    (5, 900, 9000, 4000, dict(gap="1 minute", early_delay="30 minutes", lateness="100 minutes")),
])
def test_equal_to_the_machine_on_random_logs(spark, seed, n, span, lag, how):
    """Merges, sessions closed before their neighbours come, ties, late bridges; a third of the rows has no key."""
    log = _random_log(spark, seed, n, span, lag)
    plan, machine = _both(log, watermark=FAST, **how)
    assert plan == machine and any(r[0] is None for r in plan)


def test_short_stretches_settle_alike(spark, monkeypatch):
    """Stretches shorter than the delay, few rounds: widening ends at the same panes."""
    log = _random_log(spark, 6, 600, 4000, 900, keys=("a", None))
    how = dict(gap="20 seconds", early_delay="45 seconds", lateness="2 minutes")
    want = _rows(session_panes(log, watermark=FAST, **how))
    monkeypatch.setattr(sessions, "ROUNDS", 1)
    monkeypatch.setattr(sessions, "WIDER", 3)
    monkeypatch.setattr(sessions, "_settled", partial(_narrow, sessions._settled))
    assert _rows(session_panes(log, watermark=FAST, **how)) == want


def _narrow(settled, rows, delay, width):
    return settled(rows, delay, 20_000_000)


def test_dropped_and_kept_rows_are_the_input(spark):
    log = _random_log(spark, 7, 500, 9000, 1500)
    panes, dropped = session_panes(log, watermark=FAST, gap="1 minute", early_delay="1 minute", lateness="1 minute", mode="discarding",
                                   with_dropped=True)
    assert dropped.count() > 0
    assert panes.agg(F.sum("value")).first()[0] + dropped.agg(F.sum("score")).first()[0] == log.agg(F.sum("score")).first()[0]


def test_one_key_spreads_over_tasks(spark):
    """One unbroken session of one key: its deadlines are settled in many stretches."""
    log = _random_log(spark, 8, 400, 60_000, 600, keys=("a",))
    seen = []
    old = sessions._run_stretches
    try:
        sessions._run_stretches = lambda ordered, *a: (seen.append(ordered.select("stretch").distinct().count()), old(ordered, *a))[1]
        session_panes(log, watermark=FAST, gap="20 minutes", early_delay="1 minute", lateness="1 hour").count()
    finally:
        sessions._run_stretches = old
    assert seen[0] >= 4


def test_dense_session_settles_in_few_rounds(spark, monkeypatch):
    """Deadlines that never forget how a stretch began: what stretches leave is foretold, not passed on one stretch a round."""
    log = _random_log(spark, 9, 6000, 160_000, 600, keys=("a",))
    rounds, old = [], sessions._run_stretches
    monkeypatch.setattr(sessions, "_run_stretches", lambda ordered, *a: (rounds.append(1), old(ordered, *a))[1])
    plan, machine = _both(log, watermark=FAST, gap="20 minutes", early_delay="14 minutes", lateness="1 hour")
    assert plan == machine and len(rounds) <= 3
