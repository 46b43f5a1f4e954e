"""Whole-pipeline goldens: formatted panes compared as multisets, order ignored."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import fixtures
from goldens import ALIGNED_OURS, GOLDEN, SCORE_CSV
from eventide.functions.timefmt import format_attribution, format_pane, format_time, parse_time
from eventide.operators.aggregate import fixed_window_sum, sum_per_key
from eventide.operators.attribution import attribute, attribution_records
from eventide.operators.panes import pane_ledger, single_panes
from eventide.operators.windows import validity_windows
from eventide.plans.spec import PaneSpec, StepWatermark, Trigger
from eventide.sources.text import parse_score_lines, scan_text

def texts(df):
    text = format_pane("w_start", "w_end", "key", "value", "timing", "pane_index", "on_time_index", "is_first",
                       "is_last")
    return Counter(r[0] for r in df.select(text).collect())


def ledger(spark, watermark, spec, extra=False):
    log, marks = fixtures.score_log(spark, watermark, extra)
    return texts(pane_ledger(log, spec, StepWatermark(marks)))


EARLY_LATE = dict(early=Trigger.unaligned("1 minute"), late=Trigger.count(1))
LONG = "1000 days"
CASES = {
    "2-3": ("BATCH", PaneSpec(trigger=Trigger.count(1), lateness=LONG), False),
    "2-5": ("BATCH", PaneSpec(trigger=Trigger.unaligned("2 minutes"), lateness=LONG), False),
    "2-6left": ("PERFECT", PaneSpec(), False),
    "2-6right": ("HEURISTIC", PaneSpec(), False),
    "2-7left": ("PERFECT", PaneSpec(lateness=LONG, **EARLY_LATE), False),
    "2-7right": ("HEURISTIC", PaneSpec(lateness=LONG, **EARLY_LATE), False),
    "2-8": ("HEURISTIC", PaneSpec(lateness="2 minutes", **EARLY_LATE), True),
    "2-9": ("HEURISTIC", PaneSpec(lateness=LONG, mode="discarding", **EARLY_LATE), False),
}


@pytest.mark.parametrize("case", sorted(CASES))
def test_pane_goldens(spark, case):
    wm, spec, extra = CASES[case]
    assert ledger(spark, wm, spec, extra) == Counter(GOLDEN[case])


def test_aligned_delay(spark):
    # Boundaries every 2 minutes through 12:05:00, i.e. at odd minutes.
    spec = PaneSpec(trigger=Trigger.aligned("2 minutes", "1 minute"), lateness=LONG)
    assert ledger(spark, "BATCH", spec) == Counter(ALIGNED_OURS)


def test_unwindowed_batch(spark):
    out = single_panes(sum_per_key(fixtures.scores_batch(spark)))
    assert texts(out) == Counter(GOLDEN["2-1"])


def test_windowed_batch(spark):
    out = single_panes(fixed_window_sum(fixtures.scores_batch(spark), "2 minutes"))
    assert texts(out) == Counter(GOLDEN["2-2"])


def test_validity_windows(spark):
    log, _ = fixtures.score_log(spark, "PERFECT")
    out = single_panes(validity_windows(log))
    assert texts(out) == Counter(GOLDEN["validity"])


def test_attribution(spark):
    log, _ = fixtures.attribution_log(spark)
    visits = log.where("visit IS NOT NULL").select("user", "visit.*", "arrival_ts", "seq", "wm_ts")
    imps = log.where("impression IS NOT NULL").select("user", "impression.*", "arrival_ts", "seq", "wm_ts")
    rec = attribution_records(attribute(visits, imps))
    got = Counter(r[0] for r in rec.select(format_attribution("impression", "trail", "goal")).collect())
    assert got == Counter(GOLDEN["attribution"])


def test_time_round_trip(spark):
    row = spark.range(1).select(format_time(parse_time(F.lit("12:34:56"))).alias("t")).first()
    assert row.t == "12:34:56"


def test_score_csv_batch_job(spark, tmp_path):
    p = tmp_path / "inputs.csv"
    p.write_text(SCORE_CSV)
    parsed, rejects = parse_score_lines(scan_text(spark, str(p)))
    assert rejects.count() == 0
    out = single_panes(sum_per_key(parsed.withColumnRenamed("team", "key")))
    assert texts(out) == Counter(GOLDEN["2-1"])


def test_bad_score_lines_are_rejected(spark, tmp_path):
    p = tmp_path / "bad.csv"
    p.write_text("a, TeamX, notanumber, T12:00:00, 12:01:00\nb, TeamX, 4, T12:00:10, 12:01:00\n")
    good, bad = parse_score_lines(scan_text(spark, str(p)))
    assert good.count() == 1 and bad.count() == 1


def test_team_scores_job(spark, tmp_path):
    from eventide.plans.jobs import team_scores_job
    p = tmp_path / "inputs.csv"
    p.write_text(SCORE_CSV)
    rejects = team_scores_job(spark, str(p), str(tmp_path / "out"))
    assert rejects.count() == 0
    got = Counter(r.value for r in spark.read.text(str(tmp_path / "out")).collect())
    assert got == Counter(GOLDEN["2-1"])
