"""Golden inputs: the team-score batch, the scripted arrival log and the visit/impression log.

Fixed values: these rows, times and steps must equal the published examples.
Times are on 1970-01-01, UTC.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from eventide.sources.arrival import IMPRESSION, VISIT

INFINITY = dt.datetime(9999, 12, 31)


def at(hms: str | None, date: dt.date = dt.date(1970, 1, 1)) -> dt.datetime:
    """'HH:mm:ss' on 1970-01-01; None means the end of time (watermark infinity)."""
    if hms is None:
        return INFINITY
    h, m, s = (int(x) for x in hms.split(":"))
    return dt.datetime(date.year, date.month, date.day, h, m, s)


def arrival_log_from_steps(spark: SparkSession, steps: Iterable[Sequence], data_fields: Sequence[T.StructField],
                           start_clock: str = "12:00:00") -> tuple[DataFrame, DataFrame]:
    """Build ``(log, marks)`` from steps ``('p', time)``, ``('w', time|None)`` and ``('e', *values)``.

    ``log`` has ``seq, arrival_ts, wm_ts`` followed by ``data_fields``; ``marks``
    has ``seq, proc_ts, wm_ts``.  Clock and watermark start at ``start_clock``.
    """
    clock = wm = at(start_clock)
    rows, marks = [], []
    for seq, step in enumerate(steps):
        kind = step[0]
        if kind == "p":
            clock = at(step[1])
        elif kind == "w":
            wm = at(step[1])
            marks.append((seq, clock, wm))
        elif kind == "e":
            rows.append((seq, clock, wm, *step[1:]))
        else:
            raise ValueError(f"unknown step {step!r}")
    log_schema = T.StructType([T.StructField("seq", T.LongType()), T.StructField("arrival_ts", T.TimestampNTZType()),
                               T.StructField("wm_ts", T.TimestampNTZType()), *data_fields])
    mark_schema = T.StructType([T.StructField("seq", T.LongType()), T.StructField("proc_ts", T.TimestampNTZType()),
                                T.StructField("wm_ts", T.TimestampNTZType())])
    return spark.createDataFrame(rows, log_schema), spark.createDataFrame(marks, mark_schema)


# Team-score batch (team, score, event time).
SCORES_BATCH = [
    ("TeamX", 5, "12:00:26"), ("TeamX", 7, "12:02:26"), ("TeamX", 3, "12:03:39"),
    ("TeamX", 4, "12:04:19"), ("TeamX", 8, "12:03:06"), ("TeamX", 3, "12:06:39"),
    ("TeamX", 9, "12:01:26"), ("TeamX", 8, "12:07:26"), ("TeamX", 1, "12:07:46"),
]

SCORE_FIELDS = [T.StructField("key", T.StringType()), T.StructField("score", T.LongType()),
                T.StructField("event_ts", T.TimestampNTZType())]


def scores_batch(spark):
    return spark.createDataFrame([(k, s, at(t)) for k, s, t in SCORES_BATCH],
                                 T.StructType(SCORE_FIELDS))


# The scripted score stream.  Each row: the variants it belongs to (B batch, P perfect, H heuristic
# watermark, 6 the extra element), then a clock step ("p"), a watermark step ("w") or an element ("e", score, time).
SCORE_STEPS = [
    ("BPH", "w", "12:00:00"), ("BPH", "p", "12:04:59"), ("BPH", "e", 5, "12:00:26"), ("BPH", "p", "12:05:39"),
    ("BPH", "e", 7, "12:02:24"), ("BPH", "p", "12:06:00"), ("H", "w", "12:02:00"), ("BPH", "p", "12:06:13"),
    ("BPH", "e", 3, "12:03:39"), ("BPH", "p", "12:06:39"), ("BPH", "e", 4, "12:04:19"), ("6", "e", 6, "12:00:53"),
    ("BPH", "p", "12:07:06"), ("BPH", "e", 8, "12:03:06"), ("BPH", "p", "12:07:19"), ("BPH", "e", 3, "12:06:39"),
    ("BPH", "p", "12:07:30"), ("H", "w", "12:04:00"), ("H", "p", "12:07:40"), ("H", "w", "12:06:00"),
    ("BPH", "p", "12:08:19"), ("BPH", "e", 9, "12:01:25"), ("BPH", "p", "12:08:39"), ("P", "w", "12:02:00"),
    ("BPH", "e", 8, "12:07:26"), ("BPH", "p", "12:09:00"), ("BPH", "e", 1, "12:07:46"), ("P", "w", "12:04:00"),
    ("P", "p", "12:09:10"), ("P", "w", "12:06:00"), ("P", "p", "12:09:20"), ("P", "w", "12:08:00"),
    ("BPH", "p", "12:09:30"), ("H", "w", "12:08:30"), ("BPH", "p", "12:10:00"), ("BPH", "w", None),
]


def score_steps(watermark: str = "BATCH", extra_six: bool = False) -> list[tuple]:
    """The steps of a variant (BATCH, PERFECT or HEURISTIC), elements under one key."""
    wanted = {watermark[0]} | ({"6"} if extra_six else set())
    steps = [step[1:] for step in SCORE_STEPS if wanted & set(step[0])]
    return [("e", "TeamX", s[1], at(s[2])) if s[0] == "e" else s for s in steps]


def score_log(spark, watermark: str = "BATCH", extra_six: bool = False):
    """(log, marks) for the scripted score stream."""
    return arrival_log_from_steps(spark, score_steps(watermark, extra_six), SCORE_FIELDS)


def _visit(url, t, ref, goal=False):
    return ("v", (url, at(t), ref, goal))


def _imp(i, src, dst, t):
    return ("i", (i, src, dst, at(t)))


# One user's visits and impressions, in event-time order.
SIGNUP_IMPRESSION = _imp(123, "http://search.com?q=xyz", "http://xyz.com/", "12:01:00")
SIGNUP_VISIT = _visit("http://xyz.com/", "12:01:10", "http://search.com?q=xyz")
SIGNUP_GOAL = _visit("http://xyz.com/join-mailing-list", "12:01:30", "http://xyz.com/", True)
SHOPPING_IMPRESSION = _imp(456, "http://search.com?q=thing", "http://xyz.com/thing", "12:02:00")
SHOPPING_IMPRESSION_DUP = _imp(789, "http://search.com?q=thing", "http://xyz.com/thing", "12:02:10")
SHOPPING_VISIT1 = _visit("http://xyz.com/thing", "12:02:30", "http://search.com?q=thing")
SHOPPING_VISIT2 = _visit("http://xyz.com/thing/add-to-cart", "12:03:00", "http://xyz.com/thing")
SHOPPING_VISIT3 = _visit("http://xyz.com/thing/purchase", "12:03:20", "http://xyz.com/thing/add-to-cart")
SHOPPING_GOAL = _visit("http://xyz.com/thing/receipt", "12:03:45", "http://xyz.com/thing/purchase", True)
UNATTRIBUTED_IMPRESSION = _imp(0, "http://search.com?q=thing", "http://xyz.com/other-thing", "12:04:00")
UNATTRIBUTED_VISIT = _visit("http://xyz.com/other-thing", "12:04:20", "http://search.com?q=other thing")

# Arrival order, with watermark steps.
ATTRIBUTION_STEPS = [
    ("w", "12:00:00"), SHOPPING_VISIT2, SHOPPING_GOAL, SHOPPING_VISIT3, SIGNUP_GOAL,
    ("w", "12:00:30"), SIGNUP_IMPRESSION, ("w", "12:01:00"), SHOPPING_IMPRESSION, SIGNUP_VISIT,
    ("w", "12:01:30"), SHOPPING_IMPRESSION_DUP, SHOPPING_VISIT1, ("w", "12:03:45"),
    UNATTRIBUTED_IMPRESSION, ("w", "12:04:00"), UNATTRIBUTED_VISIT, ("w", None),
]

ATTRIBUTION_FIELDS = [T.StructField("user", T.StringType()), T.StructField("visit", VISIT),
                      T.StructField("impression", IMPRESSION)]


def attribution_log(spark, user: str = "UserX"):
    """(log, marks): ``seq, arrival_ts, wm_ts, user, visit, impression``."""
    steps = []
    for st in ATTRIBUTION_STEPS:
        if st[0] == "v":
            steps.append(("e", user, st[1], None))
        elif st[0] == "i":
            steps.append(("e", user, None, st[1]))
        else:
            steps.append(st)
    return arrival_log_from_steps(spark, steps, ATTRIBUTION_FIELDS)
