"""Triggered panes of fixed windows as a live stateful operator.

State is one small record for each (key, window), so a hot key is spread over its windows; it
goes when the watermark reaches the window's end plus the allowed lateness.  Without delays the
on-time pane and the close are event-time timers.  With an aligned or unaligned delay the
operator runs on processing-time timers instead, at the pending pane's deadline or the next
look at the watermark, whichever is first; one timer is armed at a time.

Rows that arrive after the close are not dropped silently: they come out with ``kind``
``dropped``; panes have ``kind`` ``pane``.  Input: ``key, score, event_ts, wm_ts`` (see
``streaming.watermark``) and, where the order of rows in a micro-batch matters, ``seq``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import astuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from eventide.functions.timefmt import dur_us, to_us
from eventide.plans.spec import PaneSpec, Trigger
from eventide.streaming.firing import FIELDS, PANE, Firing, Record
from eventide.streaming.watermark import asserted, keyed, observed, original_key, steps

OUT = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("key", T.StringType()), T.StructField("no_key", T.BooleanType()),
    T.StructField("start_us", T.LongType()), *PANE, T.StructField("event_us", T.LongType()),
])


class PaneProcessor(StatefulProcessor):
    """One (key, window)."""

    def __init__(self, firing: Firing, size_ms: int, poll_ms: int):
        self.firing, self.size, self.poll = firing, size_ms, poll_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("window", T.StructType([*FIELDS, T.StructField("timer", T.LongType())]))

    def _frame(self, key, panes: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame([("pane", key[0], key[1], int(key[2]), *p, None) for p in panes], columns=OUT.names)

    def _keep(self, r: Record, timer: int, end: int, wm: int, now: int) -> None:
        """Store the record with its next timer, or let it go."""
        if self.firing.gone(end, wm):
            self.state.clear()
            return
        at = self.firing.next_timer([(r, end)], wm, now, self.poll)
        if timer < 0 or at < timer or timer <= (now if self.firing.delays else wm):
            self.handle.registerTimer(at)
            timer = at
        self.state.update((*astuple(r), timer))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if key[3]:
            return
        wm, now = timerValues.getCurrentWatermarkInMs(), timerValues.getCurrentProcessingTimeInMs()
        end, known = int(key[2]) // 1000 + self.size, self.state.exists()
        *kept, timer = self.state.get() if known else (*astuple(Record()), -1)
        r, panes = Record(*kept), []
        if known:
            panes += self.firing.due(r, end, wm, now)
        else:
            self.firing.opened(r, end, wm)
        if self.firing.gone(end, wm):
            for pdf in rows:
                yield pd.DataFrame({"kind": "dropped", "key": key[0], "no_key": key[1], "start_us": int(key[2]), "pane_index": None,
                                    "on_time_index": None, "timing": None, "is_first": None, "is_last": None,
                                    "value": pdf["score"].astype("Int64"), "event_us": pdf["event_us"].astype("Int64")},
                                   columns=OUT.names)
        else:
            known = True
            for pdf in rows:
                for score in pdf.sort_values("seq", kind="stable")["score"].astype("int64").tolist():
                    panes += self.firing.add(r, score, now)
        if known:
            self._keep(r, timer, end, wm, now)
        if panes:
            yield self._frame(key, panes)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.state.exists():
            return
        *kept, timer = self.state.get()
        if expiredTimerInfo.getExpiryTimeInMs() != timer:
            return  # an earlier one has been armed since
        wm, now, end = timerValues.getCurrentWatermarkInMs(), timerValues.getCurrentProcessingTimeInMs(), int(key[2]) // 1000 + self.size
        r = Record(*kept)
        panes = self.firing.due(r, end, wm, now)
        self._keep(r, -1, end, wm, now)
        if panes:
            yield self._frame(key, panes)

    def close(self) -> None:
        pass


def stream_ledger(stream: DataFrame, spec: PaneSpec, poll: str = "1 second", delay: str | None = None) -> DataFrame:
    """The panes of ``spec`` over a stream: every trigger of ``operators.panes.pane_ledger``, live.

    ``kind, key, w_start, w_end, pane_index, on_time_index, timing, is_first, is_last, value, event_ts``;
    of a dropped row, ``value`` is the score.  Delays run on the wall clock; ``poll`` is how often
    an open window looks at the watermark then.  The watermark is asserted by column ``wm_ts``; with
    ``delay`` it is the greatest event time seen less that delay.
    """
    span, firing = dur_us(spec.size), Firing(spec)
    start = F.floor(to_us("event_ts") / F.lit(span)) * span
    seq = F.col("seq").cast("long") if "seq" in stream.columns else F.lit(0).cast("long")
    stream = asserted(stream) if delay is None else observed(stream, "event_ts", delay)
    rows = stream.select(
        *keyed("key"), F.coalesce(start, F.lit(0)).cast("long").alias("start_us"), steps().alias("step"), F.col("score").cast(
            "bigint").alias("score"), to_us("event_ts").alias("event_us"), seq.alias("seq"))
    out = rows.groupBy("key", "no_key", "start_us", "step").transformWithStateInPandas(
        statefulProcessor=PaneProcessor(firing, span // 1000, dur_us(poll) // 1000), outputStructType=OUT, outputMode="Append",
        timeMode="ProcessingTime" if firing.delays else "EventTime")
    at = lambda c: F.timestamp_micros(c).cast("timestamp_ntz")
    return out.select("kind", original_key(), at(F.col("start_us")).alias("w_start"), at(F.col("start_us") + span).alias("w_end"),
                      "pane_index", "on_time_index", "timing", "is_first", "is_last", "value",
                      at(F.col("event_us")).alias("event_ts"))


def stream_panes(stream: DataFrame, size: str, lateness: str = "0 seconds", early_delay: str | None = None,
                 mode: str = "accumulating", poll: str = "1 second") -> DataFrame:
    """Early (a wall-clock delay after a pane's first element), on-time and late (every element) panes; see ``stream_ledger``."""
    early = None if early_delay is None else Trigger.unaligned(early_delay)
    return stream_ledger(stream, PaneSpec(size=size, early=early, late=Trigger.count(1), lateness=lateness, mode=mode), poll)
