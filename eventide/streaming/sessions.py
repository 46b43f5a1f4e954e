"""Triggered panes of merging session windows as a live stateful operator.

Per key a map holds the open sessions by their start.  A row's window ``[t, t + gap)`` joins
every session it overlaps; when that changes the bounds, the merged session starts its pane
numbering anew, keeps the earliest deadline of its parts, and fires LATE at once if the
watermark is behind its end no more.  One timer a key is armed, for the first session that is
due; a merge that makes another session the first moves it.  Touched sessions alone are written
back.  Rows whose own window has closed come out with ``kind`` ``dropped``.

Input and triggers as of ``streaming.panes.stream_ledger``; ``spec.size`` is not used.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import astuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from eventide.functions.timefmt import dur_us, to_us
from eventide.plans.spec import PaneSpec
from eventide.streaming.firing import FIELDS, PANE, Firing, Record
from eventide.streaming.watermark import asserted, keyed, observed, original_key, steps

OUT = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("key", T.StringType()), T.StructField("no_key", T.BooleanType()),
    T.StructField("start_us", T.LongType()), T.StructField("end_us", T.LongType()), *PANE, T.StructField("event_us", T.LongType()),
])
_START = T.StructType([T.StructField("start", T.LongType())])
_SESSION = T.StructType([T.StructField("end", T.LongType()), *FIELDS])


class SessionProcessor(StatefulProcessor):
    """One key.  Times in state are microseconds, deadlines and timers milliseconds."""

    def __init__(self, firing: Firing, gap_us: int, poll_ms: int):
        self.firing, self.gap, self.poll = firing, gap_us, poll_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sessions = handle.getMapState("sessions", _START, _SESSION)
        self.timer = handle.getValueState("timer", _START)

    def _load(self) -> None:
        self.open = {k[0]: (v[0], Record(*v[1:])) for k, v in self.sessions.iterator()} if self.sessions.exists() else {}
        self.starts = sorted(self.open)
        self.touched: set[int] = set()

    @staticmethod
    def _end_ms(end_us: int) -> int:
        return -(-end_us // 1000)

    def _due(self, wm: int, now: int) -> list[tuple]:
        """What deadlines and the watermark bring, by start; closed sessions go."""
        out = []
        for start in list(self.starts):
            end, r = self.open[start]
            before = astuple(r)
            out += [(start, end, *p) for p in self.firing.due(r, self._end_ms(end), wm, now)]
            if self.firing.gone(self._end_ms(end), wm):
                del self.open[start]
                self.starts.remove(start)
                self.touched.add(start)
            elif astuple(r) != before:
                self.touched.add(start)
        return out

    def _add(self, t: int, score: int, wm: int, now: int) -> list[tuple]:
        start, end = t, t + self.gap
        at = bisect_left(self.starts, end)
        parts = []
        while at and self.open[self.starts[at - 1]][0] > t:
            at -= 1
            parts.append(self.starts[at])
        start, end = min([start, *parts]), max([end, *(self.open[p][0] for p in parts)])
        if len(parts) == 1 and self.open[parts[0]][0] == end and parts[0] == start:
            r = self.open[start][1]
        else:
            old = [self.open.pop(p)[1] for p in parts]
            self.touched.update(parts)
            self.starts = [s for s in self.starts if s not in parts] if parts else self.starts
            due = [r.deadline for r in old if r.deadline >= 0]
            r = Record(total=sum(o.total for o in old), pending=sum(o.pending for o in old), waiting=sum(o.waiting for o in old),
                       deadline=min(due, default=-1))
            self.firing.opened(r, self._end_ms(end), wm)
            self.open[start] = (end, r)
            insort(self.starts, start)
        self.touched.add(start)
        return [(start, end, *p) for p in self.firing.add(r, score, now)]

    def _store(self, wm: int, now: int, expired: int | None = None) -> None:
        for start in self.touched:
            if start in self.open:
                end, r = self.open[start]
                self.sessions.updateValue((start,), (end, *astuple(r)))
            elif self.sessions.containsKey((start,)):
                self.sessions.removeKey((start,))
        at = self.firing.next_timer([(r, self._end_ms(end)) for end, r in self.open.values()], wm, now, self.poll)
        armed = self.timer.get()[0] if self.timer.exists() else None
        if at is None:
            self.timer.clear()
        elif at != armed or at == expired:
            # Timers that were armed for other times are passed over when they expire.
            self.handle.registerTimer(at)
            self.timer.update((at,))

    def _frame(self, key, rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame([("pane", key[0], key[1], *r, None) for r in rows], columns=OUT.names)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if key[2]:
            return
        wm, now = timerValues.getCurrentWatermarkInMs(), timerValues.getCurrentProcessingTimeInMs()
        self._load()
        out, dropped = self._due(wm, now), []
        for pdf in rows:
            pdf = pdf.sort_values("seq", kind="stable")
            for t, score in zip(pdf["event_us"].astype("int64").tolist(), pdf["score"].astype("int64").tolist(), strict=True):
                if self.firing.gone(self._end_ms(t + self.gap), wm):
                    dropped.append(("dropped", key[0], key[1], t, t + self.gap, None, None, None, None, None, score, t))
                else:
                    out += self._add(t, score, wm, now)
        self._store(wm, now)
        if out:
            yield self._frame(key, out)
        if dropped:
            yield pd.DataFrame(dropped, columns=OUT.names)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at = expiredTimerInfo.getExpiryTimeInMs()
        if not self.timer.exists() or self.timer.get()[0] != at:
            return
        wm, now = timerValues.getCurrentWatermarkInMs(), timerValues.getCurrentProcessingTimeInMs()
        self._load()
        out = self._due(wm, now)
        self._store(wm, now, at)
        if out:
            yield self._frame(key, out)

    def close(self) -> None:
        pass


def stream_session_panes(stream: DataFrame, gap: str, spec: PaneSpec, poll: str = "1 second", delay: str | None = None) -> DataFrame:
    """``kind, key, w_start, w_end, pane_index, on_time_index, timing, is_first, is_last, value, event_ts``."""
    firing = Firing(spec)
    seq = F.col("seq").cast("long") if "seq" in stream.columns else F.lit(0).cast("long")
    stream = asserted(stream) if delay is None else observed(stream, "event_ts", delay)
    rows = stream.select(*keyed("key"), steps().alias("step"), F.col("score").cast("bigint").alias("score"),
                                   to_us("event_ts").alias("event_us"), seq.alias("seq"))
    out = rows.groupBy("key", "no_key", "step").transformWithStateInPandas(
        statefulProcessor=SessionProcessor(firing, dur_us(gap), dur_us(poll) // 1000), outputStructType=OUT, outputMode="Append",
        timeMode="ProcessingTime" if firing.delays else "EventTime")
    at = lambda c: F.timestamp_micros(c).cast("timestamp_ntz")
    return out.select("kind", original_key(), at("start_us").alias("w_start"), at("end_us").alias("w_end"), "pane_index",
                      "on_time_index", "timing", "is_first", "is_last", "value", at("event_us").alias("event_ts"))
