"""Brute force for session panes: a state machine per key that replays the log row by row.

Sessions merge when a new element's ``[t, t + gap)`` overlaps them; a merge that changes a
window's bounds starts a new window whose pane numbering restarts; a merged window already
behind the watermark fires LATE at once.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.functions.timefmt import dur_us, from_us, to_us

INF = np.iinfo(np.int64).max

PANE_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()), T.StructField("w_start", T.TimestampNTZType()),
    T.StructField("w_end", T.TimestampNTZType()), T.StructField("pane_index", T.LongType()),
    T.StructField("on_time_index", T.LongType()), T.StructField("timing", T.StringType()),
    T.StructField("is_first", T.BooleanType()), T.StructField("is_last", T.BooleanType()),
    T.StructField("value", T.LongType()), T.StructField("fire_ts", T.TimestampNTZType()),
])


@dataclass
class Session:
    start: int
    end: int
    total: int = 0
    pending: int = 0
    n_pending: int = 0
    deadline: int | None = None
    index: int = 0
    on_time_index: int = 0
    on_time_done: bool = False


@dataclass
class SessionPaneMachine:
    """Early (unaligned delay) / on-time / late (every element) panes for one key.

    Windows are sessions of ``gap`` or, with ``fixed_size``, tumbling windows
    (whose proto-windows only ever coincide, so nothing merges).  All times are
    microseconds; emitted panes collect in ``out``.  The state is plain data so
    the streaming processor can persist it between micro-batches.
    """

    gap: int
    early_delay: int | None
    lateness: int
    accumulating: bool = True
    fixed_size: int | None = None
    # Early rule: every element (per-record trigger) instead of a delay.
    early_count: bool = False
    # Late rule: None fires every late element at once; a delay fires it that long after the first.
    late_delay: int | None = None
    # ON_TIME pane even with nothing pending (watermark and delay triggers) or only with data (count trigger).
    on_time_always: bool = True
    sessions: list[Session] = field(default_factory=list)
    wm: int = -INF
    out: list = field(default_factory=list)

    def _emit(self, s: Session, timing: str, now: int, is_last: bool = False) -> None:
        value = s.total if self.accumulating else s.pending
        oti = None if timing == "EARLY" else s.on_time_index
        self.out.append((s.start, s.end, s.index, oti, timing, s.index == 0, is_last, value, now))
        s.index += 1
        if timing != "EARLY":
            s.on_time_index += 1
        s.pending, s.n_pending, s.deadline = 0, 0, None

    def advance_clock(self, now: int) -> None:
        """Processing time moves to ``now``: early deadlines at or before it fire, earliest first."""
        due = sorted((s for s in self.sessions if s.deadline is not None and s.deadline <= now),
                     key=lambda s: (s.deadline, s.start))
        for s in due:
            self._emit(s, "LATE" if s.on_time_done else "EARLY", s.deadline)

    def advance_watermark(self, wm: int, now: int) -> None:
        self.wm = max(self.wm, wm)
        keep = []
        for s in sorted(self.sessions, key=lambda s: s.start):
            closing = self.wm >= s.end + self.lateness if self.wm < INF else True
            if not s.on_time_done and self.wm >= s.end:
                s.on_time_done = True
                if self.on_time_always or s.n_pending > 0:
                    self._emit(s, "ON_TIME", now, is_last=closing)
                else:
                    s.deadline = None
            elif closing and s.n_pending > 0:
                self._emit(s, "LATE", now, is_last=True)
            if not closing:
                keep.append(s)
        self.sessions = keep

    def add(self, t: int, score: int, now: int) -> bool:
        """One element with event time ``t``; False if it was dropped as too late."""
        if self.fixed_size:
            lo = t - (t % self.fixed_size)
            hi = lo + self.fixed_size
        else:
            lo, hi = t, t + self.gap
        if self.wm < INF and hi + self.lateness <= self.wm:
            return False
        parts = [s for s in self.sessions if s.start < hi and lo < s.end]
        if len(parts) == 1 and parts[0].start <= lo and hi <= parts[0].end:
            s = parts[0]
        else:
            start = min([lo] + [p.start for p in parts])
            end = max([hi] + [p.end for p in parts])
            pend = [p.deadline for p in parts if p.deadline is not None]
            s = Session(start, end, total=sum(p.total for p in parts), pending=sum(p.pending for p in parts),
                        n_pending=sum(p.n_pending for p in parts), deadline=min(pend) if pend else None)
            if len(parts) == 1 and (parts[0].start, parts[0].end) == (start, end):
                s = parts[0]
            else:
                self.sessions = [x for x in self.sessions if x not in parts] + [s]
        s.total += score
        s.pending += score
        s.n_pending += 1
        if self.wm >= s.end:
            s.on_time_done = True
            if self.late_delay is None:
                self._emit(s, "LATE", now)
            elif s.deadline is None:
                s.deadline = now + self.late_delay
        elif self.early_count:
            self._emit(s, "EARLY", now)
        elif self.early_delay is not None and s.deadline is None:
            s.deadline = now + self.early_delay
        return True


def _steps_per_group(rows: DataFrame, marks: DataFrame, level: F.Column) -> DataFrame:
    """Each group's watermark steps, as rows: those after its first row, to the one that closes its last window.

    A range join on ``seq``: a group's span is cut into blocks of ``_BLOCK`` positions, and
    steps meet it block by block.
    """
    from eventide.plans.spec import _first_step_at_or_above

    groups = rows.groupBy("key", "_sid").agg(F.min("seq").alias("lo"), F.max(level).alias("level"))
    closed = _first_step_at_or_above(groups.select(from_us(F.col("level")).alias("_level")).distinct(), marks)
    spans = groups.withColumn("_level", from_us(F.col("level"))).join(closed, "_level", "left").select(
        "key", "_sid", "lo", "fire_seq")
    last = marks.agg(F.max("seq").alias("last"))
    spans = spans.join(F.broadcast(last)).select("key", "_sid", "lo", F.coalesce("fire_seq", "last").alias("hi"))
    block = lambda c: F.floor(F.col(c) / _BLOCK)
    spans = spans.where("hi >= lo").select("*", F.explode(F.sequence(block("lo"), block("hi"))).alias("_k"))
    m = marks.select(F.col("seq").alias("m_seq"), to_us("proc_ts").alias("a"), to_us("wm_ts").alias("w"),
                     block("seq").alias("_k"))
    return spans.join(m, "_k").where("m_seq > lo and m_seq <= hi").select(
        "key", "_sid", F.col("m_seq").alias("seq"), F.lit(None).cast("long").alias("t"), F.lit(None).cast("long").alias(
            "score"), "a", "w")


def session_panes(log: DataFrame, gap: str | None, early_delay: str | None, lateness: str, watermark,
                  mode: str = "accumulating", size: str | None = None, split: str = "session") -> DataFrame:
    """Panes of merging session windows for an arrival log ``key, score, event_ts, arrival_ts, seq, wm_ts``.

    ``watermark`` is a ``StepWatermark``, whose steps join the groups they concern as rows, or
    a ``TickWatermark`` (steps generated in closed form; input ends at the first tick after the
    last arrival).
    """
    from eventide.plans.spec import StepWatermark, TickWatermark

    log.sparkSession.sparkContext.addPyFile(__file__)
    g, L = (dur_us(gap) if gap else 0), dur_us(lateness)
    fixed = dur_us(size) if size else None
    d = dur_us(early_delay) if early_delay else None
    acc = mode == "accumulating"
    tick = lag = None
    rows = log.select("key", F.col("score").cast("long").alias("score"), "event_ts", "seq",
                      to_us("event_ts").alias("t"), to_us("arrival_ts").alias("a"), to_us("wm_ts").alias("w"))
    if gap and split == "session":
        # Windows never cross the final sessions of all rows (a merge joins only
        # overlapping proto-windows), so each final session is an independent
        # machine: a hot key is spread over its sessions.
        from eventide.operators.windows import session_ids
        rows = session_ids(rows, gap, "key", "event_ts", "seq")
    else:
        rows = rows.withColumn("_sid", F.lit(0).cast("long"))
    rows = rows.select("key", "_sid", "seq", "t", "score", "a", "w")
    if isinstance(watermark, StepWatermark):
        end = F.col("t") + F.lit(g) if not fixed else F.col("t") - F.pmod("t", F.lit(fixed)) + F.lit(fixed)
        rows = rows.unionByName(_steps_per_group(rows, watermark.marks, end + F.lit(L)))
        order, eoi = ["seq"], None
    elif isinstance(watermark, TickWatermark):
        tick, lag = dur_us(watermark.tick), dur_us(watermark.lag)
        order, eoi = ["a", "seq"], watermark.resolve(log).eoi_us
    else:
        raise TypeError(watermark)

    def run(batches):
        m = None
        key = None
        last_tick = None

        def flush():
            if m is None:
                return
            if tick:
                t = last_tick
                while t + tick < eoi:
                    t += tick
                    m.advance_clock(t)
                    m.advance_watermark(t - lag, t)
                m.advance_clock(eoi)
                m.advance_watermark(INF, eoi)
            yield from _frame(key, m.out)
            m.out.clear()

        for pdf in batches:
            for k0, sid, t, sc, a, w in zip(pdf["key"], pdf["_sid"], pdf["t"], pdf["score"], pdf["a"], pdf["w"]):
                k, a, w = (k0, int(sid)), int(a), int(w)
                if k != key:
                    yield from flush()
                    m, key, last_tick = SessionPaneMachine(g, d, L, acc, fixed), k, None
                    m.wm = w
                if tick:
                    cur = (a // tick) * tick
                    if last_tick is None:
                        last_tick = cur
                        m.advance_clock(cur)
                        m.advance_watermark(cur - lag, cur)
                    while last_tick < cur:
                        last_tick += tick
                        m.advance_clock(last_tick)
                        m.advance_watermark(last_tick - lag, last_tick)
                m.advance_clock(a)
                if pd.isna(t):
                    m.advance_watermark(INF if w >= _FAR else w, a)
                else:
                    m.add(int(t), int(sc), a)
                if len(m.out) > 10_000:
                    yield from _frame(key, m.out)
                    m.out.clear()
        yield from flush()

    ordered = rows.repartition("key", "_sid").sortWithinPartitions("key", "_sid", *order)
    return ordered.mapInPandas(run, PANE_SCHEMA)


_BLOCK = 1024
_FAR = 253_370_764_800_000_000  # 9999-01-01 in microseconds: watermark values at or beyond mean infinity


def _frame(key, out):
    if not out:
        return
    if isinstance(key, tuple):
        key = key[0]
    arr = list(zip(*out))
    yield pd.DataFrame({
        "key": [key] * len(out),
        "w_start": pd.to_datetime(np.array(arr[0], dtype="int64"), unit="us"),
        "w_end": pd.to_datetime(np.array(arr[1], dtype="int64"), unit="us"),
        "pane_index": np.array(arr[2], dtype="int64"),
        "on_time_index": pd.array(arr[3], dtype="Int64"),
        "timing": list(arr[4]),
        "is_first": np.array(arr[5], dtype=bool),
        "is_last": np.array(arr[6], dtype=bool),
        "value": np.array(arr[7], dtype="int64"),
        "fire_ts": pd.to_datetime(np.array(arr[8], dtype="int64"), unit="us"),
    })
