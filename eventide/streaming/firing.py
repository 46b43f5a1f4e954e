"""When a live window fires: the trigger rules of ``PaneSpec`` for one window's small record.

Fixed and session windows keep one such record a window and share these rules.  A record is a
plain tuple in state (``FIELDS``); ``Firing`` moves it on by rows, by the watermark and by the
wall clock, and gives the panes that are due.

Early rows fire under the early trigger, late ones under the late trigger; count, unaligned and
aligned delays work in both phases, each pane arming its own deadline.  ON_TIME fires once, when
the watermark reaches the window's end, for windows that had rows by then.  Rows still pending
when the window closes fire in a last pane.  A repeated count trigger (``trigger =
Trigger.count(n)``) counts through the on-time step: full panes are EARLY or LATE as their last
row is, and what is left fires at the close, ON_TIME if the watermark reaches the end only then.
A deadline that has come fires before a watermark step seen at the same time.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import types as T

from eventide.functions.timefmt import dur_us
from eventide.plans.spec import PaneSpec, Trigger


@dataclass
class Record:
    """Sum so far; unfired sum and rows; panes, and those of them ON_TIME or LATE; whether the end is behind; deadline or -1."""

    total: int = 0
    pending: int = 0
    waiting: int = 0
    index: int = 0
    on_time: int = 0
    behind: int = 0
    deadline: int = -1


FIELDS = [T.StructField(f.name, T.LongType()) for f in fields(Record)]
PANE = [T.StructField("pane_index", T.LongType()), T.StructField("on_time_index", T.LongType()),
        T.StructField("timing", T.StringType()), T.StructField("is_first", T.BooleanType()),
        T.StructField("is_last", T.BooleanType()), T.StructField("value", T.LongType())]


class Firing:
    def __init__(self, spec: PaneSpec):
        composite = spec.trigger.kind == "watermark"
        self.early = spec.early if composite else spec.trigger
        self.late = spec.late_trigger()
        self.through = spec.trigger.kind == "count"
        self.always = spec.resolved_on_time() == "always"
        self.accumulating = spec.mode == "accumulating"
        self.lateness = dur_us(spec.lateness) // 1000

    @property
    def delays(self) -> bool:
        """Whether any trigger needs the wall clock."""
        return any(t is not None and t.kind in ("unaligned", "aligned") for t in (self.early, self.late))

    def _pane(self, r: Record, timing: str, last: bool) -> tuple:
        row = (r.index, None if timing == "EARLY" else r.on_time, timing, r.index == 0, last,
               r.total if self.accumulating else r.pending)
        r.index += 1
        r.on_time += timing != "EARLY"
        r.pending = r.waiting = 0
        r.deadline = -1
        return row

    def due(self, r: Record, end: int, wm: int, now: int) -> list[tuple]:
        """The panes that deadline, watermark and close bring, in order."""
        panes = []
        if 0 <= r.deadline <= now and r.waiting:
            panes.append(self._pane(r, "LATE" if r.behind else "EARLY", False))
        closing = wm >= end + self.lateness
        if not r.behind and wm >= end:
            r.behind = 1
            if closing if self.through else True:
                if r.waiting or (self.always and not self.through):
                    panes.append(self._pane(r, "ON_TIME", closing))
            if not self.through:
                r.deadline = -1
        if closing and r.waiting:
            panes.append(self._pane(r, "LATE", True))
        return panes

    def opened(self, r: Record, end: int, wm: int) -> None:
        """A window whose first row comes behind the watermark has no ON_TIME pane."""
        r.behind = int(wm >= end)

    def add(self, r: Record, score: int, now: int) -> list[tuple]:
        """One row; the panes that it fills."""
        r.total += score
        r.pending += score
        r.waiting += 1
        trigger = self.late if r.behind else self.early
        if trigger is None or trigger.kind == "watermark":
            return []
        if trigger.kind == "count":
            return [self._pane(r, "LATE" if r.behind else "EARLY", False)] if r.waiting >= trigger.n else []
        if r.deadline < 0:
            r.deadline = self._deadline(trigger, now)
        return []

    @staticmethod
    def _deadline(trigger: Trigger, now: int) -> int:
        if trigger.kind == "unaligned":
            return now + dur_us(trigger.delay) // 1000
        period, offset = dur_us(trigger.period) // 1000, dur_us(trigger.offset) // 1000
        return now + (offset - now) % period

    def gone(self, end: int, wm: int) -> bool:
        return wm >= end + self.lateness

    def next_timer(self, records: list[tuple[Record, int]], wm: int, now: int, poll: int) -> int | None:
        """When the first of the (record, end) must be looked at again, on the clock in use."""
        if not records:
            return None
        if self.delays:
            return max(min([now + poll, *(r.deadline for r, _ in records if r.deadline >= 0)]), now + 1)
        return min(end if wm < end else end + self.lateness for _, end in records)
