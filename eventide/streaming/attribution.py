"""Conversion attribution as a live stateful operator.

Per user, map states hold the latest visit of each URL (last arrival wins), the first
impression of each (source, target) and the pending goals.  Each goal has an event-time
timer; a goal that arrives behind the watermark is walked at once.  The earliest pending goal
is kept apart, so goals are looked through only when one is due.  The walk follows
referers through the visits until a (referer, url) pair is a known impression.

``consume_impression``: an impression is taken out of the state by the first goal that it
credits.  ``state_ttl``: visits and impressions count for this long after their event time;
each has a timer for that moment, and an index from the moment to the entries that then go, so
nothing else is looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from eventide.functions.timefmt import dur_us, to_us
from eventide.streaming.watermark import asserted, keyed, original_key, steps


def _fields(**kinds) -> T.StructType:
    return T.StructType([T.StructField(n, k) for n, k in kinds.items()])


S, L = T.StringType(), T.LongType()
OUT = _fields(user=S, no_key=T.BooleanType(), goal_url=S, goal_us=L, imp_id=L, source_url=S, target_url=S, imp_us=L,
              trail=T.ArrayType(_fields(url=S, us=L, referer=S)))


class AttributionProcessor(StatefulProcessor):
    def __init__(self, consume: bool, ttl_us: int | None):
        self.consume, self.ttl = consume, ttl_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.visits = handle.getMapState("visits", _fields(url=S), _fields(us=L, referer=S))
        self.impressions = handle.getMapState("impressions", _fields(source=S, target=S), _fields(id=L, us=L))
        self.goals = handle.getMapState("goals", _fields(us=L, url=S), _fields(referer=S))
        self.earliest = handle.getValueState("earliest", _fields(us=L))
        self.expiring = handle.getMapState("expiring", _fields(ms=L), _fields(entries=T.ArrayType(_fields(a=S, b=S, visit=T.BooleanType()))))

    def _live(self, us: int, at: int) -> bool:
        return self.ttl is None or us + self.ttl >= at

    def _walk(self, user: tuple, us: int, url: str, referer: str | None, fire: int) -> list[tuple]:
        trail, here, back, seen = [], url, referer, {url}
        while back is not None:
            pair = (back, here)
            if self.impressions.containsKey(pair) and self._live((imp := self.impressions.getValue(pair))[1], fire):
                if self.consume:
                    self.impressions.removeKey(pair)
                return [(*user, url, us, imp[0], back, here, imp[1], trail[::-1])]
            if back in seen or not self.visits.containsKey((back,)):
                return []
            at, further = self.visits.getValue((back,))
            if not self._live(at, fire):
                return []
            trail.append((back, at, further))
            seen.add(back)
            here, back = back, further
        return []

    def _fire(self, user: tuple, wm_us: int) -> list[tuple]:
        """Goals that the watermark has reached, earliest first."""
        if not self.earliest.exists() or self.earliest.get()[0] > wm_us:
            return []
        out, goals = [], sorted(self.goals.keys())
        for us, url in goals:
            if us > wm_us:
                self.earliest.update((us,))
                return out
            out += self._walk(user, us, url, self.goals.getValue((us, url))[0], us)
            self.goals.removeKey((us, url))
        self.earliest.clear()
        return out

    def _expire_at(self, us: int, a: str | None, b: str | None, visit: bool, wm_us: int) -> None:
        """Arm the timer at which an entry of event time ``us`` has outlived its time."""
        if self.ttl is None:
            return
        ms = max((us + self.ttl) // 1000 + 1, wm_us // 1000 + 1)
        entries = self.expiring.getValue((ms,))[0] if self.expiring.containsKey((ms,)) else []
        if not entries:
            self.handle.registerTimer(ms)
        self.expiring.updateValue((ms,), ([*entries, (a, b, visit)],))

    def _expire(self, ms: int, wm_us: int) -> None:
        """The entries whose time is up; those that a later visit has replaced have a later timer."""
        if self.ttl is None or not self.expiring.containsKey((ms,)):
            return
        for a, b, visit in self.expiring.getValue((ms,))[0]:
            state, key, at = (self.visits, (a,), 0) if visit else (self.impressions, (a, b), 1)
            if state.containsKey(key) and state.getValue(key)[at] + self.ttl < wm_us:
                state.removeKey(key)
        self.expiring.removeKey((ms,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if key[2]:
            return
        user, wm_us = key[:2], timerValues.getCurrentWatermarkInMs() * 1000
        out = self._fire(user, wm_us)
        arrived = pd.concat(list(rows), ignore_index=True).sort_values("seq", kind="stable").astype(object)
        arrived = arrived.where(arrived.notna(), None)
        for r in arrived.itertuples(index=False):
            if r.source is not None or r.id is not None:
                if not self.impressions.containsKey((r.source, r.url)):
                    self.impressions.updateValue((r.source, r.url), (int(r.id), int(r.us)))
                    self._expire_at(int(r.us), r.source, r.url, False, wm_us)
            elif not r.is_goal:
                self.visits.updateValue((r.url,), (int(r.us), r.referer))
                self._expire_at(int(r.us), r.url, None, True, wm_us)
            elif r.us <= wm_us:
                out += self._walk(user, int(r.us), r.url, r.referer, wm_us)
            elif not self.goals.containsKey((int(r.us), r.url)):
                self.goals.updateValue((int(r.us), r.url), (r.referer,))
                if not self.earliest.exists() or r.us < self.earliest.get()[0]:
                    self.earliest.update((int(r.us),))
                self.handle.registerTimer(-(-int(r.us) // 1000))
        if out:
            yield pd.DataFrame(out, columns=OUT.names)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        wm_us = timerValues.getCurrentWatermarkInMs() * 1000
        out = self._fire(key[:2], wm_us)
        self._expire(expiredTimerInfo.getExpiryTimeInMs(), wm_us)
        if out:
            yield pd.DataFrame(out, columns=OUT.names)

    def close(self) -> None:
        pass


def stream_attribution(stream: DataFrame, consume_impression: bool = False, state_ttl: str | None = None) -> DataFrame:
    """``user, goal_url, goal_ts, imp_id, source_url, target_url, imp_ts, trail`` from ``user, seq, visit, impression, wm_ts``."""
    rows = asserted(stream).select(
        *keyed("user"), steps("visit", "impression").alias("step"), "seq", F.coalesce("visit.url", "impression.target_url").alias("url"), F.coalesce(
            to_us("visit.ts"), to_us("impression.ts")).alias("us"), F.col("visit.referer").alias("referer"),
        F.coalesce("visit.is_goal", F.lit(False)).alias("is_goal"), F.col("impression.source_url").alias("source"),
        F.col("impression.id").alias("id"))
    out = rows.groupBy("user", "no_key", "step").transformWithStateInPandas(
        statefulProcessor=AttributionProcessor(consume_impression, None if state_ttl is None else dur_us(state_ttl)),
        outputStructType=OUT, outputMode="Append", timeMode="EventTime")
    at = lambda c: F.timestamp_micros(c).cast("timestamp_ntz")
    return out.select(original_key("user"), "goal_url", at(F.col("goal_us")).alias("goal_ts"), "imp_id", "source_url", "target_url",
                      at(F.col("imp_us")).alias("imp_ts"), F.transform("trail", lambda v: F.struct(
                          v["url"].alias("url"), at(v["us"]).alias("ts"), v["referer"].alias("referer"))).alias("trail"))
