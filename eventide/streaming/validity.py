"""Validity windows as live stateful operators.

A value at X is valid over ``[X, next X)``; that window comes out when the watermark reaches
``next``, the newest one with an open end when the input is complete.  Two operators share the
work of a key.  The first keeps the times of one (key, bucket) of event time, so a hot key is
spread over its buckets: it puts out the windows inside the bucket, and tells the second where
the bucket's first time lies, once the watermark is there, and its last one, once the bucket is
behind the watermark.  The second keeps one row a key, the last time still open, and closes it
at the first time of the next bucket that has any.

A row that would split a window that is out, or whose bucket is behind the watermark, comes out
with ``kind`` ``dropped``.  Input: ``key, score, event_ts, wm_ts`` (see ``streaming.watermark``).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from eventide.functions.timefmt import dur_us, to_us
from eventide.streaming.watermark import COMPLETE_MS, asserted, keyed, original_key, steps

_FIELDS = [T.StructField("kind", T.StringType()), T.StructField("key", T.StringType()), T.StructField("no_key", T.BooleanType())]
_BOUNDS = [T.StructField("start_us", T.LongType()), T.StructField("end_us", T.LongType()), T.StructField("value", T.LongType())]
#: What the first operator passes on: rows on the way out by their bucket, edges by key; ``at`` is ahead of the watermark.
PASSED = T.StructType([*_FIELDS, T.StructField("route", T.LongType()), *_BOUNDS, T.StructField("at", T.TimestampType())])
OUT = T.StructType([*_FIELDS, *_BOUNDS])
#: The route of edges.
EDGES = -(1 << 62)
_TIME = T.StructType([T.StructField("us", T.LongType())])
_SUM = T.StructType([T.StructField("value", T.LongType())])


class BucketProcessor(StatefulProcessor):
    """One (key, bucket): the sums of its times that are not out yet, and up to where it is out."""

    def __init__(self, width_us: int):
        self.width = width_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sums = handle.getMapState("sums", _TIME, _SUM)
        self.out_to = handle.getValueState("out_to", _TIME)

    def _emit(self, key, wm_us: int) -> list[tuple]:
        """What the watermark lets out, in order of time: the first edge, windows, and at the bucket's end the last edge."""
        if not self.sums.exists():
            return []
        out, bucket = [], int(key[2])
        times = sorted(k[0] for k in self.sums.keys())
        if not self.out_to.exists():
            if times[0] > wm_us:
                return []
            out.append(("first", *key[:2], EDGES, times[0], None, None))
        done = wm_us >= bucket + self.width
        reached = times[0]
        for x, after in zip(times, [*times[1:], None], strict=True):
            if after is None and done:
                out.append(("last", *key[:2], EDGES, x, None, self.sums.getValue((x,))[0]))
            elif after is not None and after <= wm_us:
                out.append(("pane", *key[:2], bucket, x, after, self.sums.getValue((x,))[0]))
                reached = after
            else:
                break
            self.sums.removeKey((x,))
        if done:
            self.out_to.clear()
        else:
            self.out_to.update((reached,))
        return out

    def _frame(self, rows: list[tuple], wm_ms: int) -> pd.DataFrame:
        at = pd.Timestamp(wm_ms + 1000, unit="ms")
        return pd.DataFrame([(*r, at) for r in rows], columns=PASSED.names).astype(
            {"start_us": "Int64", "end_us": "Int64", "value": "Int64"})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if key[3]:
            return
        wm, bucket = timerValues.getCurrentWatermarkInMs(), int(key[2])
        out = self._emit(key, wm * 1000)
        closed = wm * 1000 >= bucket + self.width
        done = self.out_to.get()[0] if self.out_to.exists() else None
        for pdf in rows:
            late = pd.Series(closed, index=pdf.index) if closed or done is None else pdf["us"] < done
            out += [("dropped", *key[:2], bucket, int(u), None, int(s)) for u, s in zip(pdf["us"][late], pdf["score"][late], strict=True)]
            for us, value in pdf[~late].groupby("us")["score"].sum().items():
                at = (int(us),)
                old = self.sums.getValue(at)[0] if self.sums.containsKey(at) else 0
                self.sums.updateValue(at, (old + int(value),))
                if us > wm * 1000:
                    self.handle.registerTimer(-(-int(us) // 1000))
        out += self._emit(key, wm * 1000)
        if not closed:
            self.handle.registerTimer(-(-(bucket + self.width) // 1000))
        if out:
            yield self._frame(out, wm)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        wm = timerValues.getCurrentWatermarkInMs()
        out = self._emit(key, wm * 1000)
        if out:
            yield self._frame(out, wm)

    def close(self) -> None:
        pass


class EdgeProcessor(StatefulProcessor):
    """One key's edges; rows of other routes pass through."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", T.StructType([T.StructField("us", T.LongType()), T.StructField("value", T.LongType())]))

    def _frame(self, rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=OUT.names).astype({"start_us": "Int64", "end_us": "Int64", "value": "Int64"})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if int(key[2]) != EDGES:
            for pdf in rows:
                yield self._frame(list(pdf[OUT.names].itertuples(index=False, name=None)))
            return
        # "first" sorts before "last": a bucket's only time opens after it has closed the one before.
        edges = pd.concat(list(rows), ignore_index=True).sort_values(["start_us", "kind"])
        out = []
        for kind, us, value in zip(edges["kind"], edges["start_us"], edges["value"], strict=True):
            if kind == "last":
                self.open.update((int(us), int(value)))
            elif self.open.exists():
                start, held = self.open.get()
                out.append(("pane", *key[:2], start, int(us), held))
                self.open.clear()
        if timerValues.getCurrentWatermarkInMs() >= COMPLETE_MS:
            out += self._final(key)
        else:
            self.handle.registerTimer(COMPLETE_MS)
        if out:
            yield self._frame(out)

    def _final(self, key) -> list[tuple]:
        if not self.open.exists():
            return []
        start, held = self.open.get()
        self.open.clear()
        return [("pane", *key[:2], start, None, held)]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        out = self._final(key)
        if out:
            yield self._frame(out)

    def close(self) -> None:
        pass


def stream_validity_windows(stream: DataFrame, bucket: str = "1 hour") -> DataFrame:
    """``kind, key, w_start, w_end, value``; of a dropped row, ``w_start`` is its time and ``value`` its score."""
    width = dur_us(bucket)
    us = to_us("event_ts")
    rows = asserted(stream).select(
        *keyed("key"), F.coalesce(F.floor(us / F.lit(width)) * width, F.lit(0)).cast("long").alias("bucket"), steps().alias("step"),
        us.alias("us"), F.col("score").cast("bigint").alias("score"))
    passed = rows.groupBy("key", "no_key", "bucket", "step").transformWithStateInPandas(
        statefulProcessor=BucketProcessor(width), outputStructType=PASSED, outputMode="Append", timeMode="EventTime", eventTimeColumnName="at")
    out = passed.groupBy("key", "no_key", "route").transformWithStateInPandas(
        statefulProcessor=EdgeProcessor(), outputStructType=OUT, outputMode="Append", timeMode="EventTime")
    at = lambda c: F.timestamp_micros(c).cast("timestamp_ntz")
    return out.select("kind", original_key(), at("start_us").alias("w_start"), at("end_us").alias("w_end"), "value")
