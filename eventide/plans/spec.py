"""Declarative descriptions of where (window), when (trigger, watermark) and how (mode)."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.functions.timefmt import dur_us, from_us, to_us
from eventide.plans.scan import first_at_or_after

# Far-future watermark value meaning "input complete".
WM_INFINITY = "9999-12-31 00:00:00"


@dataclass(frozen=True)
class Trigger:
    """One trigger.

    kind: ``watermark`` (fire when the watermark passes the window end),
    ``count`` (every ``n`` elements), ``aligned`` (next ``period`` boundary
    shifted by ``offset`` after the first element of a pane), ``unaligned``
    (``delay`` after the first element of a pane).
    """

    kind: str
    n: int = 1
    period: str = "2 minutes"
    offset: str = "0 seconds"
    delay: str = "1 minute"

    @staticmethod
    def watermark() -> "Trigger":
        return Trigger("watermark")

    @staticmethod
    def count(n: int = 1) -> "Trigger":
        return Trigger("count", n=n)

    @staticmethod
    def aligned(period: str, offset: str = "0 seconds") -> "Trigger":
        return Trigger("aligned", period=period, offset=offset)

    @staticmethod
    def unaligned(delay: str) -> "Trigger":
        return Trigger("unaligned", delay=delay)


@dataclass(frozen=True)
class PaneSpec:
    """Fixed windows of ``size`` plus firing rules.

    ``trigger`` is the main trigger: ``watermark`` for the composite
    early/on-time/late form (``early``/``late`` optional), or a repeated
    ``count``/``aligned``/``unaligned`` trigger.  ``on_time``: ``always`` emits
    the pane at the watermark even with nothing new, ``if_non_empty`` only with
    pending data.  ``lateness``: window state is kept until the watermark
    reaches ``end + lateness``; rows arriving later are dropped.
    """

    size: str = "2 minutes"
    trigger: Trigger = field(default_factory=Trigger.watermark)
    early: Trigger | None = None
    late: Trigger | None = None
    lateness: str = "0 seconds"
    mode: str = "accumulating"
    on_time: str | None = None
    bucket: str = "5 minutes"

    def resolved_on_time(self) -> str:
        if self.on_time:
            return self.on_time
        return "if_non_empty" if self.trigger.kind == "count" else "always"

    def late_trigger(self) -> Trigger | None:
        if self.trigger.kind == "watermark":
            # Default late behaviour of a watermark trigger: fire for every late element.
            return self.late if self.late is not None else (Trigger.count(1) if self.early is None else None)
        return self.trigger


@dataclass(frozen=True)
class TickWatermark:
    """Heuristic watermark of a bounded arrival log, in closed form.

    At every ``tick`` of processing time the watermark becomes
    ``floor(t, tick) - lag``; when the input ends (the first tick after the last
    arrival) it jumps to infinity.
    """

    tick: str = "1 hour"
    lag: str = "1 hour"
    # End of input (first tick after the last arrival), once resolved for a log.
    eoi_us: int | None = None

    def resolve(self, log: DataFrame, arrival: str = "arrival_ts") -> "TickWatermark":
        """Pin the end of input with one small aggregation, so plans carry a literal, not N subqueries."""
        if self.eoi_us is not None:
            return self
        last = log.select(F.max(to_us(arrival))).first()[0]
        if last is None:
            return self
        t = dur_us(self.tick)
        return replace(self, eoi_us=int(last - last % t + t))

    def wm_at(self, arrival: Column) -> Column:
        t, lag = dur_us(self.tick), dur_us(self.lag)
        a = to_us(arrival)
        return from_us(a - F.pmod(a, F.lit(t)) - F.lit(lag))

    def end_of_input_us(self, log: DataFrame, arrival: str = "arrival_ts") -> Column:
        """First tick after the last arrival (a literal once resolved, else a scalar subquery)."""
        if self.eoi_us is not None:
            return F.lit(self.eoi_us)
        t = dur_us(self.tick)
        last = log.select(F.max(to_us(arrival))).scalar()
        return last - F.pmod(last, F.lit(t)) + F.lit(t)

    def end_of_input(self, log: DataFrame, arrival: str = "arrival_ts") -> Column:
        return from_us(self.end_of_input_us(log, arrival))

    def fire_us(self, level_us: Column, eoi_us: Column) -> Column:
        """Processing time (us) of the first step at which the watermark reaches ``level_us``."""
        t = dur_us(self.tick)
        x = level_us + F.lit(dur_us(self.lag))
        r = F.pmod(x, F.lit(t))
        return F.least(F.when(r == 0, x).otherwise(x - r + F.lit(t)), eoi_us)

    def attach(self, rows: DataFrame, levels: dict[str, Column], log: DataFrame) -> DataFrame:
        """Add ``<name>_ts``/``<name>_seq`` for each level given in microseconds."""
        eoi = self.end_of_input_us(log)
        out = rows
        for name, lv in levels.items():
            out = out.withColumn(f"{name}_ts", from_us(self.fire_us(lv, eoi))).withColumn(
                f"{name}_seq", F.lit(0).cast("long"))
        return out


@dataclass(frozen=True)
class StepWatermark:
    """Watermark asserted by the source: ``marks(seq, proc_ts, wm_ts)`` in log order.

    Rows of the data log carry the watermark in force when they arrived
    (``wm_ts``).  The marks table holds one row per watermark step, so its size is
    set by the heartbeat rate and the time span, not by data volume.
    """

    marks: DataFrame

    def resolve(self, log: DataFrame) -> "StepWatermark":
        return self

    def attach(self, rows: DataFrame, levels: dict[str, Column], log: DataFrame | None = None) -> DataFrame:
        """Add ``<name>_ts``/``<name>_seq`` for each level given in microseconds."""
        out = rows
        for name, lv in levels.items():
            lv = from_us(lv)
            lv_df = out.select(lv.alias("_level")).distinct()
            fired = _first_step_at_or_above(lv_df, self.marks)
            out = (out.withColumn("_level", lv).join(fired, "_level", "left")
                   .withColumnRenamed("fire_ts", f"{name}_ts").withColumnRenamed("fire_seq", f"{name}_seq")
                   .drop("_level"))
        return out


def _first_step_at_or_above(levels: DataFrame, marks: DataFrame) -> DataFrame:
    """For each level, the earliest mark with ``wm_ts >= level`` (an as-of lookup).

    Watermarks rise with ``seq``, so the earliest mark is the least by ``seq`` among those at
    or above the level: a running minimum per hour of watermark time, carried across hours.
    """
    m = marks.select(F.lit(0).alias("_one"), to_us("wm_ts").alias("_v"), F.lit(1).alias("_kind"),
                     F.struct(F.col("seq").alias("seq"), F.col("proc_ts").alias("ts")).alias("_m"))
    lv = levels.select(F.lit(0).alias("_one"), to_us("_level").alias("_v"), F.lit(0).alias("_kind"),
                       F.lit(None).cast("struct<seq:bigint,ts:timestamp_ntz>").alias("_m"))
    both = lv.unionByName(m).withColumn("_b", F.floor(F.col("_v") / F.lit(dur_us("1 hour"))))
    found = first_at_or_after(both, ["_one"], "_v", "_kind", "_b", "_m", "_next")
    return found.where(F.col("_kind") == 0).select(from_us(F.col("_v")).alias("_level"), F.col("_next.ts").alias("fire_ts"),
                                                   F.col("_next.seq").alias("fire_seq"))
