"""Pane ledger: the bounded form of triggered, windowed aggregation.

Input is an arrival log ``key, score, event_ts, arrival_ts, seq, wm_ts`` (``wm_ts``
is the watermark in force when the row arrived) and a watermark timeline that
says when the watermark first reaches a level.  Output is one row per pane:
a numbered, timing-tagged revision of a window's sum.

Rules (per key and fixed window ``[start, end)``):

* a row is *dropped* if ``wm_ts >= end + lateness``; it is *early* if
  ``wm_ts < end`` (it arrived before the on-time firing), else *late*;
* early rows fire under the early trigger (count, aligned or unaligned delay);
  a processing-time deadline equal to an arrival or a watermark step fires first;
* the ON_TIME pane fires at the step where the watermark reaches ``end``; with
  ``on_time='always'`` it fires even when nothing is pending;
* late rows fire under the late trigger; rows still pending when the watermark
  reaches ``end + lateness`` fire in a closing pane;
* ``is_last`` marks the pane fired at the closing step.

Every step is a DataFrame plan: window assignment and drop filters are
projections, pane contents are partial aggregations, numbering and accumulation
are bucketed running sums.  The one sequential rule, the unaligned delay
(``deadline = first element of a pane + delay``), is a chain found by pointer doubling.

A repeated count trigger (``trigger = Trigger.count(n)``) numbers a window's rows over their
whole arrival order, early and late ones together: every n-th row fires a pane, EARLY or
LATE as that row is; rows left over fire when the window closes, ON_TIME if that is also the
on-time step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.functions.timefmt import ceil_to, dur_us, from_us, to_us
from eventide.plans.scan import first_at_or_after, last_at_or_before, running_sums
from eventide.plans.spec import PaneSpec, Trigger
from eventide.session import materialize, materialize_counted

_WKEY = ["key", "w_start"]
_MAX_SUB = 2**62


def assign_windows(log: DataFrame, spec: PaneSpec) -> DataFrame:
    w = F.window("event_ts", spec.size)
    return log.select("key", F.col("score").cast("bigint").alias("score"), "arrival_ts", "seq", "wm_ts",
                      w.start.alias("w_start"), w.end.alias("w_end"))


def split_rows(log: DataFrame, spec: PaneSpec, watermark) -> tuple[DataFrame, DataFrame]:
    """(kept rows with the on-time and closing steps ``on_ts, on_seq, gc_ts, gc_seq``, dropped rows)."""
    L = dur_us(spec.lateness)
    rows = assign_windows(log, spec).withColumn("_end_us", to_us("w_end"))
    late_enough = to_us("wm_ts") >= F.col("_end_us") + F.lit(L)
    kept = rows.where(~late_enough)
    dropped = rows.where(late_enough).drop("_end_us")
    kept = watermark.attach(kept, {"on": F.col("_end_us"), "gc": F.col("_end_us") + F.lit(L)}, log).drop("_end_us")
    return kept, dropped


def _with_delay_starts(rows: DataFrame, delays: dict[bool, int], bucket: str) -> DataFrame:
    """Add ``_start``: first arrival of the row's unaligned-delay pane (NULL where no delay applies).

    Pane k opens at its first element ``s_k`` and holds arrivals in ``[s_k, s_k + delay)``;
    early and late rows of a window are covered apart.  Of a group's distinct arrival times,
    let ``next(a)`` be the first at or after ``a + delay``; pane starts are the chain ``first,
    next(first), next(next(first)), ...``.  ``next`` is a bucketed as-of lookup, the chain is
    found by pointer doubling (``next^(2^k)`` tables), and every row takes the last start at or
    before it.  The work is O(n log P) for P panes per group, spread by time and by
    (group, arrival): no group gathers in one task, at any size.
    """
    span = F.lit(dur_us(bucket))
    delay = F.lit(None).cast("long")
    for flag, d in delays.items():
        delay = F.when(F.col("_g._early") == flag, F.lit(d)).otherwise(delay)
    rows = rows.withColumn("_g", F.struct("key", "w_start", "_early")).withColumn("_a", to_us("arrival_ts"))
    nodes = materialize(rows.where(F.col("_early").isin(list(delays))).select("_g", "_a").distinct())
    asked = nodes.select("_g", (F.col("_a") + delay).alias("_t"), F.lit(0).alias("_k"), F.col("_a").alias("_q"),
                         F.lit(None).cast("long").alias("_v"))
    there = nodes.select("_g", F.col("_a").alias("_t"), F.lit(1).alias("_k"), F.lit(None).cast("long").alias("_q"),
                         F.col("_a").alias("_v"))
    both = asked.unionByName(there).withColumn("_b", F.floor(F.col("_t") / span))
    nxt = first_at_or_after(both, ["_g"], "_t", "_k", "_b", "_v", "_n").where("_k = 0 and _n is not null")
    jump, n = materialize_counted(nxt.select("_g", F.col("_q").alias("_a"), F.col("_n").alias("_to")))
    tables = []
    while n:
        tables.append(jump)
        onward = jump.select("_g", F.col("_a").alias("_to"), F.col("_to").alias("_then"))
        jump, n = materialize_counted(jump.join(onward, ["_g", "_to"]).select("_g", "_a", F.col("_then").alias("_to")))
    starts = nodes.groupBy("_g").agg(F.min("_a").alias("_a"))
    for jump in reversed(tables):
        # Every start found so far leads to a new one 2^k panes on; one plan, each table read once.
        both = F.array_compact(F.array("_a", "_to"))
        starts = starts.join(jump, ["_g", "_a"], "left").select("_g", F.explode(both).alias("_a"))
    marked = nodes.join(starts.withColumn("_s", F.col("_a")), ["_g", "_a"], "left").withColumn(
        "_b", F.floor(F.col("_a") / span))
    filled = last_at_or_before(marked, ["_g"], "_a", "_b", "_s", "_from")
    return rows.join(filled.select("_g", "_a", from_us(F.col("_from")).alias("_start")), ["_g", "_a"], "left").drop("_g", "_a")


def _assign(trig: Trigger | None, limit: str, tag: str) -> tuple[F.Column, F.Column, F.Column]:
    """(fired?, pane time, pane sub-key) of a row under ``trig`` before the step ``limit``.

    Aligned deadlines are read from the staged column ``_d<tag>`` (see ``_stage``).
    """
    if trig is None or trig.kind == "watermark":
        return F.lit(False), F.lit(None).cast("timestamp_ntz"), F.lit(0).cast("long")
    if trig.kind == "count" and trig.n == 1:
        return F.lit(True), F.col("arrival_ts"), F.col("seq")
    if trig.kind == "count":
        return F.lit(True), F.lit(None).cast("timestamp_ntz"), F.floor((F.col("_rn") - 1) / trig.n)
    if trig.kind == "aligned":
        d = F.col(f"_d{tag}")
        exact = d == F.col("arrival_ts")
        fires = (d < F.col(limit)) | ((d == F.col(limit)) & ~exact)
        return fires, d, exact.cast("long")
    if trig.kind == "unaligned":
        fire = F.col(f"_u{tag}")
        return fire <= F.col(limit), fire, F.lit(0).cast("long")
    raise ValueError(f"unknown trigger {trig}")


def _stage(rows: DataFrame, trig: Trigger | None, tag: str) -> DataFrame:
    """Materialize a trigger's per-row deadline once, so later expressions reference a column."""
    if trig is not None and trig.kind == "aligned":
        return rows.withColumn(f"_d{tag}", ceil_to("arrival_ts", trig.period, trig.offset))
    if trig is not None and trig.kind == "unaligned":
        return rows.withColumn(f"_u{tag}", from_us(to_us("_start") + F.lit(dur_us(trig.delay))))
    return rows


def pane_ledger(log: DataFrame, spec: PaneSpec, watermark, with_dropped: bool = False,
                checkpoint_panes: bool = True):
    """All panes of a bounded arrival log under ``spec``; see the module doc for the rules.

    Plan: one projection gives every kept row its pane key (phase, pane time,
    sub-key); rows that fire nothing land in the ON_TIME pane (early rows) or
    the closing pane (late rows).  One aggregation builds the panes (partial
    aggregation first, so a hot key costs one row per map task and pane), and
    one bucketed running sum numbers and accumulates them.
    """
    watermark = watermark.resolve(log)
    kept, dropped = split_rows(log, spec, watermark)
    early_trig = spec.early if spec.trigger.kind == "watermark" else spec.trigger
    late_trig = spec.late_trigger()
    kept = kept.withColumn("_early", F.col("wm_ts") < F.col("w_end"))

    delays = {flag: dur_us(t.delay) for flag, t in ((True, early_trig), (False, late_trig))
              if t is not None and t.kind == "unaligned"}
    if delays:
        kept = _with_delay_starts(kept, delays, spec.bucket)
    else:
        kept = kept.withColumn("_start", F.lit(None).cast("timestamp_ntz"))
    counted = [t for t in (early_trig, late_trig) if t is not None and t.kind == "count" and t.n > 1]
    through = bool(counted) and spec.trigger.kind == "count"
    if counted:
        b = F.floor(to_us("arrival_ts") / F.lit(dur_us(spec.bucket)))
        kept = running_sums(kept.withColumn("_b", b), [*_WKEY] if through else [*_WKEY, "_early"], ["arrival_ts", "seq"],
                            "_b", {"_rn": F.lit(1).cast("long")}).drop("_b")
    else:
        kept = kept.withColumn("_rn", F.lit(0).cast("long"))

    kept = _stage(_stage(kept, early_trig, "e"), late_trig, "l")
    ef, ets, esub = _assign(early_trig, "on_ts", "e")
    lf, lts, lsub = _assign(late_trig, "gc_ts", "l")
    early = F.col("_early")
    kept = kept.withColumn("_fired", F.when(early, ef).otherwise(lf))
    # phase: 0 EARLY fired, 1 ON_TIME, 2 LATE fired, 3 closing
    kept = kept.withColumn("_phase", F.when(early, F.when(F.col("_fired"), 0).otherwise(1))
                           .otherwise(F.when(F.col("_fired"), 2).otherwise(3)))
    if through:
        # One numbering for all rows; a pane's phase is that of the row that fills it.
        kept = kept.withColumn("_phase", F.lit(0))
    phase = F.col("_phase")
    kept = kept.withColumn("_pts", F.when(phase == 0, ets).when(phase == 1, F.col("on_ts"))
                           .when(phase == 2, lts).otherwise(F.col("gc_ts")))
    kept = kept.withColumn("_psub", F.when(phase == 0, esub).when(phase == 2, lsub)
                           .when(phase == 3, F.lit(_MAX_SUB)).otherwise(F.lit(0)).cast("long"))
    own = F.struct(phase.alias("phase"), F.col("_pts").alias("ts"), F.col("_psub").alias("sub"),
                   F.col("score").alias("score"), F.lit(1).cast("long").alias("n"))
    # A fired early row also votes for its window's ON_TIME pane (score 0), so the
    # ON_TIME pane exists even when every early row already fired.
    marker = F.struct(F.lit(1).alias("phase"), F.col("on_ts").alias("ts"), F.lit(0).cast("long").alias("sub"),
                      F.lit(0).cast("bigint").alias("score"), F.lit(0).cast("long").alias("n"))
    entries = F.array(own) if through else F.when(early & F.col("_fired"), F.array(own, marker)).otherwise(F.array(own))
    flat = kept.select(*_WKEY, "w_end", "arrival_ts", "seq", "_early", F.explode(entries).alias("e"))
    panes = (flat.groupBy(*_WKEY, "w_end", F.col("e.phase").alias("phase"), F.col("e.ts").alias("pane_ts"),
                          F.col("e.sub").alias("pane_sub"))
             .agg(F.sum("e.score").alias("delta"), F.sum("e.n").alias("n"),
                  F.max(F.when(F.col("e.n") > 0, F.struct("arrival_ts", "seq", "_early"))).alias("_last")))
    if counted and not through:
        panes = _settle_counts(panes, early_trig, late_trig)
    if spec.resolved_on_time() == "if_non_empty":
        panes = panes.where((F.col("phase") != 1) | (F.col("n") > 0))
    end_us = to_us("w_end")
    panes = watermark.attach(panes, {"on": end_us, "gc": end_us + F.lit(dur_us(spec.lateness))}, log)
    if through:
        full = F.col("n") >= spec.trigger.n
        at_once = (F.col("on_ts") == F.col("gc_ts")) & (F.col("on_seq") == F.col("gc_seq"))
        panes = panes.withColumn("phase", F.when(full & F.col("_last._early"), 0).when(full, 2).when(at_once, 1).otherwise(3))
        panes = panes.withColumn("pane_sub", F.when(F.col("phase") == 3, F.lit(_MAX_SUB)).otherwise(F.lit(0).cast("long")))
    ph = F.col("phase")
    panes = panes.select(
        *_WKEY, "w_end", F.least(ph, F.lit(2)).alias("phase"),
        F.when(ph == 1, F.col("on_ts")).when(ph == 3, F.col("gc_ts"))
        .otherwise(F.coalesce("pane_ts", F.col("_last.arrival_ts"))).alias("fire_ts"),
        F.when(F.col("pane_ts").isNull() & ((ph == 0) | (ph == 2)), F.col("_last.seq"))
        .otherwise(F.col("pane_sub")).alias("sub"),
        "delta", (ph == 3).alias("closing"), "on_ts", "on_seq", "gc_ts", "gc_seq")
    if checkpoint_panes:
        # Numbering reads the panes twice (rows and bucket totals); a reliable
        # checkpoint in the shared folder keeps the work above from running twice.
        panes = materialize(panes)
    result = number_panes(panes, spec)
    return (result, dropped) if with_dropped else result


def number_panes(panes: DataFrame, spec: PaneSpec, window: list[str] = _WKEY, so_far: str | None = None) -> DataFrame:
    """Index, on-time index, first/last flags and the accumulated or discarded value.

    ``so_far``: a column that holds the accumulated value already.

    Panes of a window are ordered by (phase, fire time, sub-key); the running
    counts and sums are bucketed by fire time, which is monotone in that order.
    """
    b = F.floor(to_us("fire_ts") / F.lit(dur_us(spec.bucket)))
    numbered = running_sums(
        panes.withColumn("_b", b), window, ["phase", "fire_ts", "sub"], "_b",
        {"_idx": F.lit(1).cast("long"), "_oti": (F.col("phase") > 0).cast("long"), "_acc": F.col("delta")})
    value = F.col(so_far or "_acc") if spec.mode == "accumulating" else F.col("delta")
    same_step = (F.col("on_ts") == F.col("gc_ts")) & (F.col("on_seq") == F.col("gc_seq"))
    is_last = F.col("closing") | ((F.col("phase") == 1) & same_step)
    return numbered.select(
        "key", "w_start", "w_end",
        (F.col("_idx") - 1).alias("pane_index"),
        F.when(F.col("phase") > 0, F.col("_oti") - 1).alias("on_time_index"),
        F.element_at(F.array(F.lit("EARLY"), F.lit("ON_TIME"), F.lit("LATE")), F.col("phase") + 1).alias("timing"),
        (F.col("_idx") == 1).alias("is_first"),
        is_last.alias("is_last"),
        value.cast("bigint").alias("value"),
        "fire_ts",
    )


def _settle_counts(panes: DataFrame, early_trig, late_trig) -> DataFrame:
    """Count-n panes that never filled up fire with the ON_TIME (early) or closing (late) pane."""
    def n_of(t):
        return t.n if t is not None and t.kind == "count" else 0
    need = F.when(F.col("phase") == 0, F.lit(n_of(early_trig))).when(F.col("phase") == 2, F.lit(n_of(late_trig)))
    short = F.coalesce(need > 1, F.lit(False)) & (F.col("n") < need)
    moved = panes.withColumn("phase", F.when(short, F.col("phase") + 1).otherwise(F.col("phase")))
    odd = (F.col("phase") == 1) | (F.col("phase") == 3)
    moved = (moved.withColumn("pane_sub", F.when(F.col("phase") == 1, F.lit(0)).when(F.col("phase") == 3, F.lit(_MAX_SUB))
                              .otherwise(F.col("pane_sub")))
             .withColumn("pane_ts", F.when(odd, F.lit(None).cast("timestamp_ntz")).otherwise(F.col("pane_ts"))))
    return (moved.groupBy(*_WKEY, "w_end", "phase", "pane_ts", "pane_sub")
            .agg(F.sum("delta").alias("delta"), F.sum("n").alias("n"), F.max("_last").alias("_last")))


def single_panes(df: DataFrame, start: str = "w_start", end: str = "w_end") -> DataFrame:
    """Batch results as the one pane each window gets: ON_TIME, index 0, first and last.

    For the global window pass a frame without window columns; NULL bounds are added.
    """
    out = df
    if start not in df.columns:
        out = out.withColumn(start, F.lit(None).cast("timestamp_ntz"))
    if end not in df.columns:
        out = out.withColumn(end, F.lit(None).cast("timestamp_ntz"))
    return out.select("*", F.lit(0).cast("long").alias("pane_index"), F.lit(0).cast("long").alias("on_time_index"),
                      F.lit("ON_TIME").alias("timing"), F.lit(True).alias("is_first"), F.lit(True).alias("is_last"))
