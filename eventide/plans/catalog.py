"""Registered queries over the driver's tables, and their DuckDB oracles.

Every query reads the given parquet tables (mostly ``events``) in full.  The
score stream is ``key = event_type, score = value in cents``; the arrival log
adds a deterministic arrival lag and the hourly heuristic watermark
(``eventide.sources.tables``).  Visits and impressions come from consecutive
events of one user: a ``signup`` is an impression (search page -> next page), any
other event a visit whose referer is the previous page, and ``purchase`` visits
are goals.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.functions.timefmt import (END_OF_GLOBAL_US, MAX_TIME_US, MIN_TIME_US, dur_us, format_attribution,
                                        format_pane, format_time, format_window, from_us, parse_time, to_us)
from eventide.operators.aggregate import fixed_window_sum, sum_per_key
from eventide.operators.attribution import (attribute, attribution_records, dedup_impressions, latest_visits,
                                              referer_walk)
from eventide.operators.panes import pane_ledger
from eventide.operators.session_panes import session_panes
from eventide.operators.windows import session_sum, validity_windows
from eventide.plans.scan import with_neighbors
from eventide.plans.spec import PaneSpec, Trigger
from eventide.session import materialize, scratch_dir
from eventide.sources.arrival import tag_and_merge
from eventide.sources.tables import (EVENT_WATERMARK, arrival_log_from_events, arrival_ts_of, load,
                                     scores_from_events)
from eventide.sources.text import parse_score_lines, scan_text, score_lines, write_text

# ---------------------------------------------------------------- parameters
WINDOW = "1 hour"
SESSION_GAP = "30 minutes"
PANE_SPECS: dict[str, PaneSpec] = {
    "on_time_panes": PaneSpec(size=WINDOW),
    "allowed_lateness": PaneSpec(size=WINDOW, lateness="1 hour"),
    "per_record_panes": PaneSpec(size=WINDOW, trigger=Trigger.count(1), lateness="3 hours"),
    "count_n_panes": PaneSpec(size=WINDOW, trigger=Trigger.count(3), lateness="1 hour"),
    "aligned_delay_panes": PaneSpec(size=WINDOW, trigger=Trigger.aligned("10 minutes", "5 minutes"),
                                    lateness="3 hours"),
    "unaligned_delay_panes": PaneSpec(size=WINDOW, trigger=Trigger.unaligned("10 minutes"), lateness="3 hours"),
    "early_on_time_late": PaneSpec(size=WINDOW, early=Trigger.unaligned("10 minutes"), late=Trigger.count(1),
                                   lateness="3 hours"),
    "accumulating_panes": PaneSpec(size=WINDOW, early=Trigger.unaligned("10 minutes"), late=Trigger.count(1),
                                   lateness="30 minutes"),
    "discarding_panes": PaneSpec(size=WINDOW, early=Trigger.unaligned("10 minutes"), late=Trigger.count(1),
                                 lateness="30 minutes", mode="discarding"),
    "pane_metadata": PaneSpec(size=WINDOW, early=Trigger.aligned("15 minutes"), late=None,
                              lateness="90 minutes"),
}
PANE_COLUMNS = ["key", "w_start", "w_end", "pane_index", "on_time_index", "timing", "is_first", "is_last",
                "value", "fire_ts"]


# ---------------------------------------------------------------- shared inputs
def events(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "events")


def scores(spark: SparkSession, sf: str) -> DataFrame:
    return scores_from_events(events(spark, sf))


def event_log(spark: SparkSession, sf: str) -> DataFrame:
    return arrival_log_from_events(events(spark, sf))


def visits_and_impressions(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    e = events(spark, sf).select(
        F.col("user_id").cast("string").alias("user"), "event_id", "ts", "event_type", "value",
        arrival_ts_of().alias("arrival_ts"),
        F.struct("event_type", "value").alias("_me"),
        F.floor(to_us("ts") / F.lit(dur_us("1 day"))).alias("_b"))
    e = e.withColumn("wm_ts", EVENT_WATERMARK.wm_at(F.col("arrival_ts")))
    e = with_neighbors(e, ["user"], ["ts", "event_id"], "_b", "_me", "_prev", "_next")
    # Visits and impressions both come from this table, and the walk's inputs
    # read it again: materialize it once in the shared checkpoint folder.
    e = materialize(e.drop("_me", "_b"))
    page = lambda e: F.concat(e["event_type"], F.lit("-"), F.least(
        F.floor(e["value"] / 20), F.lit(5)).cast("string"))
    search = lambda e: F.concat(F.lit("q"), F.least(F.floor(e["value"] / 40), F.lit(2)).cast("string"))
    me, prev, nxt = F.struct("event_type", "value"), F.col("_prev"), F.col("_next")
    visits = e.where(F.col("event_type") != "signup").select(
        "user", page(me).alias("url"), "ts",
        F.when(prev["event_type"] == "signup", search(prev)).otherwise(page(prev)).alias("referer"),
        (F.col("event_type") == "purchase").alias("is_goal"),
        "arrival_ts", F.col("event_id").alias("seq"), "wm_ts")
    imps = e.where(F.col("event_type") == "signup").select(
        "user", F.col("event_id").alias("id"), search(me).alias("source_url"), page(nxt).alias("target_url"), "ts",
        "arrival_ts", F.col("event_id").alias("seq"), "wm_ts")
    return visits, imps


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


# ---------------------------------------------------------------- queries
def q_fixed_window_sum(spark, sf):
    return fixed_window_sum(scores(spark, sf), WINDOW)


def q_sum_per_key(spark, sf):
    return sum_per_key(scores(spark, sf))


def q_session_sum(spark, sf):
    return session_sum(scores(spark, sf), SESSION_GAP)


def q_validity_windows(spark, sf):
    return validity_windows(scores(spark, sf))


def _score_line_rows(spark, sf):
    e = events(spark, sf)
    return scores_from_events(e).select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("user"), F.col("key").alias("team"), "score",
        "event_ts", arrival_ts_of("event_ts").alias("arrival_ts"), "event_id")


def _written_lines(spark, sf):
    """Score lines as a text folder; of every 40 events one line is cut short, one is empty, one has no number."""
    rows = _score_line_rows(spark, sf)
    whole = score_lines(rows.select("*", F.pmod("event_id", F.lit(40)).alias("_m")), keep=("user", "team", "_m"))
    lines = whole.select(F.when(F.col("_m") == 0, F.concat_ws(",\t", "user", "team")).when(F.col("_m") == 1, "").when(
        F.col("_m") == 2, F.regexp_replace("value", r"\t(-?\d+),\t2024", "\tx$1,\t2024")).otherwise(
            F.col("value")).alias("value"))
    path = _scratch(spark, "score-lines")
    write_text(lines, path)
    return scan_text(spark, path)


def q_write_text(spark, sf):
    path = _scratch(spark, "score-lines")
    write_text(score_lines(_score_line_rows(spark, sf)), path)
    return scan_text(spark, path)


def q_scan_text(spark, sf):
    path = _scratch(spark, "windows-text")
    w = fixed_window_sum(scores(spark, sf), WINDOW)
    write_text(w.select(F.concat_ws(" ", "key", format_window("w_start", "w_end"), F.col("value").cast("string"))
                        .alias("value")), path)
    return scan_text(spark, path)


def q_parse_scores(spark, sf):
    return parse_score_lines(_written_lines(spark, sf))[0]


def q_score_rejects(spark, sf):
    return parse_score_lines(_written_lines(spark, sf))[1]


def q_parse_time(spark, sf):
    e = events(spark, sf).select("event_id", F.date_format("ts", "HH:mm:ss").alias("hms"))
    return e.select("event_id", "hms", parse_time("hms").alias("t"))


def q_format_time(spark, sf):
    """Event times; of every 50 events one has no time and three have the named ones."""
    m, named = F.pmod("event_id", F.lit(50)), lambda us: from_us(F.lit(us))
    t = (F.when(m == 0, F.lit(None).cast("timestamp_ntz")).when(m == 1, named(MIN_TIME_US))
         .when(m == 2, named(MAX_TIME_US)).when(m == 3, named(END_OF_GLOBAL_US)).otherwise(F.col("ts")))
    return events(spark, sf).select("event_id", format_time(t).alias("text"))


def q_format_window(spark, sf):
    """Validity windows; by the second they start in, some are the global window or known by their end alone."""
    v = validity_windows(scores(spark, sf))
    m, none = F.pmod(F.floor(to_us("w_start") / 1_000_000), F.lit(20)), F.lit(None).cast("timestamp_ntz")
    text = format_window(F.when(m == 0, none).otherwise(F.col("w_start")), F.when(m == 0, none).otherwise(F.col("w_end")),
                         F.when(m == 1, F.col("w_start")).otherwise(none))
    return v.select("key", "w_start", text.alias("text"))


def _pane_text(p: DataFrame) -> DataFrame:
    return p.select("key", "w_start", "pane_index", format_pane("w_start", "w_end", "key", "value", "timing",
                                                                "pane_index", "on_time_index", "is_first",
                                                                "is_last").alias("text"))


def q_format_pane(spark, sf):
    return _pane_text(pane_ledger(event_log(spark, sf), PANE_SPECS["allowed_lateness"], EVENT_WATERMARK))


def q_arrival_log(spark, sf):
    return event_log(spark, sf)


def _pane_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark, sf):
        out = pane_ledger(event_log(spark, sf), PANE_SPECS[name], EVENT_WATERMARK)
        if name == "pane_metadata":
            text = format_pane("w_start", "w_end", "key", "value", "timing", "pane_index", "on_time_index",
                               "is_first", "is_last")
            return out.select(*PANE_COLUMNS, text.alias("text"))
        return out.select(*PANE_COLUMNS)
    return run


def q_dropped_late(spark, sf):
    _, dropped = pane_ledger(event_log(spark, sf), PANE_SPECS["on_time_panes"], EVENT_WATERMARK,
                             with_dropped=True)
    return dropped.select("key", "w_start", "seq", "arrival_ts", "score")


def q_visits_or_impressions(spark, sf):
    v, i = visits_and_impressions(spark, sf)
    u = tag_and_merge(v, i)
    return u.select("user", "seq", F.when(F.col("visit").isNotNull(), "visit").otherwise("impression").alias("kind"),
                    F.coalesce("visit.url", "impression.target_url").alias("url"),
                    F.coalesce("visit.referer", "impression.source_url").alias("referer"),
                    F.coalesce("visit.ts", "impression.ts").alias("ts"),
                    F.col("visit.is_goal").alias("is_goal"), F.col("impression.id").alias("imp_id"))


def q_latest_visit(spark, sf):
    v, _ = visits_and_impressions(spark, sf)
    return latest_visits(v).where(F.col("next").isNull()).select("user", "url", "ts", "referer", "seq")


def q_dedup_impressions(spark, sf):
    _, i = visits_and_impressions(spark, sf)
    return dedup_impressions(i).select("user", "source_url", "target_url", "id", "ts")


def _attributed(spark, sf):
    v, i = visits_and_impressions(spark, sf)
    return attribute(v, i)


def q_attribution(spark, sf):
    a = _attributed(spark, sf)
    path = F.array_join(F.concat(F.array("source_url"), F.transform("trail", lambda v: v["url"]), F.array("goal_url")),
                        " → ")
    seen = F.array_join(F.transform("trail", lambda v: F.date_format(v["ts"], "MM-dd HH:mm:ss")), " ")
    return a.select("user", "goal_url", "goal_ts", "imp_id", "source_url", path.alias("path"), seen.alias("visit_times"),
                    F.size("trail").cast("bigint").alias("trail_len"))


def q_attribution_once(spark, sf):
    """Each impression credited once, state kept for ten days."""
    v, i = visits_and_impressions(spark, sf)
    return attribute(v, i, consume_impression=True, state_ttl=STATE_TTL).select(
        "user", "goal_url", "goal_ts", "imp_id", F.size("trail").cast("bigint").alias("trail_len"))


def q_format_attribution(spark, sf):
    rec = attribution_records(_attributed(spark, sf))
    return rec.select("user", F.col("goal.url").alias("goal_url"), F.col("goal.ts").alias("goal_ts"),
                      format_attribution("impression", "trail", "goal").alias("text"),
                      format_attribution("impression", "trail", "goal", F.lit("LATE"), F.lit(1), F.lit(0), F.lit(False),
                                         F.lit(True)).alias("pane_text"))


def q_referer_chain(spark, sf):
    v, i = visits_and_impressions(spark, sf)
    return referer_walk(v, i).select("user", "goal_url", "goal_ts", "depth", "cur_url", "cur_ref")


STATE_TTL = "10 days"
SESSION_PANES = dict(gap=SESSION_GAP, early_delay="10 minutes", lateness="3 hours")


def q_session_panes(spark, sf):
    return session_panes(event_log(spark, sf), watermark=EVENT_WATERMARK, **SESSION_PANES)


def _log_with_null_keys(spark, sf):
    """The arrival log; every third event has no key."""
    return event_log(spark, sf).withColumn("key", F.when(F.col("seq") % 3 != 0, F.col("key")))


def q_null_key_panes(spark, sf):
    return pane_ledger(_log_with_null_keys(spark, sf), PANE_SPECS["accumulating_panes"], EVENT_WATERMARK).select(*PANE_COLUMNS)


def q_null_key_session_panes(spark, sf):
    return session_panes(_log_with_null_keys(spark, sf), watermark=EVENT_WATERMARK, **SESSION_PANES)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q = {
        "fixed_window_sum": q_fixed_window_sum,
        "sum_per_key": q_sum_per_key,
        "session_sum": q_session_sum,
        "validity_windows": q_validity_windows,
        "scan_text": q_scan_text,
        "write_text": q_write_text,
        "parse_scores": q_parse_scores,
        "score_rejects": q_score_rejects,
        "parse_time": q_parse_time,
        "format_time": q_format_time,
        "format_window": q_format_window,
        "format_pane": q_format_pane,
        "arrival_log": q_arrival_log,
        "dropped_late": q_dropped_late,
        "visits_or_impressions": q_visits_or_impressions,
        "latest_visit": q_latest_visit,
        "dedup_impressions": q_dedup_impressions,
        "referer_chain": q_referer_chain,
        "attribution": q_attribution,
        "attribution_once": q_attribution_once,
        "format_attribution": q_format_attribution,
        "session_panes": q_session_panes,
        "null_key_panes": q_null_key_panes,
        "null_key_session_panes": q_null_key_session_panes,
    }
    for name in PANE_SPECS:
        q[name] = _pane_query(name)
    return q
