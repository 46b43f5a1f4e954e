"""Conversion attribution: walk the referer chain from a goal back to an impression.

Bounded form of the keyed-state processor.  Inputs are per-user visits and impressions with
arrival metadata (``arrival_ts, seq, wm_ts``; ``wm_ts`` is the watermark in force when the row
arrived, so it rises with ``(arrival_ts, seq)``).  A goal fires when the watermark reaches its
timestamp, or at once if the watermark had reached it before the goal arrived.  Only state that
had arrived by then counts:

* a goal in time sees the rows that arrived under a watermark below its timestamp;
* a late goal sees the rows that arrived before it, in the order of ``(arrival_ts, seq)``.

Either way that is a cutoff in the order of ``(wm_ts, arrival_ts, seq)``.  Of a URL's visits the
last one before the cutoff counts, of equal (source, target) impressions the first arrival.

The walk is a loop over a frontier with one row per open goal.  A step is one pass over the
frontier and the visits of the users in it (``plans.scan.last_before``), so goals on one
URL cost no more than others.  After ``STEPS_FIRST`` steps the walk jumps: a visit's parent is the
same for a range of cutoffs, and tables of such ranges, composed by doubling, take a goal over
any number of visits in a few joins; where a goal's cutoff is outside a range, it goes on by a
plain step.  Steps stay as rows, so neither the number of rows nor the depth is limited.  A goal
leaves the frontier at a visible impression, at an unknown referer, or when its walk repeats a
URL, which is looked for in every round that is a power of two.

Rows without a user are the visits of one user, the null one; a null URL or referer matches nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.functions.timefmt import dur_us, to_us
from eventide.plans.scan import last_before, with_next
from eventide.session import materialize, materialize_counted

_B = "1 day"
GOAL = ["user", "goal_url", "goal_ts"]
#: Plain steps before jump tables are worth their making.
STEPS_FIRST = 16
#: Goals and visits of a user up to which a user's URL is left to one task.
SMALL = 100_000


def _bucket(c: str) -> Column:
    return F.floor(to_us(c) / F.lit(dur_us(_B)))


def latest_visits(visits: DataFrame) -> DataFrame:
    """Versions of each (user, url) among non-goal visits in arrival order; ``next`` is the successor's arrival."""
    v = visits.where(~F.coalesce(F.col("is_goal"), F.lit(False))).withColumn("_b", _bucket("arrival_ts"))
    v = v.withColumn("_at", F.struct("arrival_ts", "seq", "wm_ts"))
    out = with_next(v, ["user", "url"], ["arrival_ts", "seq"], "_b", "_at", "next")
    return out.select("user", "url", "ts", "referer", "is_goal", "arrival_ts", "seq", "wm_ts", "next")


def dedup_impressions(impressions: DataFrame) -> DataFrame:
    """First arrival per (user, source_url, target_url) wins."""
    return (impressions.groupBy("user", "source_url", "target_url")
            .agg(F.min_by(F.struct("id", "ts", "arrival_ts", "seq", "wm_ts"), F.struct("arrival_ts", "seq")).alias("m"))
            .select("user", "source_url", "target_url", "m.*"))


def goals_of(visits: DataFrame) -> DataFrame:
    """Distinct goals by (user, url, ts), first arrival: with ``goal_referer`` and the arrival ``g_arrival, g_seq, g_wm``."""
    first = F.min_by(F.struct("referer", "arrival_ts", "seq", "wm_ts"), F.struct("arrival_ts", "seq")).alias("m")
    return (visits.where(F.col("is_goal")).groupBy("user", "url", "ts").agg(first)
            .select("user", F.col("url").alias("goal_url"), F.col("ts").alias("goal_ts"),
                    F.col("m.referer").alias("goal_referer"), F.col("m.arrival_ts").alias("g_arrival"),
                    F.col("m.seq").alias("g_seq"), F.col("m.wm_ts").alias("g_wm")))


def _order(wm: Column | str, arrival: Column | str, seq: Column | str) -> Column:
    return F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(n) for c, n in ((wm, "wm"), (arrival, "at"), (seq, "seq"))])


def _time(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _cutoff() -> Column:
    """A goal sees what comes before this in ``(wm_ts, arrival_ts, seq)``."""
    first = _order("goal_ts", _time("0001-01-01 00:00:00"), F.lit(-2**63).cast("long"))
    return F.when(F.col("g_wm") >= F.col("goal_ts"), _order("g_wm", "g_arrival", "g_seq")).otherwise(first)


def _never() -> Column:
    end = _time("9999-12-31 23:59:59")
    return _order(end, end, F.lit(2**63 - 1).cast("long"))


def _oldest(ttl: str | None) -> Column:
    """The least event time (us) of state that a goal may use."""
    if ttl is None:
        return F.lit(-2**62).cast("long")
    return to_us(F.greatest("goal_ts", "g_wm")) - F.lit(dur_us(ttl))


def _hit() -> Column:
    return F.coalesce((F.col("imp.order") < F.col("cutoff")) & (to_us("imp.ts") >= F.col("oldest")), F.lit(False))


_ROW = ["gid", *GOAL, "g_wm", "g_arrival", "g_seq", "cutoff", "oldest"]
_STEP = [*_ROW, "depth", "cur", "imp", "vid", "hit"]


def _by(user: str, url: Column | str) -> Column:
    return F.struct(F.col(user).alias("user"), (F.col(url) if isinstance(url, str) else url).alias("url"))


def _versions(visits: DataFrame, imps: DataFrame) -> DataFrame:
    """Visits as state: ``vid``, ``by`` (user, url), ``order``, ``until`` (the successor's order), and what a step takes over."""
    v = latest_visits(visits).withColumn("_pair", F.struct("user", "referer", "url")).join(
        imps.withColumnRenamed("pair", "_pair"), "_pair", "left").where(F.col("url").isNotNull())
    order = _order("wm_ts", "arrival_ts", "seq")
    until = F.when(F.col("next").isNotNull(), _order("next.wm_ts", "next.arrival_ts", "next.seq")).otherwise(_never())
    return materialize(v.select(F.monotonically_increasing_id().alias("vid"), "user", _by("user", "url").alias("by"), order.alias("order"),
                                until.alias("until"), F.struct("url", "ts", "referer", "is_goal").alias("cur"), "imp"))


def _open(steps: DataFrame, stop_at_hit: bool) -> DataFrame:
    return steps.where(~(F.col("hit") & F.lit(stop_at_hit)) & F.col("cur.referer").isNotNull())


def _days(versions: DataFrame, goals: DataFrame):
    """The bucket of an order for ``last_before``: its day, or none if no user has more than ``SMALL`` rows."""
    rows = versions.select("user").unionByName(goals.select("user")).groupBy("user").count().agg(F.max("count")).first()[0] or 0
    return None if rows <= SMALL else lambda order: F.floor(to_us(order["wm"]) / F.lit(dur_us(_B)))


def _step(going: DataFrame, versions: DataFrame, bucket) -> DataFrame:
    """One plain step of every open goal: the visit that its cutoff shows for the referer."""
    there = versions.select("by", "order", F.struct("vid", "cur", "imp").alias("_found"))
    asked = going.select(*_ROW, "depth", _by("user", F.col("cur.referer")).alias("by"), F.col("cutoff").alias("order"))
    found = last_before(asked, there, "by", "order", bucket, "_found", "_found")
    found = found.where("_found IS NOT NULL").select(*_ROW, (F.col("depth") + 1).alias("depth"), "_found.*")
    found = found.where((to_us("cur.ts") >= F.col("oldest")) & (F.col("cur.url") != F.col("goal_url")))
    return found.withColumn("hit", _hit()).select(*_STEP)


def _looped(levels: list[DataFrame], going: DataFrame) -> DataFrame:
    """``gid`` of the open goals whose walk has come to a URL twice."""
    walked = reduce(DataFrame.unionByName, [x.select("gid", F.col("cur.url").alias("url")) for x in levels])
    return walked.join(going.select("gid"), "gid", "left_semi").groupBy("gid").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("url").alias("d")).where("n > d").select("gid")


def _of_users(versions: DataFrame, going: DataFrame) -> DataFrame:
    """The versions of the users that still have an open goal."""
    users = going.select(F.struct("user").alias("_u")).distinct()
    return materialize(versions.withColumn("_u", F.struct("user")).join(users, "_u", "left_semi").drop("_u"))


class Jumps:
    """Jumps of 1, 2, 4, ... visits, each good for a range of cutoffs.

    A visit's first jump goes to the parent that is current when the visit is replaced: the
    parent for every cutoff from then back to the arrival of the later of the two.  A composed
    jump is good where both parts are.  Visits with an impression are entered by plain steps
    (unless walks pass impressions), and so are those that lead into a loop.
    """

    def __init__(self, mine: DataFrame, stop_at_hit: bool, bucket):
        there = mine if not stop_at_hit else mine.withColumn("_end", F.col("imp").isNotNull())
        end = F.col("_end") if stop_at_hit else F.lit(False)
        there = there.select("by", "order", F.struct(F.col("vid").alias("to"), F.col("order").alias("since"), to_us("cur.ts").alias(
            "ts"), end.alias("end")).alias("_p"))
        asked = mine.where(F.col("cur.referer").isNotNull()).select(
            "vid", _by("user", F.col("cur.referer")).alias("by"), F.col("order").alias("_own"), F.col("until").alias("order"))
        first = last_before(asked, there, "by", "order", bucket, "_p", "_p")
        table, n = materialize_counted(first.where("_p IS NOT NULL AND NOT _p.end").select(
            "vid", "_p.to", F.greatest("_own", "_p.since").alias("since"), F.col("order").alias("until"), F.col("_p.ts").alias("oldest")))
        self.tables, most = [], mine.groupBy("user").agg(F.countDistinct("by").alias("n")).agg(F.max("n")).first()[0] or 0
        while n and 2 ** len(self.tables) <= most:
            self.tables.append(table)
            on = table.select(F.col("vid").alias("to"), F.col("to").alias("_to"), F.col("since").alias("_since"), F.col("until").alias(
                "_until"), F.col("oldest").alias("_oldest"))
            table, n = materialize_counted(table.join(on, "to").select(
                "vid", F.col("_to").alias("to"), F.greatest("since", "_since").alias("since"), F.least("until", "_until").alias(
                    "until"), F.least("oldest", "_oldest").alias("oldest")).where(F.col("since") < F.col("until")))
        # More jumps than the user has URLs: a loop.
        loops = table.select("vid")
        self.tables = [materialize(t.join(loops, "vid", "left_anti")) if n else t for t in self.tables]
        self.cur = mine.select("vid", "cur", "imp")

    def go(self, going: DataFrame) -> DataFrame:
        """The steps that the open goals can jump over, all of them, each goal's last one ``is_last``."""
        at = materialize(going.where(F.col("vid").isNotNull()).select("gid", "vid", "depth", "cutoff", "oldest"))
        for k in reversed(range(len(self.tables))):
            t = self.tables[k].select("vid", "to", "since", "until", F.col("oldest").alias("_oldest"))
            # A cutoff sees rows before it, so it may equal the end of a range, not its start.
            good = (F.col("since") < F.col("cutoff")) & (F.col("cutoff") <= F.col("until")) & (F.col("_oldest") >= F.col("oldest"))
            at = materialize(at.unionByName(at.join(t, "vid").where(good).select(
                "gid", F.col("to").alias("vid"), (F.col("depth") + F.lit(2 ** k)).alias("depth"), "cutoff", "oldest")))
        start = going.select(*_ROW, F.col("depth").alias("_from"))
        steps = at.select("gid", "vid", "depth").join(start, "gid").where(F.col("depth") > F.col("_from")).join(self.cur, "vid")
        url = F.col("cur.url")
        stop = steps.groupBy("gid").agg(F.max("depth").alias("_last"), F.min(F.when(url == F.col("goal_url"), F.col("depth"))).alias("_home"))
        steps = steps.join(stop, "gid").where(F.col("_home").isNull() | (F.col("depth") < F.col("_home")))
        last = F.col("depth") == F.col("_last")
        return materialize(steps.withColumn("hit", _hit()).select(*_STEP, last.alias("is_last")))


def walk_steps(visits: DataFrame, impressions: DataFrame, state_ttl: str | None = None, stop_at_hit: bool = True) -> DataFrame:
    """Every step of every goal's walk: the goal (``gid``, GOAL, its arrival), ``depth``, the visit ``cur``, its impression ``imp``, ``hit``."""
    imps = materialize(dedup_impressions(impressions).select(
        F.struct("user", F.col("source_url").alias("referer"), F.col("target_url").alias("url")).alias("pair"),
        F.struct("id", F.col("source_url"), F.col("target_url"), "ts", _order("wm_ts", "arrival_ts", "seq").alias("order")).alias("imp")))
    versions = _versions(visits, imps)
    goals = materialize(goals_of(visits).withColumn("gid", F.monotonically_increasing_id()))
    pair = F.struct("user", F.col("goal_referer").alias("referer"), F.col("goal_url").alias("url"))
    goals = goals.withColumn("pair", pair).join(imps, "pair", "left").withColumn("cutoff", _cutoff()).withColumn("oldest", _oldest(state_ttl))
    goals = goals.select(
        *_ROW, F.lit(0).cast("long").alias("depth"), F.struct(F.col("goal_url").alias("url"), F.col("goal_ts").alias("ts"), F.col(
            "goal_referer").alias("referer"), F.lit(True).alias("is_goal")).alias("cur"), "imp", F.lit(None).cast("long").alias("vid"))
    goals = goals.withColumn("hit", _hit()).select(*_STEP)
    level, n = materialize_counted(goals)
    bucket = _days(versions, level)
    levels, jumps, round_, loops = [level], None, 0, False
    while n:
        going, round_ = _open(level, stop_at_hit), round_ + 1
        if round_ > 1 and not round_ & (round_ - 1):
            again, many = materialize_counted(_looped(levels, going))
            if many:
                loops, going = True, materialize(going.join(again, "gid", "left_anti"))
            versions = _of_users(versions, going)
        if round_ > STEPS_FIRST:
            if jumps is None:
                jumps = Jumps(_of_users(versions, going), stop_at_hit, bucket)
            jumped = jumps.go(going)
            levels.append(jumped.drop("is_last"))
            stay = going.join(jumped.select("gid").distinct(), "gid", "left_anti")
            going = stay.select(*_STEP).unionByName(_open(jumped.where("is_last"), stop_at_hit).select(*_STEP))
        level, n = materialize_counted(_step(going, versions, bucket))
        levels.append(level)
    steps = reduce(DataFrame.unionByName, levels)
    if loops:
        first = Window.partitionBy("gid", "cur.url").orderBy("depth")
        steps = steps.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")
    return steps


def referer_walk(visits: DataFrame, impressions: DataFrame, state_ttl: str | None = None) -> DataFrame:
    """Every step of every goal's walk: GOAL, ``depth, cur_url, cur_ref, hit``; depth 0 is the goal itself."""
    return walk_steps(visits, impressions, state_ttl).select(
        *GOAL, F.col("depth").cast("int").alias("depth"), F.col("cur.url").alias("cur_url"), F.col("cur.referer").alias("cur_ref"), "hit")


def _first_come(hits: DataFrame) -> DataFrame:
    """(gid, depth): each impression credits the earliest firing goal that reaches it; the others walk on.

    Goals propose along their walks, impressions keep the earliest proposer; every round only
    rejected goals move on, so the result is that of the firings one after another.
    """
    level = F.greatest("goal_ts", "g_wm")
    late = F.col("g_wm") >= F.col("goal_ts")
    turn = F.struct(level.alias("level"), late.alias("late"), F.when(late, F.col("g_arrival")).alias("arrival"), F.when(
        late, F.col("g_seq")).alias("seq"), F.col("goal_ts").alias("ts"), F.col("goal_url").alias("url"))
    what = F.struct("user", "imp.source_url", "imp.target_url")
    left = materialize(hits.select("gid", "depth", what.alias("what"), turn.alias("turn")))
    while True:
        asked = left.groupBy("gid").agg(F.min(F.struct("depth", "what", "turn")).alias("m")).select(
            "gid", "m.depth", "m.what", "m.turn")
        best = asked.groupBy("what").agg(F.min("turn").alias("best"))
        won = materialize(asked.join(best, "what").select(
            "gid", F.col("depth").alias("at"), (F.col("turn") == F.col("best")).alias("won")))
        lost, n = materialize_counted(won.where(~F.col("won")))
        if not n:
            return won.select("gid", F.col("at").alias("depth"))
        left = materialize(left.join(lost, "gid", "left").where(F.col("at").isNull() | (F.col("depth") > F.col("at")))
                           .select("gid", "depth", "what", "turn"))


def attribute(visits: DataFrame, impressions: DataFrame, consume_impression: bool = False,
              state_ttl: str | None = None) -> DataFrame:
    """``user, goal_url, goal_ts, goal_referer, imp_id, source_url, target_url, imp_ts, trail``.

    ``trail`` holds the visits walked through, oldest first, as the versions the goal saw.
    ``consume_impression``: an impression credits one goal only, the first to fire, and later
    goals walk past it.  ``state_ttl``: visits and impressions count for this long after
    their event time.
    """
    steps = walk_steps(visits, impressions, state_ttl, stop_at_hit=not consume_impression)
    hits = steps.where("hit")
    if consume_impression:
        hits = hits.join(_first_come(hits), ["gid", "depth"])
    found = hits.select("gid", *GOAL, F.col("depth").alias("end"), "imp")
    way = steps.select("gid", "depth", "cur").join(found.select("gid", "end"), "gid").where(F.col("depth") <= F.col("end"))
    trails = way.groupBy("gid").agg(F.sort_array(F.collect_list(F.struct("depth", "cur")), asc=False).alias("_t"))
    goal_last = F.size("_t")
    return found.join(trails, "gid").select(
        *GOAL, F.element_at("_t", goal_last)["cur"]["referer"].alias("goal_referer"), F.col("imp.id").alias("imp_id"),
        "imp.source_url", "imp.target_url", F.col("imp.ts").alias("imp_ts"),
        F.transform(F.slice("_t", 1, goal_last - 1), lambda s: s["cur"]).alias("trail"))


def attribution_records(attributed: DataFrame) -> DataFrame:
    """Nested form ``user, impression STRUCT, trail ARRAY<STRUCT>, goal STRUCT`` for formatting."""
    return attributed.select(
        "user", F.struct(F.col("imp_id").alias("id"), "source_url", "target_url", F.col("imp_ts").alias("ts")).alias(
            "impression"), "trail",
        F.struct(F.col("goal_url").alias("url"), F.col("goal_ts").alias("ts"), F.col("goal_referer").alias("referer"),
                 F.lit(True).alias("is_goal")).alias("goal"))
