"""Attribution rules: late goals, re-visited URLs, ties, cycles, consumption, expiry, and many walk rows."""

import datetime as dt
import random
import time

from pyspark.sql import functions as F

from eventide.operators import attribution
from eventide.operators.attribution import attribute, dedup_impressions, latest_visits, referer_walk

VISIT = "user string, url string, ts timestamp_ntz, referer string, is_goal boolean, arrival_ts timestamp_ntz, seq long, wm_ts timestamp_ntz"
IMP = "user string, id long, source_url string, target_url string, ts timestamp_ntz, arrival_ts timestamp_ntz, seq long, wm_ts timestamp_ntz"


def t(hm):
    h, m = hm.split(":")
    return dt.datetime(2024, 1, 1, int(h), int(m))


def visits(spark, *rows):
    """(url, ts, referer, is_goal, arrival, seq, watermark)"""
    return spark.createDataFrame([("u", url, t(ts), ref, goal, t(a), s, t(w)) for url, ts, ref, goal, a, s, w in rows], VISIT)


def imps(spark, *rows):
    """(id, source, target, ts, arrival, seq, watermark)"""
    return spark.createDataFrame([("u", i, src, dst, t(ts), t(a), s, t(w)) for i, src, dst, ts, a, s, w in rows], IMP)


def got(df):
    return sorted((r.goal_url, r.imp_id, tuple(v.url for v in r.trail)) for r in df.collect())


def test_late_goal_sees_only_what_arrived_before_it(spark):
    i = imps(spark, (1, "s", "a", "00:30", "05:40", 9, "04:00"))
    v = visits(spark, ("g", "01:00", "a", True, "05:00", 5, "04:00"), ("a", "00:40", "s", False, "05:20", 7, "04:00"))
    assert got(attribute(v, i)) == []
    early = imps(spark, (1, "s", "a", "00:30", "04:10", 2, "04:00"))
    before = visits(spark, ("g", "01:00", "a", True, "05:00", 5, "04:00"), ("a", "00:40", "s", False, "04:20", 3, "04:00"))
    assert got(attribute(before, early)) == [("g", 1, ("a",))]


def test_goal_in_time_fires_when_the_watermark_reaches_it(spark):
    """State under a watermark below the goal's time counts; state under one equal to it came too late."""
    v = visits(spark, ("g", "01:00", "a", True, "01:05", 1, "00:30"), ("a", "00:40", "s", False, "02:00", 2, "00:59"))
    assert got(attribute(v, imps(spark, (1, "s", "a", "00:30", "02:01", 3, "00:59")))) == [("g", 1, ("a",))]
    assert got(attribute(v, imps(spark, (1, "s", "a", "00:30", "02:01", 3, "01:00")))) == []


def test_revisited_url_uses_the_version_the_goal_saw(spark):
    v = visits(spark, ("a", "00:10", "s", False, "00:11", 1, "00:00"), ("g", "00:20", "a", True, "00:21", 2, "00:00"),
               ("a", "00:30", "elsewhere", False, "00:51", 3, "00:20"), ("g", "00:40", "a", True, "00:52", 4, "00:20"))
    i = imps(spark, (1, "s", "a", "00:05", "00:06", 0, "00:00"), (2, "s", "a", "00:07", "00:08", 5, "00:00"))
    rows = attribute(v, i).collect()
    assert [(r.goal_ts, r.imp_id, [x.ts for x in r.trail]) for r in rows] == [(t("00:20"), 1, [t("00:10")])]
    assert latest_visits(v).where("next is null").first().referer == "elsewhere"
    assert dedup_impressions(i).first().id == 1


def test_result_does_not_depend_on_row_order(spark):
    v = visits(spark, ("a", "00:10", "s", False, "00:11", 1, "00:00"), ("a", "00:12", "s", False, "00:13", 2, "00:00"),
               ("a", "00:14", "s", False, "00:55", 4, "00:20"), ("g", "00:20", "a", True, "00:21", 3, "00:00"))
    i = imps(spark, (1, "s", "a", "00:05", "00:06", 0, "00:00"))
    for order in (F.col("seq"), F.col("seq").desc()):
        (row,) = attribute(v.orderBy(order).coalesce(1), i).collect()
        assert [x.ts for x in row.trail] == [t("00:12")]


def test_cycles_end(spark):
    n = 11
    v = visits(spark, ("g", "01:00", "c0", True, "01:00", 0, "00:00"),
               *[(f"c{k}", "00:10", f"c{(k + 1) % n}", False, "00:10", k + 1, "00:00") for k in range(n)])
    w = referer_walk(v, imps(spark, (1, "x", "y", "00:00", "00:00", 99, "00:00")))
    assert sorted(r.depth for r in w.collect()) == list(range(n + 1))


def test_consumed_impressions_and_expiry(spark):
    v = visits(spark, ("a", "00:10", "b", False, "00:10", 1, "00:00"), ("b", "00:09", "s", False, "00:09", 2, "00:00"),
               *[(f"g{k}", f"01:0{k}", "a", True, "01:00", 10 + k, "00:00") for k in range(3)])
    i = imps(spark, (1, "b", "a", "00:08", "00:08", 3, "00:00"), (2, "s", "b", "00:07", "00:07", 4, "00:00"))
    assert got(attribute(v, i)) == [(f"g{k}", 1, ("a",)) for k in range(3)]
    assert got(attribute(v, i, consume_impression=True)) == [("g0", 1, ("a",)), ("g1", 2, ("b", "a"))]
    assert got(attribute(v, i, state_ttl="53 minutes")) == [("g0", 1, ("a",)), ("g1", 1, ("a",))]
    assert got(attribute(v, i, state_ttl="30 minutes")) == []


def test_more_than_a_million_walk_rows(spark):
    """Chains of five visits under 220,000 goals: no limit on rows."""
    n = 220_000
    base = spark.range(n, numPartitions=8).select(F.col("id").cast("string").alias("user"), F.col("id").alias("k"))
    stamp = F.timestamp_seconds(F.lit(1_700_000_000)).cast("timestamp_ntz")
    chain = base.select("user", "k", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("j"))
    v = chain.select("user", F.concat(F.lit("p"), "j").alias("url"), stamp.alias("ts"), F.when(F.col("j") < 5, F.concat(
        F.lit("p"), F.col("j") + 1)).otherwise("s").alias("referer"), (F.col("j") == 0).alias("is_goal"),
        stamp.alias("arrival_ts"), (F.col("k") * 10 + F.col("j")).alias("seq"),
        F.timestamp_seconds(F.lit(1_600_000_000)).cast("timestamp_ntz").alias("wm_ts"))
    i = base.select("user", F.col("k").alias("id"), F.lit("s").alias("source_url"), F.lit("p5").alias("target_url"),
                    stamp.alias("ts"), stamp.alias("arrival_ts"), (F.col("k") * 10 + 9).alias("seq"),
                    F.timestamp_seconds(F.lit(1_600_000_000)).cast("timestamp_ntz").alias("wm_ts"))
    w = referer_walk(v, i)
    assert w.count() == 6 * n and w.where("hit").count() == n


def _stamp(seconds):
    return F.timestamp_seconds(F.lit(1_700_000_000) + seconds).cast("timestamp_ntz")


def test_many_goals_and_versions_on_one_url(spark):
    """100,000 goals that follow as many visits of one page: each sees the visit before it, in time linear in both."""
    n = 100_000
    base = spark.range(n, numPartitions=8).select(F.lit("u").alias("user"), F.col("id").alias("k"))
    old = F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")

    def rows(url, at, referer, goal, seq):
        t = _stamp(at)
        return base.select("user", url.alias("url"), t.alias("ts"), referer.alias("referer"), F.lit(goal).alias("is_goal"), t.alias(
            "arrival_ts"), seq.alias("seq"), F.timestamp_seconds(F.lit(1_700_000_000) + at - 1).cast("timestamp_ntz").alias("wm_ts"))
    k = F.col("k")
    v = rows(F.lit("page"), k * 2, F.lit("s"), False, k * 2).unionByName(
        rows(F.concat(F.lit("g"), k), k * 2 + 1, F.lit("page"), True, k * 2 + 1))
    i = spark.range(1).select(F.lit("u").alias("user"), F.lit(7).cast("long").alias("id"), F.lit("s").alias("source_url"), F.lit("page").alias(
        "target_url"), old.alias("ts"), old.alias("arrival_ts"), F.lit(-1).cast("long").alias("seq"), old.alias("wm_ts"))
    began = time.monotonic()
    got = attribute(v, i).select("goal_ts", F.col("trail")[0]["ts"].alias("seen"), F.size("trail").alias("n"))
    # A goal at 2k + 1 sees state that arrived under a watermark below it: the visit of second 2k + 1 or before.
    assert got.where((F.col("n") == 1) & (F.col("seen") == F.col("goal_ts") - F.expr("INTERVAL 1 SECOND"))).count() == n
    assert time.monotonic() - began < 90


def test_deep_chain_takes_few_rounds(spark, monkeypatch):
    """A chain of 1,000 pages, and one of 900 with an impression in its middle: jumps of doubling length."""
    rounds = []
    step = attribution._step
    monkeypatch.setattr(attribution, "_step", lambda *a: (rounds.append(1), step(*a))[1])
    stamp, old = _stamp(F.lit(0)), F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")
    users = spark.createDataFrame([("deep", 1000), ("mid", 900), (None, 300)], "user string, n long")
    chain = users.select("user", "n", F.explode(F.sequence(F.lit(0), "n")).alias("j")).select(
        "user", F.concat(F.lit("p"), "j").alias("url"), stamp.alias("ts"), F.when(F.col("j") < F.col("n"), F.concat(
            F.lit("p"), F.col("j") + 1)).otherwise("s").alias("referer"), (F.col("j") == 0).alias("is_goal"), stamp.alias("arrival_ts"),
        F.col("j").cast("long").alias("seq"), old.alias("wm_ts"))
    i = spark.createDataFrame([("deep", 1, "s", "p1000"), ("mid", 2, "p451", "p450"), (None, 3, "s", "p300")],
                              "user string, id long, source_url string, target_url string").select(
        "*", stamp.alias("ts"), stamp.alias("arrival_ts"), F.lit(0).cast("long").alias("seq"), old.alias("wm_ts"))
    got = {r.user: (r.imp_id, [x.url for x in r.trail]) for r in attribute(chain, i).collect()}
    for user, imp, n in (("deep", 1, 1000), ("mid", 2, 450), (None, 3, 300)):
        assert got[user] == (imp, [f"p{j}" for j in range(n, 0, -1)])
    assert len(rounds) <= attribution.STEPS_FIRST + 6


def _random_visits(spark, seed, n=400):
    """Few pages visited over and over, some out of order: loops, replaced versions, late goals, no user on a third."""
    rng = random.Random(seed)
    vs, ims = [], []
    for k in range(n):
        at, user = k * 30 + rng.randrange(20), rng.choice(["a", "b", None])
        late = at + int(3000 * rng.random() ** 4)
        page = f"p{rng.randrange(12)}"
        if rng.random() < .05:
            ims.append((user, k, f"p{rng.randrange(12)}", page, at, late))
        else:
            vs.append((user, page if rng.random() < .8 else f"g{k}", at, rng.choice([f"p{rng.randrange(12)}", None]) if rng.random() < .95 else None,
                       late))
    when = lambda c: _stamp(F.col(c))
    wm = F.timestamp_seconds(F.lit(1_700_000_000) + F.floor(F.col("late") / 300) * 300 - 300).cast("timestamp_ntz").alias("wm_ts")
    v = spark.createDataFrame(vs, "user string, url string, at long, referer string, late long").select(
        "user", "url", when("at").alias("ts"), "referer", F.col("url").startswith("g").alias("is_goal"), when("late").alias("arrival_ts"),
        F.col("at").alias("seq"), wm)
    i = spark.createDataFrame(ims, "user string, id long, source_url string, target_url string, at long, late long").select(
        "user", "id", "source_url", "target_url", when("at").alias("ts"), when("late").alias("arrival_ts"), F.col("at").alias("seq"), wm)
    return v, i


def test_jumps_go_where_steps_go(spark, monkeypatch):
    v, i = _random_visits(spark, 5)
    for how in ({}, {"consume_impression": True, "state_ttl": "40 minutes"}):
        out = []
        for first in (10**6, 0):
            monkeypatch.setattr(attribution, "STEPS_FIRST", first)
            out.append(sorted(map(repr, attribute(v, i, **how).collect())))
        assert out[0] == out[1]
    monkeypatch.setattr(attribution, "STEPS_FIRST", 10**6)
    plain = sorted(map(repr, referer_walk(v, i).collect()))
    monkeypatch.setattr(attribution, "STEPS_FIRST", 0)
    assert sorted(map(repr, referer_walk(v, i).collect())) == plain and any("user=None" in r for r in plain)


def test_no_visits_and_no_goals(spark):
    v, i = visits(spark, ("a", "00:10", "s", False, "00:11", 1, "00:00")), imps(spark, (1, "s", "a", "00:05", "00:06", 0, "00:00"))
    for some in (v, v.where("false")):
        for consume in (False, True):
            assert attribute(some, i, consume_impression=consume).count() == 0
    assert referer_walk(v, i).count() == 0 and attribute(v.where("false"), i.where("false")).count() == 0


def test_days_only_for_users_with_many_rows(spark, monkeypatch):
    """Users with few rows take a step in one scan, others by days with the last visit carried over: the same walks."""
    rng, plain = random.Random(11), lambda df: sorted(map(repr, df.collect()))
    at = lambda day, minute: dt.datetime(2024, 1, 1 + day, minute // 60, minute % 60)
    rows, found = [], []
    for seq in range(400):
        day, minute, user = rng.randrange(9), rng.randrange(1300), rng.choice(["u", "v", None])
        rows.append((user, rng.choice("abcdg"), at(day, minute), rng.choice(["a", "b", "c", "d", "s", None]), rng.random() < 0.2,
                     at(day, minute + rng.randrange(90)), seq, at(day, max(0, minute - 60))))
    v = spark.createDataFrame(rows, VISIT)
    i = spark.createDataFrame([("u", n, "s", x, at(n, 5), at(n, 9), 1000 + n, at(n, 0)) for n, x in enumerate("abcd")], IMP)
    old = attribution.last_before
    monkeypatch.setattr(attribution, "last_before", lambda *a: (found.append(a[4] is None), old(*a))[1])
    small = plain(attribute(v, i, consume_impression=True))
    assert small and all(found)
    found.clear()
    monkeypatch.setattr(attribution, "SMALL", 0)
    assert plain(attribute(v, i, consume_impression=True)) == small and not any(found)
