"""Bucketed scans against a brute-force pandas computation, including one hot key."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from eventide.plans.scan import running_sums, with_next, with_prev


def _frame(spark, n=3000, seed=7):
    rng = np.random.default_rng(seed)
    keys = np.where(rng.random(n) < 0.4, "hot", rng.choice(["a", "b", "c", "d"], n))
    pdf = pd.DataFrame({"k": keys, "t": rng.integers(0, 10_000, n), "id": np.arange(n), "v": rng.integers(-5, 50, n)})
    df = spark.createDataFrame(pdf).withColumn("b", F.floor(F.col("t") / 700))
    return pdf.sort_values(["k", "t", "id"]).reset_index(drop=True), df


def test_running_sums(spark):
    pdf, df = _frame(spark)
    got = running_sums(df, ["k"], ["t", "id"], "b", {"rs": F.col("v"), "rn": F.lit(1)}).toPandas()
    got = got.sort_values(["k", "t", "id"]).reset_index(drop=True)
    exp = pdf.groupby("k")["v"].cumsum()
    assert (got["rs"].to_numpy() == exp.to_numpy()).all()
    assert (got["rn"].to_numpy() == pdf.groupby("k").cumcount().to_numpy() + 1).all()


def test_prev_and_next(spark):
    pdf, df = _frame(spark)
    got = with_next(with_prev(df, ["k"], ["t", "id"], "b", "id", "p"), ["k"], ["t", "id"], "b", "id", "n").toPandas()
    got = got.sort_values(["k", "t", "id"]).reset_index(drop=True)
    exp_p = pdf.groupby("k")["id"].shift(1)
    exp_n = pdf.groupby("k")["id"].shift(-1)
    assert got["p"].fillna(-1).astype(int).tolist() == exp_p.fillna(-1).astype(int).tolist()
    assert got["n"].fillna(-1).astype(int).tolist() == exp_n.fillna(-1).astype(int).tolist()


def test_neighbors(spark):
    from eventide.plans.scan import with_neighbors
    pdf, df = _frame(spark, seed=11)
    got = with_neighbors(df, ["k"], ["t", "id"], "b", "id", "p", "n").toPandas()
    got = got.sort_values(["k", "t", "id"]).reset_index(drop=True)
    assert got["p"].fillna(-1).astype(int).tolist() == pdf.groupby("k")["id"].shift(1).fillna(-1).astype(int).tolist()
    assert got["n"].fillna(-1).astype(int).tolist() == pdf.groupby("k")["id"].shift(-1).fillna(-1).astype(int).tolist()


def test_groups_without_a_key_keep_their_rows(spark):
    """The null group is a group like any other in every scan."""
    from eventide.plans.scan import first_at_or_after, last_at_or_before, last_before, with_neighbors
    _, named = _frame(spark, n=600, seed=3)
    named = named.withColumn("v", F.when(F.col("id") % 3 == 0, F.col("t")))
    bare = named.withColumn("k", F.when(F.col("k") != "hot", F.col("k")))

    def results(df):
        g = df.withColumn("g", F.struct("k")).withColumn("o", F.struct("t", "id"))
        return [running_sums(df, ["k"], ["t", "id"], "b", {"rs": F.col("id")}).select("id", "rs"),
                with_neighbors(df, ["k"], ["t", "id"], "b", "id", "p", "n").select("id", "p", "n"),
                first_at_or_after(df, ["k"], "t", "id", "b", "v", "f").select("id", "f"),
                last_at_or_before(df, ["k"], "t", "b", "v", "l").groupBy("t").agg(F.max("l")),
                last_before(g.select("id", "g", "o"), g.select("g", "o", F.struct("id").alias("x")), "g", "o", lambda o: F.floor(
                    o["t"] / 700), "x", "w").select("id", "w.id")]
    for a, b in zip(results(named), results(bare), strict=True):
        rows = sorted(map(tuple, a.collect()), key=repr)
        assert rows == sorted(map(tuple, b.collect()), key=repr) and rows


def test_last_before(spark):
    from eventide.plans.scan import last_before
    pdf, df = _frame(spark, seed=5)
    g = df.withColumn("g", F.struct("k")).withColumn("o", F.struct("t", "id"))
    asked, there = g.where("id % 2 = 0").select("id", "g", "o"), g.where("id % 3 = 0").select("g", "o", F.struct("id").alias("x"))
    got = {r[0]: r[1] for r in last_before(asked, there, "g", "o", lambda o: F.floor(o["t"] / 700), "x", "w").select("id", "w.id").collect()}
    want = {}
    for _, part in pdf.groupby("k"):
        last = None
        for i in part["id"]:
            if i % 2 == 0:
                want[i] = last
            if i % 3 == 0:
                last = i
    assert got == want


def test_nearest_beyond(spark):
    """The tree of block maxima against a loop, with blocks of four: several levels, both directions, no answer."""
    from eventide.plans import nearest
    rng = np.random.default_rng(2)
    old, nearest.FAN = nearest.FAN, 4
    try:
        rows = [(k, i, int(rng.integers(0, 1000))) for k, n in (("a", 300), (None, 90), ("b", 1)) for i in range(n)]
        df = spark.createDataFrame(rows, "k string, i long, v long").select(F.struct("k").alias("g"), "i", F.struct("v").alias("m"), "v")
        ask = df.select("g", F.col("i").alias("n"), (F.col("v") + F.col("i") % 500).alias("over"))
        tree = nearest.Maxima(df, "g", "i", "m")
        values = {(k, i): v for k, i, v in rows}
        for back in (True, False):
            got = tree.nearest(ask, "n", F.struct(F.col("over").alias("v")), back, "hit").collect()
            assert len(got) == len(rows)
            for r in got:
                at, over = r.n, values[r.g.k, r.n] + r.n % 500
                while (r.g.k, at) in values and values[r.g.k, at] <= over:
                    at += -1 if back else 1
                want = at if (r.g.k, at) in values else None
                assert r.hit.number == want and (want is None or r.hit.value.v == values[r.g.k, want])
    finally:
        nearest.FAN = old


def test_nearest_of_a_block_that_many_ask(spark, monkeypatch):
    """A block's questions are dealt to several tasks; the answers, equal rows included, are those of a loop."""
    from eventide.plans import nearest
    monkeypatch.setattr(nearest, "FAN", 4)
    monkeypatch.setattr(nearest, "ASKED", 8)
    table = spark.range(1, 41).select(F.struct(F.lit(None).cast("string").alias("k")).alias("g"), (F.col("id") - 1).alias("i"), F.struct(
        (100 - F.col("id")).alias("v"), F.col("id").alias("w")).alias("m"))
    ask = spark.range(300).select(F.struct(F.lit(None).cast("string").alias("k")).alias("g"), F.lit(39).alias("n"), (
        F.col("id") % 50 + 50).alias("over"))
    got = nearest.Maxima(table, "g", "i", "m").nearest(ask, "n", F.struct(F.col("over").alias("v")), True, "hit").collect()
    assert len(got) == 300
    for r in got:
        want = max((i for i in range(40) if 99 - i > r.over), default=None)
        assert r.hit.number == want and (r.hit.value is None) == (want is None) and (want is None or r.hit.value.w == want + 1)
