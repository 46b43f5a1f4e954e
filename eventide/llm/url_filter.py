"""URL filters: longest-match rules, then logistic regression on hashed character n-grams.

The model reads host and path as n-grams of ``SIZES`` characters, hashed to ``BUCKETS``
weights, host and path apart.  It is fitted by full-batch gradient steps over a labelled
URL table; each step is one scan of the labelled rows and one partially aggregated sum per
weight.  Only the weights, a fixed number, pass through the driver.  Scoring is one
expression per row: no join, no shuffle.

``filter_urls`` labels the training table with the rules themselves: of the URLs that a
rule decides, the first ``MAX_LABELLED`` in hashed order (a documented bound on fitting;
everything is scored).

Defined cases: a null URL or one without ``://`` has empty host and path, matches no rule,
and gets the model's verdict on no n-grams (its bias); very long URLs cost time in
proportion to their length; without labelled rows all weights stay 0 and the verdict is
``allow``; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.llm.textops import whole
from eventide.session import materialize

SIZES = (3, 4)
BUCKETS = 2048
STEPS = 20
RATE = 16.0
DECAY = 1e-4
MAX_LABELLED = 4000

#: Fixed values: (verdict, host, path) of the rules.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))

#: ASCII letters for lower-casing.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: str | Column) -> tuple[Column, Column]:
    u = whole(url)
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return host, path


def best_rule(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits the host or a parent of it and the path's start."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def ngram_buckets(host: Column, path: Column, sizes: tuple = SIZES, buckets: int = BUCKETS) -> Column:
    """The weight number (from 1) of every n-gram of ``^host$`` and ``^path$``."""
    def grams(s: Column, part: str) -> Column:
        chars = F.split(F.concat(F.lit("^"), s, F.lit("$")), "")
        return F.concat(*[F.transform(
            F.sequence(F.lit(1), F.greatest(F.size(chars) - n + 1, F.lit(1))),
            lambda i, n=n: (F.pmod(F.xxhash64(F.lit(part), F.slice(chars, i, F.lit(n))), F.lit(buckets)) + 1).cast("int"))
            for n in sizes])
    none = F.array().cast("array<int>")
    return F.concat(F.when(host != "", grams(host, "host")).otherwise(none),
                    F.when(path != "", grams(path, "path")).otherwise(none))


def logit(grams: Column, weights: list[float], bias: float) -> Column:
    table = F.array(*[F.lit(float(w)) for w in weights])
    total = F.aggregate(grams, F.lit(0.0), lambda acc, g: acc + F.element_at(table, g))
    return F.lit(float(bias)) + total / F.sqrt(F.greatest(F.size(grams), F.lit(1)).cast("double"))


def train(labelled: DataFrame, steps: int = STEPS, rate: float = RATE, decay: float = DECAY,
          buckets: int = BUCKETS) -> tuple[list[float], float]:
    """Weights and bias from (host, path, label 0 or 1); classes weigh the same in total."""
    rows = materialize(labelled.select(ngram_buckets(F.col("host"), F.col("path"), buckets=buckets).alias("grams"),
                                       F.col("label").cast("double").alias("label")))
    n, ones = rows.agg(F.count("label"), F.sum("label")).first()
    weights, bias = [0.0] * buckets, 0.0
    if not n or not ones or ones == n:
        return weights, (0.0 if not n or not ones else 1.0)
    balance = F.when(F.col("label") > 0, F.lit(0.5 / ones)).otherwise(F.lit(0.5 / (n - ones)))
    for _ in range(steps):
        wrong = (F.col("label") - 1 / (1 + F.exp(-logit(F.col("grams"), weights, bias)))) * balance
        step = rows.select("grams", wrong.alias("g"), (
            wrong / F.sqrt(F.greatest(F.size("grams"), F.lit(1)).cast("double"))).alias("each"))
        step = step.select(F.explode(F.concat(
            F.array(F.struct(F.lit(0).alias("k"), F.col("g").alias("v"))),
            F.transform("grams", lambda k: F.struct(k.alias("k"), F.col("each").alias("v"))))).alias("e"))
        moved = {r["k"]: r["v"] for r in step.groupBy("e.k").agg(F.sum("e.v").alias("v")).collect()}
        weights = [w * (1 - rate * decay) + rate * moved.get(i + 1, 0.0) for i, w in enumerate(weights)]
        bias += rate * moved.get(0, 0.0) / 4
    # Sums arrive in any order: rounding keeps a rerun from moving a verdict by the last bit.
    return [round(w, 6) for w in weights], round(bias, 6)


def judged(urls: DataFrame, url: str = "url", rules: tuple = RULES) -> DataFrame:
    """``urls`` plus host, path, rule and the rule's verdict (null where none fits)."""
    host, path = host_and_path(url)
    d = urls.withColumn("host", host).withColumn("path", path)
    rule, verdict = best_rule(F.col("host"), F.col("path"), rules)
    return d.withColumn("rule", rule).withColumn("verdict", verdict)


def filter_urls(urls: DataFrame, labelled: DataFrame | None = None, rules: tuple = RULES, url: str = "url",
                max_labelled: int = MAX_LABELLED) -> DataFrame:
    """``urls`` plus host, path, rule, verdict and the model's ``score`` (over 0.5: block)."""
    d = judged(urls, url, rules)
    if labelled is None:
        small = (d.where(F.col("rule").isNotNull()).groupBy("host", "path").agg(F.min("verdict").alias("verdict"))
                 .orderBy(F.xxhash64("host", "path"), "host", "path").limit(max_labelled))
        labelled = small.select("host", "path", (F.col("verdict") == "block").cast("int").alias("label"))
    else:
        host, path = host_and_path("url")
        labelled = labelled.select(host.alias("host"), path.alias("path"), "label")
    weights, bias = train(labelled)
    score = 1 / (1 + F.exp(-logit(ngram_buckets(F.col("host"), F.col("path")), weights, bias)))
    d = d.withColumn("score", F.round(score, 6))
    return d.withColumn("verdict", F.coalesce("verdict", F.when(F.col("score") > 0.5, "block").otherwise("allow")))
