"""Mixing sources to target weights by a time-varying curriculum.

A source's share of the token stream follows a weight that moves linearly over training
time t in [0, 1], from (1 - slope) to (1 + slope) times its mean.  Its cumulative demand is
the integral target * (t + slope * (t*t - t)); the k-th word of a source gets the time at
which that demand reaches k, the closed-form inverse of the integral.  Documents go in
hashed order, pass after pass, until the target is used up; the whole mix is range-sorted
by position.

Scale: a document's place in its source is a running sum.  It is taken inside (source,
hash bucket) groups, whose offsets come from a table with one row per bucket, so a source
that holds a third of all rows is spread over ``16 ** BUCKET_DIGITS`` groups.

Defined cases: null text has size 0; null is a source of its own, ordered last; documents
of size 0 are never taken; a source without words gets target 0; rows repeated exactly are
documents of their own; an empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.textops import whole, words
from eventide.session import materialize

#: Weights and slopes by the source's place in code point order, repeating.
WEIGHTS = (3, 1, 2)
SLOPES = (-0.5, 0.0, 0.5)
SHARE = 1.5
MAX_EPOCHS = 2
BUCKET_DIGITS = 3


def _cycled(place: Column, values: tuple) -> Column:
    return F.element_at(F.array(*[F.lit(float(v)) for v in values]), (place % len(values) + 1).cast("int"))


def source_targets(sizes: DataFrame, share: float = SHARE, max_epochs: int = MAX_EPOCHS,
                   weights: tuple = WEIGHTS, slopes: tuple = SLOPES) -> DataFrame:
    """From (source, size): source, source_size, target, slope.

    Targets are proportional to weights, none above ``max_epochs`` times its source.  With
    the sources in order of that limit per weight, the capped ones are a prefix: source i is
    capped if the words left after the limits before it, by weight, exceed its own limit.
    """
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), "source")
    s = s.withColumn("place", F.row_number().over(order) - 1)
    s = s.select("source", "source_size", _cycled(F.col("place"), slopes).alias("slope"),
                 _cycled(F.col("place"), weights).alias("weight"),
                 (max_epochs * F.col("source_size")).cast("double").alias("limit"), "place")
    ratio = Window.orderBy(F.col("limit") / F.col("weight"), "place")
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = ratio.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(every) * F.lit(float(share)) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    s = s.withColumn("level", left / F.sum("weight").over(
        ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    at = F.col("limit") / F.col("weight")
    free = F.min(F.when(at > F.col("level"), F.struct(at.alias("at"), "place", "level"))).over(every)["level"]
    return s.select("source", "source_size", "slope", F.when(free.isNull(), F.col("limit")).otherwise(
        F.least("limit", free * F.col("weight"))).alias("target"))


def mix_plan(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text",
             share: float = SHARE, max_epochs: int = MAX_EPOCHS,
             weights: tuple = WEIGHTS, slopes: tuple = SLOPES) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, ``passes`` and ``positions``.

    ``passes`` is how often the mix takes the document, ``positions`` the training times
    in [0, 1] of those passes.  The last, partial pass takes the documents whose middle
    word lies before its end.  The text is read once, for its size; nothing after that
    carries it.
    """
    sizes = materialize(docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
        F.size(words(whole(text))).cast("long").alias("size"),
        F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).alias("key"))
        .withColumn("bucket", F.substring("key", 1, BUCKET_DIGITS)))
    targets = source_targets(sizes.select("source", "size"), share, max_epochs, weights, slopes)
    totals = sizes.groupBy("source", "bucket").agg(F.sum("size").alias("n"))
    ahead = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("source", "bucket", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("offset"))
    offsets = offsets.alias("o").join(targets.alias("t"), F.col("o.source").eqNullSafe(F.col("t.source"))).select(
        F.col("o.source").alias("_s"), F.col("o.bucket").alias("_b"), "offset", "source_size", "target", "slope")
    inner = (Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    d = sizes.withColumn("inner", F.sum("size").over(inner) - F.col("size"))
    d = d.join(offsets, d["source"].eqNullSafe(F.col("_s")) & (d["bucket"] == F.col("_b")))
    d = d.withColumn("start", F.col("offset") + F.col("inner"))
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.col("target") - full * F.col("source_size")
    last = (2 * F.col("start") + F.col("size")).cast("double") <= 2 * rest
    d = d.withColumn("passes", F.when(F.col("size") > 0, (full + F.when(
        last & (full < max_epochs), 1).otherwise(0)).cast("int")).otherwise(F.lit(0)))
    middle = lambda p: (p * F.col("source_size") + F.col("start") + F.col("size") / 2) / F.col("target")
    d = d.withColumn("positions", F.when(F.col("passes") > 0, F.transform(
        F.sequence(F.lit(0), F.col("passes") - 1), lambda p: time_of(F.least(middle(p), F.lit(1.0)), F.col("slope"))))
        .otherwise(F.array().cast("array<double>")))
    return d.select("doc_id", "source", "size", "source_size", "target", "passes", "positions")


def time_of(used: Column, slope: Column) -> Column:
    """The t in [0, 1] at which the demand t + slope * (t*t - t) reaches ``used``."""
    a = 1 - slope
    return F.when(slope == 0, used).otherwise((F.sqrt(a * a + 4 * slope * used) - a) / (2 * slope))


def mixed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The training order: ``docs``' rows, each as often as the mix takes it, range-sorted by position.

    The plan joins the rows by doc_id and, where rows share one, by their order of size.
    Text moves twice: to meet its positions, and to its range of positions.
    """
    name = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit(""))
    nth = lambda key, size: F.row_number().over(Window.partitionBy(key).orderBy(size))
    plan = mix_plan(docs, doc_id=doc_id, text=text, **options).select(name("doc_id").alias("_id"), "size", "positions")
    plan = plan.withColumn("_nth", nth("_id", "size"))
    # The row travels as one struct, so its columns may have any names.
    rows = docs.select(F.struct("*").alias("row"), name(doc_id).alias("_doc"), F.size(words(whole(text))).alias("_words"))
    rows = rows.withColumn("_n", nth("_doc", "_words"))
    # Only the id is an equi-key, so the window above and the join share one shuffle of the text.
    taken = rows.join(plan, (F.col("_doc") == F.col("_id")) & (F.col("_n") - F.col("_nth") == 0))
    taken = taken.select("row", F.explode("positions").alias("position"))
    return taken.repartitionByRange("position").sortWithinPartitions("position").select(
        *[F.col("row").getField(c).alias(c) for c in docs.columns])
