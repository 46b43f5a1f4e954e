"""Skew-safe ordered scans: running sums, previous and next values per group.

A plain ``Window.partitionBy(key).orderBy(t)`` puts a whole key into one task.
Here each group is cut into sub-buckets of its order time (``bucket`` column,
monotone in the order).  The scan runs per ``(group, bucket)``; what crosses a
bucket's ends (totals, first and last rows) is carried by a second, small window
with one or two rows per group and bucket, so its size is data span / bucket
width, not row count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_U, _C = Window.unboundedPreceding, Window.currentRow


def _cols(xs: Sequence[str | Column]) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def _grouped(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """With the group as one struct ``_by``: never null, so joins keep groups whose keys are null."""
    return df.withColumn("_by", F.struct(*by))


def running_sums(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], bucket: str,
                 sums: dict[str, Column]) -> DataFrame:
    """Add inclusive running sums ``sums[name]`` over ``by`` in ``order`` (bucketed by ``bucket``)."""
    part = Window.partitionBy("_by", bucket)
    w = part.orderBy(*_cols(order)).rowsBetween(_U, _C)
    local = _grouped(df, by).select("*", *[F.sum(c).over(w).alias(f"_r_{n}") for n, c in sums.items()],
                                    *[F.sum(c).over(part).alias(f"_t_{n}") for n, c in sums.items()])
    totals = local.groupBy("_by", bucket).agg(*[F.first(f"_t_{n}").alias(f"_t_{n}") for n in sums])
    wb = Window.partitionBy("_by").orderBy(bucket).rowsBetween(_U, -1)
    offsets = totals.select("_by", bucket, *[F.coalesce(F.sum(f"_t_{n}").over(wb), F.lit(0)).alias(f"_o_{n}")
                                             for n in sums])
    out = local.drop(*[f"_t_{n}" for n in sums]).join(offsets, ["_by", bucket], "inner").drop("_by")
    for n in sums:
        out = out.withColumn(n, F.col(f"_r_{n}") + F.col(f"_o_{n}")).drop(f"_r_{n}", f"_o_{n}")
    return out


def with_neighbors(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], bucket: str,
                   value: str, prev_out: str | None, next_out: str | None) -> DataFrame:
    """``prev_out`` / ``next_out`` = ``value`` of the previous / next row of the group in ``order`` (NULL at the ends).

    Two windows and no join: the first, by (group, bucket), finds neighbours inside buckets;
    the second sees only the first and last rows of each bucket together in one group, two
    rows per bucket, and finds the neighbours across buckets.  Other rows keep to their
    (group, bucket) there, so no task holds a whole group.
    """
    cols = _cols(order)
    inner = Window.partitionBy(*by, bucket).orderBy(*cols)
    boxed = F.struct(F.col(value).alias("v"))
    df = df.select("*", F.lag(boxed).over(inner).alias("_ip"), F.lead(boxed).over(inner).alias("_in"))
    edge = F.col("_ip").isNull() | F.col("_in").isNull()
    df = df.withColumn("_part", F.when(edge, F.lit(None).cast("long")).otherwise(F.col(bucket).cast("long")))
    outer = Window.partitionBy(*by, "_part").orderBy(*cols)
    picks = []
    if prev_out:
        picks.append(F.coalesce("_ip", F.lag(boxed).over(outer))["v"].alias(prev_out))
    if next_out:
        picks.append(F.coalesce("_in", F.lead(boxed).over(outer))["v"].alias(next_out))
    return df.select("*", *picks).drop("_ip", "_in", "_part")


def with_prev(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], bucket: str,
              value: str, out: str) -> DataFrame:
    """``out`` = ``value`` of the previous row of the group in ``order`` (NULL for the first)."""
    return with_neighbors(df, by, order, bucket, value, out, None)


def with_next(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], bucket: str,
              value: str, out: str) -> DataFrame:
    """``out`` = ``value`` of the next row of the group in ``order`` (NULL for the last)."""
    return with_neighbors(df, by, order, bucket, value, None, out)


def _carried(df: DataFrame, by: Sequence[str], order: Sequence[Column], bucket: str, later: bool, value: str, out: str,
             best) -> DataFrame:
    """``best`` of ``value`` over this row and all before it in ``order``; frames start at the first row, so a pass is linear."""
    df = _grouped(df, by).repartition("_by", bucket)
    local = df.select("*", best(value).over(Window.partitionBy("_by", bucket).orderBy(*order).rowsBetween(_U, _C)).alias(out))
    ends = local.groupBy("_by", bucket).agg(best(value).alias("_e"))
    at = F.col(bucket).desc() if later else F.col(bucket).asc()
    carry = ends.select("_by", bucket, best("_e").over(
        Window.partitionBy("_by").orderBy(at).rowsBetween(_U, -1)).alias("_carry"))
    res = local.join(carry, ["_by", bucket], "inner").drop("_by")
    return res.withColumn(out, F.coalesce(F.col(out), F.col("_carry"))).drop("_carry")


def first_at_or_after(df: DataFrame, by: Sequence[str], time: str, tie: str, bucket: str, value: str,
                      out: str) -> DataFrame:
    """``out`` = least non-null ``value`` among rows of the group at or after this row.

    Rows of equal time count if their ``tie`` is not below this row's.
    """
    return _carried(df, by, [F.col(time).desc(), F.col(tie).desc()], bucket, True, value, out, F.min)


def last_at_or_before(df: DataFrame, by: Sequence[str], time: str, bucket: str, value: str, out: str) -> DataFrame:
    """``out`` = greatest non-null ``value`` among rows of the group at or before this row (``value`` rises with ``time``)."""
    return _carried(df, by, [F.col(time).asc()], bucket, False, value, out, F.max)


def last_before(asked: DataFrame, there: DataFrame, by: str, order: str, bucket, value: str, out: str) -> DataFrame:
    """``asked`` with ``out``: ``value`` of the last row of ``there`` in the same group that is before it in ``order`` (null if none).

    Both have a group ``by`` (a struct) and ``order``; ``bucket(order)`` is monotone.  One pass over
    both together, spread by (group, bucket): linear in their rows, however many share a group.
    Without a ``bucket`` a group is one task's, and nothing is carried: for groups known to be small.
    """
    row, none = F.struct(*asked.columns), F.lit(None)
    kind = there.select(value).schema[value].dataType
    a = asked.select(by, F.col(order).alias("_o"), row.alias("_row"), none.cast(kind).alias("_v"))
    t = there.select(by, F.col(order).alias("_o"), none.cast(a.schema["_row"].dataType).alias("_row"), F.col(value).alias("_v"))
    both = a.unionByName(t)
    # Of equal order the asked row comes first: only what is before it counts.
    if bucket is None:
        w = Window.partitionBy(by).orderBy("_o", F.col("_row").isNull()).rowsBetween(_U, _C)
        near = both.select("_row", F.last("_v", ignorenulls=True).over(w).alias("_near"))
        return near.where(F.col("_row").isNotNull()).select("_row.*", F.col("_near").alias(out))
    both = both.withColumn("_b", bucket(F.col("_o"))).repartition(by, "_b")
    w = Window.partitionBy(by, "_b").orderBy("_o", F.col("_row").isNull()).rowsBetween(_U, _C)
    local = both.select(by, "_b", "_o", "_row", "_v", F.last("_v", ignorenulls=True).over(w).alias("_near"))
    ends = local.groupBy(by, "_b").agg(F.max_by("_v", F.when(F.col("_row").isNull(), F.col("_o"))).alias("_e"))
    carry = ends.select(by, "_b", F.last("_e", ignorenulls=True).over(
        Window.partitionBy(by).orderBy("_b").rowsBetween(_U, -1)).alias("_carry"))
    found = local.where(F.col("_row").isNotNull()).join(carry, [by, "_b"])
    return found.select("_row.*", F.coalesce("_near", "_carry").alias(out))
