"""Nearest position of a group whose value is beyond a threshold, by a tree of block maxima.

Positions of a group are numbered from 0.  ``FAN`` neighbours form a block, ``FAN`` blocks a
block of the next level, and every block knows its greatest value.  A question climbs from its
own block until a sibling's maximum is beyond its threshold, then goes down to the position.
Each step deals blocks and their questions by (group, block) and answers them block by block
(``_answers``), and only questions that are still open take the next one.  A block that many
questions ask is dealt to several tasks, each with its ``FAN`` entries and about ``ASKED`` of the
questions, so rows are written about once a step, and no group gathers in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.session import materialize

FAN = 256
#: Questions to one block in one task.
ASKED = 1 << 14


def _ranks(fields: list[np.ndarray]) -> np.ndarray:
    """Dense ranks of rows compared field by field."""
    order = np.lexsort(fields[::-1])
    new = np.zeros(len(order), bool)
    for f in fields:
        new[1:] |= f[order[1:]] != f[order[:-1]]
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.cumsum(new)
    return ranks


def _last_above(values: np.ndarray, end: np.ndarray, over: np.ndarray) -> np.ndarray:
    """Per question the last index before ``end`` whose value is above ``over``, or -1: ranges without one are skipped, the longest first."""
    tops = [values]
    while 2 ** len(tops) <= len(values):
        half = 2 ** (len(tops) - 1)
        tops.append(np.maximum(tops[-1][:-half], tops[-1][half:]))
    for k in reversed(range(len(tops))):
        at = end - 2 ** k
        end = np.where((at >= 0) & (tops[k][np.maximum(at, 0)] <= over), at, end)
    return end - 1


def _answers(batches: Iterator[pa.RecordBatch], n: int, back: bool, out: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows by block: a mark (``_kind`` 0), its entries in order (1), its questions (2); ``n`` fields are compared.

    Yields the questions with ``_hit`` and, if asked for, the ``_value`` there.  Memory: a block and a batch.
    """
    entries: list[pa.RecordBatch] = []
    for batch in batches:
        kinds = batch.column("_kind").to_numpy()
        cuts = np.flatnonzero((kinds[1:] != kinds[:-1]) | (kinds[1:] == 0)) + 1
        for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(kinds)], strict=True):
            part = batch.slice(begin, end - begin)
            if kinds[begin] == 0:
                entries = []
            elif kinds[begin] == 1:
                entries.append(part)
            else:
                block = pa.Table.from_batches(entries, batch.schema).combine_chunks()
                m = block.num_rows
                if m:
                    ranks = _ranks([np.concatenate([block[f"_x{k}"].to_numpy(), part.column(f"_x{k}").to_numpy()]) for k in range(n)])
                    base = block["_i"][0].as_py()
                    bound = np.clip(part.column("_i").to_numpy() - base, 0, m)
                    hit = _last_above(ranks[:m], bound, ranks[m:]) if back else m - 1 - _last_above(ranks[:m][::-1], m - bound, ranks[m:])
                    none = (hit < 0) | (hit >= m)
                else:
                    base, hit, none = 0, np.zeros(len(part), np.int64), np.ones(len(part), bool)
                columns = [*part.column("_q").flatten(), pa.array(hit + base, pa.int64(), mask=none)]
                if "_value" in out:
                    columns.append(block["_m"].combine_chunks().take(pa.array(hit, pa.int64(), mask=none)))
                yield pa.RecordBatch.from_arrays(columns, out)


class Maxima:
    """Blocks over ``table``: ``group`` (a struct), ``number`` (0, 1, ...) and a struct ``value`` of longs, none of them null."""

    def __init__(self, table: DataFrame, group: str, number: str, value: str):
        self.group, self.fan = group, FAN
        rows = table.select(group, F.col(number).cast("long").alias("_i"), F.col(value).alias("_m"))
        self.levels: list[DataFrame] = []
        while True:
            self.levels.append(rows.withColumn("_block", F.floor(F.col("_i") / self.fan).cast("long")))
            if rows.where(F.col("_i") >= self.fan).isEmpty():
                break
            rows = materialize(self.levels[-1].groupBy(group, F.col("_block").alias("_i")).agg(F.max("_m").alias("_m")))

    def _pick(self, asked: DataFrame, level: int, back: bool, beyond: Column, bound: Column) -> DataFrame:
        """``asked`` with ``_hit``, the number of the nearest entry of block ``_block`` beyond the threshold (null if none).

        Looked at are entries before ``bound`` (``back``), or from it on.  At level 0 also ``_value``, the entry's.
        """
        place, schema, none = [self.group, "_block"], asked.schema, F.lit(None)
        over = asked.select(beyond.alias("_x")).schema["_x"].dataType.names
        value = self.levels[level].schema["_m"].dataType
        fields = value.names[:len(over)]

        def row(kind: int, i: Column, compared: list[Column], m: Column, question: Column) -> list[Column]:
            return [F.lit(kind).alias("_kind"), i.cast("long").alias("_i"), *[c.cast("long").alias(f"_x{k}") for k, c in enumerate(compared)],
                    *([m.cast(value).alias("_m")] if level == 0 else []), question.cast(schema).alias("_q")]

        busy = asked.groupBy(*place).agg((F.floor(F.count(F.lit(1)) / ASKED) + 1).alias("_parts"))
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1)).alias("_part")
        marks = busy.select(*place, every, *row(0, none, [none] * len(over), none, none))
        entries = self.levels[level].join(busy, place).select(*place, every, *row(1, F.col("_i"), [F.col("_m")[f] for f in fields], F.col("_m"), none))
        questions = asked.join(busy, place).select(*place, F.pmod(F.xxhash64(beyond), F.col("_parts")).alias("_part"), *row(
            2, bound, [beyond[f] for f in over], none, F.struct(*schema.names)))
        units = marks.unionByName(entries).unionByName(questions)
        units = units.repartition(*place, "_part").sortWithinPartitions(*place, "_part", "_kind", "_i")
        result = T.StructType([*schema, T.StructField("_hit", T.LongType()), *([T.StructField("_value", value)] if level == 0 else [])])
        n, names = len(over), result.names
        return units.drop(*place, "_part").mapInArrow(lambda batches: _answers(batches, n, back, names), result)

    def nearest(self, asked: DataFrame, number: str, beyond: Column, back: bool, out: str) -> DataFrame:
        """``asked`` with ``out`` (number, value): the nearest position at or before (``back``) or after whose value is beyond ``beyond``.

        ``beyond`` is a struct of longs, compared with the first fields of the values, as many as
        it has.  Questions without an answer have null fields in ``out``.
        """
        columns, here = asked.columns, F.col(number).cast("long")
        got = materialize(self._pick(asked.withColumn("_block", F.floor(here / self.fan).cast("long")), 0, back, beyond, here + 1 if back else here))
        done, hits = [got.where("_hit IS NOT NULL")], []
        for level in range(1, len(self.levels)):
            still = got.where("_hit IS NULL")
            if still.isEmpty():
                break
            at = F.col("_at")
            up = still.select(*columns, F.col("_block").alias("_at")).withColumn("_block", F.floor(at / self.fan).cast("long"))
            got = materialize(self._pick(up, level, back, beyond, at if back else at + 1).drop("_at"))
            hits.append((level, got.where("_hit IS NOT NULL")))
        value = F.lit(None).cast(self.levels[0].schema["_m"].dataType).alias("_value")
        done.append(got.where("_hit IS NULL").select(*columns, F.lit(None).cast("long").alias("_hit"), value))
        # From the highest level down: a hit is a block one level below.
        down: DataFrame | None = None
        for level, found in reversed(hits):
            found = found.select(*columns, "_hit")
            down = found if down is None else down.select(*columns, "_hit").unionByName(found)
            all_of = F.lit(2**62 if back else 0).cast("long")
            down = materialize(self._pick(down.withColumn("_block", F.col("_hit")).drop("_hit"), level - 1, back, beyond, all_of))
        parts = [p.select(*columns, "_hit", "_value") for p in [*done, *([down] if down is not None else [])]]
        return reduce(DataFrame.unionByName, parts).select(*columns, F.struct(
            F.col("_hit").alias("number"), F.col("_value").alias("value")).alias(out))
