"""Exact top-k inner products by vector-approximation files.

Vectors are cut into blocks of about ``BLOCK_ROWS``.  A block is a small VA-file: each
dimension is cut into 2**``BITS`` cells that hold equally many vectors, and each vector is
kept as its cells' numbers.  For a query, the cells give an upper and a lower bound of every
score; vectors whose upper bound is below the k-th best lower bound are out; the others'
exact vectors are read in the order of their upper bounds until the k-th best exact score is
above the next bound.  A query's results of all blocks meet in one ranking, k rows a block.

Vector blocks stay in place and queries stream past them: one copy of a query for each
block, so the work is the stated query set against all rows, in blocks.

Defined cases: vectors that are null, empty, or hold a null or non-finite component take no
part, and neither do queries without an id; vectors of different lengths do not meet; a
query never meets rows of its own id; rows repeated are candidates of their own; a query
with fewer than k candidates gets them all; scores beyond 64 bits wrap; an empty table gives
an empty result; columns other than id and vector are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.session import materialize

BITS = 5
BLOCK_ROWS = 8192
READ_AT_ONCE = 32
QUERIES_AT_ONCE = 128
FOUND = "query_key long, query_id long, vec_id long, score long"


class Block:
    """A VA-file over integer vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, bits: int = BITS):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        cells = 1 << bits
        # Inner cell edges: the values at equal shares of each sorted dimension.
        ranked = np.sort(self.vectors, axis=0)
        inner = ranked[(np.arange(1, cells) * len(ranked)) // cells]
        self.low = np.vstack([ranked[:1], inner])
        self.high = np.vstack([inner, ranked[-1:]])
        self.cells = np.stack([np.searchsorted(inner[:, j], self.vectors[:, j], side="right")
                               for j in range(vectors.shape[1])], axis=1).astype(np.uint8 if bits <= 8 else np.uint16)

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """Per vector and dimension, the lower and upper edge of its cell."""
        dims = np.arange(self.vectors.shape[1])
        return self.low[self.cells, dims].astype(np.float64), self.high[self.cells, dims].astype(np.float64)

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of all scores: (queries, vectors)."""
        low, high = self.edges()
        up, down = np.maximum(queries, 0).astype(np.float64), np.minimum(queries, 0).astype(np.float64)
        # Exact while sums stay below 2**53; beyond, the slack covers rounding.
        slack = 1e-9 * (np.abs(queries).astype(np.float64) @ np.abs(self.vectors).max(axis=0).astype(np.float64))
        slack = np.where(slack < 2.0 ** 22, 0.0, slack)[:, None]
        return up @ low.T + down @ high.T - slack, up @ high.T + down @ low.T + slack

    def top(self, query_id: int, query: np.ndarray, low: np.ndarray, high: np.ndarray,
            k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best vectors other than the query's own, ties to smaller ids."""
        others = self.ids != query_id
        low, rows = low[others], np.flatnonzero(others)
        if not len(rows):
            return self.ids[:0], self.ids[:0]
        high = high[others]
        if len(rows) > k:
            near = high >= np.partition(low, len(low) - k)[len(low) - k]
            rows, high = rows[near], high[near]
        order = np.argsort(-high, kind="stable")
        rows, high = rows[order], high[order]
        scores = np.empty(0, np.int64)
        for at in range(0, len(rows), READ_AT_ONCE):
            if len(scores) >= k and np.partition(scores, len(scores) - k)[len(scores) - k] > high[at]:
                break
            scores = np.concatenate([scores, self.vectors[rows[at:at + READ_AT_ONCE]] @ query])
        ids = self.ids[rows[:len(scores)]]
        best = np.lexsort((ids, -scores))[:k]
        return ids[best], scores[best]


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def search_blocks(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (block, kind): a block's vectors, then the queries that pass it."""
    at, held, block = None, [], None
    for batch in batches:
        key = np.stack([batch.column("block").to_numpy(), batch.column("dims").to_numpy(),
                        batch.column("kind").to_numpy()])
        cuts = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        steps = [(c, min(c + QUERIES_AT_ONCE, b)) for a, b in zip(cuts, cuts[1:], strict=False)
                 for c in range(a, b, QUERIES_AT_ONCE)]
        for a, b in steps:
            part, (where, dims, kind) = batch.slice(a, b - a), key[:, a].tolist()
            if (where, dims) != at:
                at, held, block = (where, dims), [], None
            ids, vectors = part.column("id").to_numpy(), _matrix(part.column("vector"), dims)
            if kind == 0:
                held.append((ids, vectors))
                continue
            if block is None and held:
                block = Block(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))
                held = []
            if block is not None:
                keys = part.column("key").to_numpy()
                low, high = block.bounds(vectors)
                out: list[list[np.ndarray]] = [[], [], [], []]
                for i in range(len(ids)):
                    found, scores = block.top(int(ids[i]), vectors[i], low[i], high[i], k)
                    for column, values in zip(out, (np.full(len(found), keys[i]), np.full(len(found), ids[i]), found,
                                                    scores), strict=True):
                        column.append(values)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in out],
                                                 ["query_key", "query_id", "vec_id", "score"])


def integer_vectors(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding",
                    scale: float = 1024.0) -> DataFrame:
    """(id, vector) with each component x as floor(scale * x); vectors that take no part are left out."""
    each = F.col(vector)
    odd = F.exists(each, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    whole = vectors.where(each.isNotNull() & F.col(vec_id).isNotNull() & (F.size(each) > 0) & ~odd)
    return whole.select(F.col(vec_id).cast("long").alias("id"), F.transform(
        each, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long")).alias("vector"))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k best; both inputs are (id, array<long> vector).

    Queries that share an id and a vector are one query.
    """
    spark = vectors.sparkSession
    rows = materialize(vectors.select("id", "vector", F.size("vector").alias("dims")))
    blocks = max(1, -(-rows.count() // block_rows))
    columns = ["block", "dims", "kind", "key", "id", "vector"]
    stored = rows.select((F.pmod(F.xxhash64("id", F.lit(8)), F.lit(blocks))).alias("block"), "dims", F.lit(0).alias(
        "kind"), F.lit(0).cast("long").alias("key"), "id", "vector").select(columns)
    asked = queries.select(F.xxhash64("id", "vector").alias("key"), "id", "vector", F.size("vector").alias(
        "dims")).dropDuplicates(["key", "id"]).select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast(
            "long"))).alias("block"), "dims", F.lit(1).alias("kind"), "key", "id", "vector").select(columns)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    met = stored.unionByName(asked).repartition(tasks, "block").sortWithinPartitions("block", "dims", "kind")
    found = met.mapInArrow(lambda batches: search_blocks(batches, k), FOUND)
    best = Window.partitionBy("query_key", "query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
