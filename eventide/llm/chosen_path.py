"""N-gram Jaccard join by chosen paths, and the classes it links.

A document is the set of hashed shingles of five words (all its words, if fewer).  Equal sets
are collapsed first.  Each distinct set keeps ``SKETCH`` minimum hash values, whose agreement
estimates the Jaccard similarity.  A run splits all sets by sampled shared tokens: its root
takes one sketch position that no other run's root takes, every node below it samples each
position with probability 1 / (SIMILAR * SKETCH), and sets that agree at a sampled position
go to one child.  Buckets of at most ``LEAF`` sets,
those whose sets are alike already (splitting would only lose pairs), and all buckets at
``DEPTH`` are compared by brute force, large ones in blocks.  Runs are repeated
until a pair at exactly ``SIMILAR`` is found with probability ``RECALL`` even if all its
buckets are split down to ``DEPTH``, sketches that disagree too often included.

Brute force compares sketches, keeps the pairs above the estimate's tolerance, and verifies
these on the whole sets.  A pair that meets in several leaves counts in the smallest one
only, which both rows know.  Pairs never become rows: a block returns one row per set, with
its links and its root in the block's spanning forest.  Classes are the connected components
of those forests, found by alternating large-star and small-star steps.

Scale: copies are collapsed with partial aggregation; a block is bounded in rows and in
shingles; hot buckets are split by the recursion and then by blocks; joins that carry hot
keys are plain equi-joins that AQE can split.

Defined cases: null and empty texts have no shingles, no links, and are classes of their
own; whole texts are read; an equal set is a link (copies count as links without being
paired); rows that share a doc_id are told apart by their text; an empty table gives an empty
result; columns other than id and text are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.bpe import rows_of
from eventide.llm.warm import let_go
from eventide.session import materialize

WORDS, SIMILAR, RECALL = 5, 0.8, 0.995
SKETCH, DEPTH, LEAF = 64, 3, 128
BLOCK_SETS, BLOCK_SHINGLES = 1024, 1 << 20
#: Agreeing sketch positions below which a pair at SIMILAR falls about once in two thousand.
TOLERATED = 40
#: A large bucket whose sets agree at this share of LOOKED_AT sketch positions is compared as it is.
ALIKE, LOOKED_AT = 0.5, 4
WORDS_KEPT = 1 << 17
ODD = np.uint64(0x9E3779B97F4A7C15)
PATHS = np.random.default_rng(11).integers(1, 1 << 63, 2 * SKETCH, dtype=np.uint64).reshape(2, SKETCH) | np.uint64(1)


def missed(runs: int, depth: int = DEPTH) -> float:
    """The chance that two sets at SIMILAR are not found by ``runs`` runs when their buckets are split down to ``depth``."""
    total = 0.0
    for agree in range(SKETCH + 1):
        p = 1.0
        for _ in range(depth - 1):
            # Nodes below the root: a branching process over the positions at which the two agree.
            p = 1 - (1 - p / (SIMILAR * SKETCH)) ** agree
        apart = sum(math.comb(agree, k) * math.comb(SKETCH - agree, runs - k) * (1 - p) ** k for k in range(runs + 1))
        chance = math.comb(SKETCH, agree) * SIMILAR ** agree * (1 - SIMILAR) ** (SKETCH - agree)
        total += chance * (apart / math.comb(SKETCH, runs) if agree >= TOLERATED else 1.0)
    return total


RUNS = next(n for n in range(1, SKETCH + 1) if missed(n) <= 1 - RECALL)
#: The position of each run's root: the last ones, since the first LOOKED_AT judge whether a bucket is alike.
ROOTS = np.arange(SKETCH - RUNS, SKETCH)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = (x ^ x >> np.uint64(31)) * ODD
    x = (x ^ x >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ x >> np.uint64(32)


# ---------------------------------------------------------------- shingles and sketches
class Shingler:
    """Hashed shingles of whole texts; word hashes are kept in a bounded table."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def sets(self, texts: list[str | None]) -> list[np.ndarray]:
        """Sorted distinct shingle hashes of each text."""
        found = [(t or "").encode().split() for t in texts]
        new = set().union(*found).difference(self.known)
        if len(self.known) + len(new) > WORDS_KEPT:
            self.known = {}
            new = set().union(*found)
        self.known.update(zip(new, map(xxhash.xxh64_intdigest, new), strict=True))
        out = []
        for words in found:
            h = np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
            n = min(WORDS, len(h))
            value = np.zeros(len(h) - n + 1 if n else 0, np.uint64)
            for k in range(n):
                value = value * ODD + h[k:k + len(value)]
            out.append(np.unique(mixed(value + np.uint64(n))))
        return out


def sketch(shingles: np.ndarray) -> np.ndarray:
    out = np.empty(SKETCH, np.uint32)
    for a in range(SKETCH):
        out[a] = (shingles * PATHS[0, a] + PATHS[1, a] >> np.uint64(32)).min()
    return out


def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text_key, text) to (doc_id, text_key, set_id, n, sketch); sets without shingles get an id of their own."""
    let_go()
    shingler = Shingler()
    for batch in batches:
        for ids, keys, texts in rows_of(batch):
            sets = shingler.sets(texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(keys, pa.int64()), pa.array(
                    [xxhash.xxh128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                 pa.array([len(s) for s in sets], pa.int64()), pa.array(
                     [sketch(s).tobytes() if len(s) else None for s in sets], pa.binary())],
                ["doc_id", "text_key", "set_id", "n", "sketch"])


# ---------------------------------------------------------------- the recursion
def children(buckets: np.ndarray, sketches: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, child bucket) of every row of ``sketches``, by the positions that its bucket samples."""
    place = np.arange(SKETCH, dtype=np.uint64) + np.uint64(1)
    draw = mixed(buckets[:, None] + place * np.uint64(0xD6E8FEB86659FD93))
    row, at = np.nonzero(draw < np.uint64(int(2.0 ** 64 / (SIMILAR * SKETCH))))
    return row, mixed(mixed(buckets[row] + at.astype(np.uint64) * ODD) + sketches[row, at].astype(np.uint64))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def split_roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(set_id, sketch) to (bucket, set_id): the first level of all runs."""
    for batch in batches:
        ids, packed = batch.column("set_id"), batch.column("sketch").to_pylist()
        if not len(packed):
            continue
        sketches = np.frombuffer(b"".join(packed), np.uint32).reshape(-1, SKETCH)
        for place in ROOTS:
            child = mixed(mixed(np.full(len(packed), place, np.uint64) * ODD) + sketches[:, place].astype(np.uint64))
            yield pa.RecordBatch.from_arrays([_signed(child), ids], ["bucket", "set_id"])


def split_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, set_id, sketch) to (bucket, set_id) of the next level."""
    for batch in batches:
        packed = batch.column("sketch").to_pylist()
        if packed:
            row, child = children(batch.column("bucket").to_numpy().view(np.uint64),
                                  np.frombuffer(b"".join(packed), np.uint32).reshape(-1, SKETCH))
            yield pa.RecordBatch.from_arrays([_signed(child), batch.column("set_id").take(pa.array(row))],
                                             ["bucket", "set_id"])


def leaves_of(sets: DataFrame) -> DataFrame:
    """(bucket, set_id, m) of all leaves with two sets or more; m sets in the leaf."""
    keyed = sets.select("set_id", "n", "sketch")
    level = sets.select("set_id", "sketch").mapInArrow(split_roots, "bucket long, set_id binary")
    found = None
    for depth in range(1, DEPTH + 1):
        rows = materialize(level)
        size = rows.groupBy("bucket").agg(F.count("set_id").alias("m")).where("m > 1")
        shared = materialize(rows.select("bucket", "set_id").join(size, "bucket"))
        leaf = shared if depth == DEPTH else shared.where(F.col("m") <= LEAF)
        found = leaf if found is None else found.unionByName(leaf)
        large = shared.where(F.col("m") > LEAF)
        if depth == DEPTH or large.isEmpty():
            break
        large = materialize(large.join(keyed.select("set_id", "sketch"), "set_id"))
        alike = large.select("bucket", "m", "sketch").mapInArrow(
            count_values, "bucket long, m long, place int, value long, n long").groupBy(
                "bucket", "m", "place", "value").agg(F.sum("n").cast("double").alias("n"))
        alike = alike.groupBy("bucket", "m").agg((F.sum(F.col("n") * F.col("n")) / LOOKED_AT).alias("pairs"))
        alike = materialize(alike.where(F.col("pairs") >= ALIKE * F.col("m") * F.col("m")).select("bucket"))
        found = found.unionByName(large.join(alike, "bucket", "left_semi").select("bucket", "set_id", "m"))
        level = large.join(alike, "bucket", "left_anti").select("bucket", "set_id", "sketch").mapInArrow(
            split_buckets, "bucket long, set_id binary")
    return found


def count_values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, m, sketch) to (bucket, m, place, value, n): how often each value stands at a few sketch positions."""
    for batch in batches:
        packed = batch.column("sketch").to_pylist()
        if not packed:
            continue
        sketches = np.frombuffer(b"".join(packed), np.uint32).reshape(-1, SKETCH)
        bucket, m = batch.column("bucket").to_numpy(), batch.column("m").to_numpy()
        for place in range(LOOKED_AT):
            order = np.lexsort((sketches[:, place], bucket))
            b, v = bucket[order], sketches[order, place]
            first = np.flatnonzero(np.r_[True, (b[1:] != b[:-1]) | (v[1:] != v[:-1])])
            yield pa.RecordBatch.from_arrays(
                [pa.array(b[first]), pa.array(m[order][first]), pa.array(np.full(len(first), place, np.int32)),
                 pa.array(v[first].astype(np.int64)), pa.array(np.diff(np.r_[first, len(b)]))],
                ["bucket", "m", "place", "value", "n"])


# ---------------------------------------------------------------- brute force
def groups_of(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Runs of rows with one key, whole even where they span batches; rows come sorted by key."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        keys = batch.column(key).to_pylist()
        starts = [i for i in range(len(keys)) if keys[i] != (keys[i - 1] if i else last)]
        cuts = [0, *[i for i in starts if i], len(keys)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if held and (a or 0 in starts):
                yield pa.Table.from_batches(held)
                held = []
            if b > a:
                held.append(batch.slice(a, b - a))
        last = keys[-1] if keys else last
    if held:
        yield pa.Table.from_batches(held)


def compare_block(sketches: np.ndarray, sizes: np.ndarray, sides: np.ndarray, across: bool,
                  earlier: np.ndarray) -> np.ndarray:
    """Which pairs (upper triangle) are alike by their sketches, compatible in size, of the block, and met here first."""
    agree = np.zeros((len(sizes), len(sizes)), np.uint8)
    for t in range(SKETCH):
        agree += sketches[:, t, None] == sketches[None, :, t]
    small, large = np.minimum.outer(sizes, sizes), np.maximum.outer(sizes, sizes)
    alike = (agree >= TOLERATED) & (small >= SIMILAR * large)
    if across:
        # A block of two parts compares across them; each part has a block of its own.
        alike &= sides[:, None] != sides[None, :]
    if earlier.shape[1]:
        flags = earlier.astype(np.float32)
        alike &= flags @ flags.T == 0
    return np.triu(alike, 1)


def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Block rows to the rows that have a candidate: (block, place, set_id, partners as packed places)."""
    for table in groups_of(batches, "block"):
        if table.num_rows < 2:
            continue
        order = pa.compute.sort_indices(table.column("set_id"))
        table = table.take(order)
        sketches = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint32).reshape(-1, SKETCH)
        own, lists = table.column("bucket")[0].as_py(), table.column("buckets").to_pylist()
        before = sorted({b for x in lists for b in x if b < own})
        at = {b: i for i, b in enumerate(before)}
        earlier = np.zeros((len(lists), len(before)), bool)
        for i, x in enumerate(lists):
            earlier[i, [at[b] for b in x if b < own]] = True
        pairs = compare_block(sketches, table.column("n").to_numpy(), table.column("side").to_numpy(),
                              len(set(table.column("block")[0].as_py().split("/")[1:])) > 1, earlier)
        keep = np.flatnonzero(pairs.any(axis=0) | pairs.any(axis=1))
        if len(keep):
            pairs = pairs[np.ix_(keep, keep)]
            rows = table.take(pa.array(keep))
            yield pa.RecordBatch.from_arrays(
                [rows.column("block").combine_chunks(), pa.array(np.arange(len(keep), dtype=np.int32)),
                 rows.column("set_id").combine_chunks(), pa.array(
                     [np.flatnonzero(p).astype(np.uint16).tobytes() for p in pairs], pa.binary())],
                ["block", "place", "set_id", "partners"])


def verified(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which of the pairs (left, right) of sorted sets reach SIMILAR."""
    sizes = np.array([len(s) for s in sets])
    if len(left) <= 8 * len(sets):
        both = np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in
                         zip(left.tolist(), right.tolist(), strict=True)])
    else:
        owner = np.repeat(np.arange(len(sets)), sizes)
        _, where, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = times[where] > 1
        owner, where = owner[shared], (np.cumsum(times > 1) - 1)[where[shared]]
        total = np.zeros((len(sets), len(sets)), np.float32)
        for a in range(0, int(where.max(initial=-1)) + 1, 4096):
            part = (where >= a) & (where < a + 4096)
            dense = np.zeros((len(sets), 4096), np.float32)
            dense[owner[part], where[part] - a] = 1
            total += dense @ dense.T
        both = total[left, right]
    return both >= SIMILAR * (sizes[left] + sizes[right] - both) - 1e-9


def link_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate rows with their sets to (set_id, root, links): links weighted by the partners' copies."""
    for table in groups_of(batches, "block"):
        table = table.take(pa.compute.sort_indices(table.column("place")))
        place = table.column("place").to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
        copies, ids = table.column("copies").to_numpy(), table.column("set_id").to_pylist()
        partners = [np.frombuffer(x, np.uint16) for x in table.column("partners").to_pylist()]
        left = np.repeat(np.arange(len(ids)), [len(p) for p in partners])
        right = np.searchsorted(place, np.concatenate(partners))
        good = verified(sets, left, right)
        left, right = left[good], right[good]
        links = np.bincount(left, copies[right], len(ids)) + np.bincount(right, copies[left], len(ids))
        root = np.arange(len(ids))
        while len(left):
            low = np.minimum(root[left], root[right])
            before = root.copy()
            np.minimum.at(root, left, low)
            np.minimum.at(root, right, low)
            root = root[root]
            if (before == root).all():
                break
        linked = np.flatnonzero(links > 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array([ids[i] for i in linked], pa.binary()), pa.array([ids[root[i]] for i in linked], pa.binary()),
             pa.array(links[linked].astype(np.int64))], ["set_id", "root", "links"])


# ---------------------------------------------------------------- components
def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each node's component, from (a, b); by alternating star steps."""
    e = materialize(edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # Large star: neighbours above u hang on the smallest of its neighbourhood.
        e = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        # Small star: u and its neighbours below hang on the smallest of them.
        low = e.groupBy("u").agg(F.min("v").alias("m"))
        rest = e.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = materialize(rest.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        now = e.agg(F.count("u"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now


# ---------------------------------------------------------------- the join
def near_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text_key, class_id, n_links, n_copies, is_first of every row.

    class_id is the smallest doc_id of the class, n_links the number of other rows that a row
    links to (copies included), n_copies the rows with an equal set; is_first marks the one
    text of a class that stands for it (rows repeated exactly share the mark).
    """
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias(
        "text_key"), F.col(text).alias("text"))
    rows = materialize(own.mapInArrow(describe, "doc_id long, text_key long, set_id binary, n long, sketch binary"))
    sets = materialize(rows.where("n > 0").groupBy("set_id").agg(
        F.min(F.struct("doc_id", "text_key")).alias("head"), F.count("n").alias("copies"), F.first("n").alias("n"),
        F.first("sketch").alias("sketch")))
    leaves = materialize(leaves_of(sets))
    met = leaves.groupBy("set_id").agg(F.sort_array(F.collect_list("bucket")).alias("buckets")).join(
        sets.select("set_id", "n", "sketch"), "set_id")
    weight = leaves.select("bucket", "set_id", "m").join(sets.select("set_id", "n"), "set_id").groupBy("bucket").agg(
        F.first("m").alias("m"), F.sum("n").alias("w"))
    parts = weight.select("bucket", F.ceil(F.greatest(F.col("m") / BLOCK_SETS, F.when(
        F.col("m") > 2, F.col("w") / BLOCK_SHINGLES).otherwise(1))).cast("long").alias("parts")).where("parts > 1")
    member = met.select("set_id", "n", "sketch", "buckets", F.explode("buckets").alias("bucket"))
    member = member.join(parts, "bucket", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    member = member.withColumn("side", F.pmod(F.xxhash64("set_id", "bucket"), "parts"))
    block = member.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("other"))
    block = block.select(F.concat_ws("/", "bucket", F.least("side", "other"), F.greatest("side", "other")).alias("block"),
                         "bucket", "side", "set_id", "n", "sketch", "buckets")
    found = materialize(block.repartition("block").sortWithinPartitions("block").mapInArrow(
        candidates, "block string, place int, set_id binary, partners binary"))
    asked = found.select("set_id").distinct().join(sets.select("set_id", "head", "copies"), "set_id").select(
        "set_id", "copies", F.col("head.doc_id").alias("_d"), F.col("head.text_key").alias("_k"))
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    texts = own.select(named("doc_id").alias("_doc"), F.col("text_key").alias("_key"), "text")
    asked = asked.withColumn("_name", named("_d"))
    whole = texts.join(asked, (F.col("_doc") == F.col("_name")) & (F.col("_key") == F.col("_k"))).select(
        "set_id", "copies", "text")

    def shingle(batches):
        let_go()
        shingler = Shingler()
        for batch in batches:
            for ids, copies, body in rows_of(batch):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.binary()), pa.array(copies, pa.int64()),
                     pa.array([s.tobytes() for s in shingler.sets(body)], pa.binary())],
                    ["set_id", "copies", "shingles"])

    known = whole.dropDuplicates(["set_id"]).mapInArrow(shingle, "set_id binary, copies long, shingles binary")
    linked = materialize(found.join(known, "set_id").repartition("block").sortWithinPartitions("block").select(
        "block", "place", "set_id", "partners", "copies", "shingles").mapInArrow(
            link_blocks, "set_id binary, root binary, links long"))
    roots = components(linked.select(F.col("set_id").alias("a"), F.col("root").alias("b")))
    links = linked.groupBy("set_id").agg(F.sum("links").alias("links"))
    each = sets.select("set_id", "head", "copies").join(roots, F.col("set_id") == F.col("node"), "left").join(
        links, "set_id", "left").select("set_id", "head", "copies", F.coalesce("root", "set_id").alias("root"),
                                        F.coalesce("links", F.lit(0)).alias("links"))
    each = materialize(each)
    classes = each.groupBy("root").agg(F.min("head").alias("first"))
    info = each.join(classes, "root").select(F.col("set_id").alias("_set"), "first", "links", "copies")
    out = rows.select("doc_id", "text_key", "set_id").join(info, F.col("set_id") == F.col("_set"), "left")
    me = F.struct("doc_id", "text_key")
    return out.select(
        "doc_id", "text_key", F.when(F.col("_set").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias(
            "class_id"), (F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).cast("long").alias("n_links"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies"),
        (F.col("_set").isNull() | (F.col("first") == me)).alias("is_first"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stand for their class; all columns unchanged, rows repeated exactly kept once."""
    first = near_classes(docs, doc_id, text).where("is_first").select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_name"), F.col("text_key").alias("_key")).distinct()
    name = F.coalesce(F.col(doc_id).cast("long").cast("string"), F.lit(""))
    rows = docs.select(F.struct("*").alias("row"), name.alias("_own"), F.xxhash64(
        F.coalesce(F.col(text), F.lit(""))).alias("_text_key"))
    kept = rows.join(first, (F.col("_own") == F.col("_name")) & (F.col("_text_key") == F.col("_key")), "left_semi")
    return kept.dropDuplicates(["_own", "_text_key"]).select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
