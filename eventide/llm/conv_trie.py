"""Prefix trie of conversations by fixed-length block hashing.

A conversation is a list of turns (role, text).  Every distinct sequence of first ``d`` turns is
a node.  Turns are hashed with their position into two 64-bit lanes and a prefix is the
exclusive or of its turns' hashes, so a block of ``BLOCK`` turns has a digest of its own and
prefixes at block ends come from one running scan over blocks, cut into stretches so that a
long conversation is spread over many tasks.

Conversations are grouped by block digests first: copies fall together however many there are.
Turn boundaries inside a block are refined only where several different blocks follow the same
prefix, and only once for each different block.

Sums over subtrees need no walk.  A node belongs to its smallest member; what a conversation
owns is the end of its path, from some depth on.  Let ``shared`` be a conversation's words
before that depth (all its words if it owns nothing).  Of a node with ``n`` members whose prefix
has ``before`` words ahead of the node's own turn, the tokens saved in the subtree are the sum
of ``shared`` over the members but the owner, less ``(n - 1) * before``; the leaves are the
members that own one.  Both are plain sums over members, first by block, then by turn.

Defined results: turns of equal number are ordered by role and text; null roles and texts are
empty; rows without a conv_id take no part; repeated rows are turns of their own; an empty
table has no nodes, not even the root.  ``%`` keeps the sign of a negative conv_id.  Texts of
any length are hashed whole.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.textops import words
from eventide.llm.warm import let_go
from eventide.plans.scan import running_sums
from eventide.session import materialize

BLOCK = 4
#: Turns, and blocks, of one conversation scanned by one task.
STRETCH = 1024
#: Conversations that share their first turns with the first of every ``FAMILY``; at most ``MOST_SHARED`` turns.
FAMILY, MOST_SHARED = 20, 3
#: Ids in one piece of text that goes to a node's hash.
PIECE = 4096
NODE = ["depth", "i1", "i2"]
_BEFORE = (Window.unboundedPreceding, -1)


def _xor(a: Column, b: Column) -> Column:
    return a.bitwiseXOR(b)


def turns_of(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
             text: str = "text") -> DataFrame:
    """``conv_id, pos, digest, words``: numbered turns; the digest stands for role and text."""
    role_, text_ = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    rows = conversations.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.md5(F.concat_ws(":", F.length(role_).cast("string"), role_, text_)).alias("digest"),
        F.size(words(text_)).cast("long").alias("words"), role_.alias("role"), F.md5(text_).alias("tie"), text_.alias("text"))
    stretch = F.coalesce(F.floor(F.col("turn") / STRETCH), F.lit(-2**62)).cast("long")
    rows = running_sums(rows.withColumn("_b", stretch), ["conv_id"], [F.col("turn").asc_nulls_first(), "role", "text"], "_b",
                        {"pos": F.lit(1).cast("long")})
    return rows.select("conv_id", "pos", "digest", "words")


def with_shared_heads(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations): every conversation's first turns replaced by those of its family's first one.

    The first ``crc32(conv_id) % 4`` turns of conversation ``c - c % FAMILY`` (all if fewer, none
    if it is absent) are followed by the conversation's own turns after its first so many.
    """
    convs = turns.groupBy("conv_id").agg(F.max("pos").alias("_own"))
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    taken = F.crc32(F.col("conv_id").cast("string")) % (MOST_SHARED + 1)
    heads = turns.where((F.col("conv_id") % FAMILY == 0) & (F.col("pos") <= MOST_SHARED)).groupBy(
        F.col("conv_id").alias("_base")).agg(F.sort_array(F.collect_list(F.struct("pos", "digest", "words"))).alias("_head"))
    convs = convs.withColumn("_base", base).withColumn("_h", taken).join(heads, "_base", "left")
    got = F.least(F.col("_h"), F.coalesce(F.size("_head"), F.lit(0))).cast("int")
    convs = materialize(convs.select("conv_id", F.col("_h").cast("long").alias("_h"), F.when(got > 0, F.slice(
        "_head", 1, got)).alias("_head"), got.alias("_got")))
    first = convs.where("_got > 0").select("conv_id", F.explode("_head").alias("t")).select("conv_id", "t.*")
    rest = turns.join(convs.select("conv_id", "_h", "_got"), "conv_id").where(F.col("pos") > F.col("_h")).select(
        "conv_id", (F.col("pos") - F.col("_h") + F.col("_got")).alias("pos"), "digest", "words")
    return first.unionByName(rest), convs.select("conv_id")


def blocks_of(turns: DataFrame) -> DataFrame:
    """``conv_id, k, ts, p1, p2, e1, e2, before, w``: blocks, the prefix hashes at their ends and the words ahead of them."""
    lane = lambda n: F.xxhash64(F.lit(n), "pos", "digest")
    rows = turns.select("conv_id", F.floor((F.col("pos") - 1) / BLOCK).cast("long").alias("k"), F.struct(
        "pos", lane(1).alias("x1"), lane(2).alias("x2"), "words").alias("t"))
    rows = rows.groupBy("conv_id", "k").agg(
        F.sort_array(F.collect_list("t")).alias("ts"), F.bit_xor("t.x1").alias("b1"), F.bit_xor("t.x2").alias("b2"),
        F.sum("t.words").alias("w")).withColumn("_s", F.floor(F.col("k") / STRETCH).cast("long"))
    rows = materialize(rows)

    def ahead(df: DataFrame, part: list[str], order: str, out: tuple[str, str, str]) -> DataFrame:
        w = Window.partitionBy(*part).orderBy(order).rowsBetween(*_BEFORE)
        xor = [F.coalesce(F.bit_xor(c).over(w), F.lit(0).cast("long")) for c in ("b1", "b2")]
        return df.select("*", xor[0].alias(out[0]), xor[1].alias(out[1]), F.coalesce(F.sum("w").over(w), F.lit(0).cast(
            "long")).alias(out[2]))

    stretches = rows.groupBy("conv_id", "_s").agg(F.bit_xor("b1").alias("b1"), F.bit_xor("b2").alias("b2"), F.sum("w").alias("w"))
    stretches = ahead(stretches, ["conv_id"], "_s", ("s1", "s2", "sw")).select("conv_id", "_s", "s1", "s2", "sw")
    rows = ahead(rows, ["conv_id", "_s"], "k", ("l1", "l2", "lw")).join(stretches, ["conv_id", "_s"])
    rows = rows.withColumn("p1", _xor(F.col("l1"), F.col("s1"))).withColumn("p2", _xor(F.col("l2"), F.col("s2")))
    return rows.select("conv_id", "k", "ts", "p1", "p2", _xor(F.col("p1"), F.col("b1")).alias("e1"), _xor(
        F.col("p2"), F.col("b2")).alias("e2"), (F.col("lw") + F.col("sw")).alias("before"), "w")


def _boundaries() -> Column:
    """A block's turn boundaries as nodes: depth, hash, parent's hash, the last turn's words, the words ahead of it."""
    def prefix(start: str, lane: str, n: Column) -> Column:
        return F.aggregate(F.slice("ts", F.lit(1), n), F.col(start), lambda acc, t: _xor(acc, t[lane]))

    def node(j: Column) -> Column:
        last = F.get(F.col("ts"), j - 1)
        before = F.aggregate(F.slice("ts", F.lit(1), j - 1), F.col("before"), lambda acc, t: acc + t["words"])
        return F.struct(last["pos"].alias("depth"), prefix("p1", "x1", j).alias("i1"), prefix("p2", "x2", j).alias("i2"),
                        prefix("p1", "x1", j - 1).alias("q1"), prefix("p2", "x2", j - 1).alias("q2"), last["words"].alias("words"),
                        before.alias("before"))
    return F.transform(F.sequence(F.lit(1), F.size("ts")), node)


_KEY = ["k", "p1", "p2", "e1", "e2"]
_FIXED = ["q1", "q2", "words", "before"]


def _refined(blocks: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Different blocks to nodes: aggregates ``sums`` of the blocks that share each turn boundary.

    A block that alone follows its prefix shares no inner boundary with any other: its turns are
    nodes as they are.  Only blocks with siblings are grouped again, turn by turn.
    """
    branching = blocks.where("k > 0").groupBy("k", "p1", "p2").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(
        "k", "p1", "p2", F.lit(True).alias("_branch"))
    blocks = blocks.join(branching, ["k", "p1", "p2"], "left")
    shared = (F.col("k") == 0) | F.col("_branch").isNotNull()

    def nodes(df: DataFrame) -> DataFrame:
        return df.select(*sums, F.explode(_boundaries()).alias("t")).select("t.*", *sums)

    grouped = nodes(blocks.where(shared)).groupBy(*NODE).agg(
        *[F.first(c).alias(c) for c in _FIXED], *[s.alias(n) for n, s in sums.items()])
    return nodes(blocks.where(~shared)).unionByName(grouped)


def _end_hashes(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256): SHA-256 of the ids that end at each node, ascending, joined by commas.

    A hash is taken in order, so a node's ids end up in one task; they come as pieces of
    ``PIECE`` ids that range partitions have sorted and joined, and are hashed as they stream
    by: the task holds one piece.
    """
    names = [*NODE, "first", "ids"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        node, held = None, []

        def made(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            rows = []
            for *at, c in zip(*[b.to_pylist() for b in batch.columns], strict=True):
                if held and (at != node or len(held) >= PIECE):
                    rows.append((*node, held[0], ",".join(map(str, held))))
                    held = []
                node = at
                held.append(c)
            yield made(rows)
        if held:
            yield made([(*node, held[0], ",".join(map(str, held)))])

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        node, sha = None, None

        def made(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True) if rows else [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [*kinds[:3], pa.string()], strict=True)],
                                              [*NODE, "ends_sha256"])

        for batch in batches:
            rows = []
            for *at, ids in zip(*[batch.column(n).to_pylist() for n in (*NODE, "ids")], strict=True):
                if at == node:
                    sha.update(b",")
                else:
                    if sha:
                        rows.append((*node, sha.hexdigest()))
                    node, sha = at, hashlib.sha256()
                sha.update(ids.encode())
            yield made(rows)
        if sha:
            yield made([(*node, sha.hexdigest())])

    key = ", ".join(f"{c} long" for c in NODE)
    joined = ends.select(*NODE, "conv_id").repartitionByRange(*NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id").mapInArrow(
        pieces, f"{key}, first long, ids string")
    return joined.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInArrow(hashes, f"{key}, ends_sha256 string")


def trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """The nodes of conversations ``convs (conv_id)`` with turns ``conv_id, pos, digest, words``, positions from 1 on.

    ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.
    """
    blocks = materialize(blocks_of(turns))
    known = blocks.groupBy(*_KEY).agg(F.first("ts").alias("ts"), F.first("before").alias("before"), F.count(F.lit(1)).alias("n"),
                                      F.min("conv_id").alias("owner"))
    nodes = materialize(_refined(known, {"n": F.sum("n"), "owner": F.min("owner")}))
    children = nodes.groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("i1"), F.col("q2").alias("i2")).agg(
        F.count(F.lit(1)).alias("n_children"))
    nodes = materialize(nodes.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))))

    # Per conversation: where it ends, the words it shares with smaller ones, whether it owns a leaf.
    owned = nodes.groupBy(F.col("owner").alias("conv_id")).agg(
        F.min(F.struct("depth", "before")).alias("top"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf"))
    last = blocks.groupBy("conv_id").agg(F.max(F.struct(
        "k", F.element_at("ts", -1)["pos"].alias("depth"), F.col("e1").alias("i1"), F.col("e2").alias("i2"), (
            F.col("before") + F.col("w")).alias("total"))).alias("l"))
    none = F.lit(0).cast("long")
    conv = materialize(convs.join(last, "conv_id", "left").join(owned, "conv_id", "left").select(
        "conv_id", *[F.coalesce(f"l.{c}", none).alias(c) for c in NODE],
        F.coalesce("top.before", "l.total", none).alias("shared"), F.coalesce("leaf", none).alias("leaf")))

    members = blocks.select("conv_id", *_KEY, "ts", "before").join(conv.select("conv_id", "shared", "leaf"), "conv_id").groupBy(
        *_KEY).agg(F.first("ts").alias("ts"), F.first("before").alias("before"), F.sum("shared").alias("shared"),
                   F.sum("leaf").alias("leaf"))
    sums = _refined(members, {"shared": F.sum("shared"), "leaf": F.sum("leaf")}).select(*NODE, "shared", "leaf")
    root = conv.agg(F.min("conv_id").alias("owner"), F.count(F.lit(1)).alias("n"), F.sum("shared").alias("shared"), F.sum(
        "leaf").alias("leaf")).where("n > 0")
    tops = nodes.where("depth = 1").agg(F.count(F.lit(1)).alias("n_children"))
    own = conv.select(F.col("conv_id").alias("owner"), F.col("shared").alias("_kept"))
    inner = nodes.join(sums, NODE).join(own, "owner")
    # The first node of every path has the root as its parent: one row, so no join meets on it.
    up = nodes.select((F.col("depth") + 1).alias("depth"), F.col("i1").alias("q1"), F.col("i2").alias("q2"), F.col("owner").alias("_up"))
    deep = inner.where("depth > 1").join(up, ["depth", "q1", "q2"])
    high = inner.where("depth = 1").crossJoin(F.broadcast(root.select(F.col("owner").alias("_up"))))
    whole = deep.unionByName(high).select(
        *NODE, F.col("owner").alias("conv_id"), F.col("_up").alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children",
        F.col("leaf").alias("n_leaves"), (F.col("shared") - F.col("_kept") - (F.col("n") - 1) * F.col("before")).alias("saved_tokens"))
    top = root.crossJoin(F.broadcast(tops)).select(
        *[none.alias(c) for c in NODE], F.col("owner").alias("conv_id"), F.lit(None).cast("long").alias("parent_conv_id"),
        F.col("n").alias("n_convs"), "n_children", F.greatest("leaf", F.lit(1).cast("long")).alias("n_leaves"),
        F.col("shared").alias("saved_tokens"))
    empty = F.sha2(F.lit("").cast("binary"), 256)
    return whole.unionByName(top).join(_end_hashes(conv), NODE, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", empty).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the conversations with their families' shared heads (see ``with_shared_heads``)."""
    turns, convs = with_shared_heads(materialize(turns_of(conversations)))
    return trie(turns, convs)
