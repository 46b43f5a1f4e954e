"""Language-model scoring by logistic context mixing over bits.

Tokens are words, ASCII-lower-cased, and one end for each text.  A word is spelled by its
bytes and a space, an end by one line feed; each byte by its bits from the highest.  A bit
is predicted from hashed contexts, the last one to four bytes of the text so far, across
the space before the word (a start mark before the text), and from an exact one: in the first
``HEAD`` symbols of a word the whole previous word with the word's prefix, further on the whole
prefix of the word.  Each predictor is a pair of corpus counts; their log-odds are combined by
weights that gates select (the bit, the depth in the word, and how often each context was
seen), learned online by gradient steps; an adaptive map refines the mixed probability by the
frequencies seen at it.  While learning, an occurrence's own count is taken out of its
predictors, as if the model met it next.

What follows the head of a word depends on the word alone, and its head on the previous word, so each
distinct word and each distinct (previous word, head) is scored once, however often it occurs;
a text's score is the sum over its words in order.

How it runs:
1. One pass over the texts, in chunks of bounded size, writes each chunk's dictionary
   (word, training count), its (previous word, head) pairs and each document as its words'
   dictionary numbers in order.
2. Dictionaries are shuffled by the first four bytes of the word and merged into packed
   rows of whole prefix groups, so counts of longer prefixes are at hand in one row.  Pairs
   are shuffled by the previous word into parts, whose number grows with the texts, and merged.
3. Passes over both count short contexts (summed in Spark into a table of fixed size), learn
   weights (summed per parameter), and score every distinct word and pair.
4. Scores return to their chunks and are summed over each document.
Words and pairs are counted per chunk before any shuffle, so frequent ones cost a row per chunk.

Defined cases: a null or empty text is its end alone; without training texts every count
is 0; words of any length (past ``DEEPEST`` bytes only the short contexts predict); rows
that share a doc_id are scored apart; a null doc_id counts as the empty string for the
split; an empty table gives an empty result; columns other than id and text are ignored;
bits_per_byte is null for a text without bytes.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.bpe import ROWS_AT_ONCE
from eventide.llm.warm import let_go
from eventide.session import materialize_alone

CHUNK_BYTES = 16 << 20
PACK_WORDS = 1 << 16
GROUP_BYTES = 4
ORDERS = 4
SLOT_BITS = 19
DEEPEST = 40
DEPTHS, SEEN, STEPS = 6, 10, 24
START, SPACE, END = 1, 32, b"\n"
RATE, BATCH = 0.02, 1 << 14

#: Symbols at the start of a word that are predicted with the word before it; at most four (a head is four bytes).
HEAD = 4
BLOB_BYTES = 2 << 20
#: Rows of the contexts' table on its way to the driver.
RANGES = 64
#: Text in one part of the (previous word, head) pairs, and pairs merged at once.
PART_BYTES, MERGE_PAIRS = 16 << 20, 1 << 20

CHUNKS = ("chunk long, kind int, number int, word binary, train long, doc_id long, held boolean, size long, bytes long, "
          "data binary")
WORDS, HEADS, PAIRS, DOCS = range(4)
PACKED = "words binary, lengths binary, counts binary, chunks binary, chunk_of binary, number_of binary, word_of binary"
MERGED = "part int, before binary, endings binary, owners binary, heads binary, counts binary"
FOUND = "chunk long, kind int, number int, data binary"
SCORED = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
          "score double, bits_per_byte double")


#: Bytes as tokens have them: A-Z in lower case, each of the six separators a space.
PLAIN = np.frombuffer(bytes(range(256)).lower().translate(bytes.maketrans(b"\t\n\x0b\x0c\r", b" " * 5)), np.uint8)


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words and the end of each text: their bytes, where each begins, and the texts' sizes in bytes."""
    texts = pc.fill_null(texts, "").cast(pa.string())
    at = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, 4 * texts.offset)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data else np.zeros(0, np.uint8)
    # A line feed stands for an end alone, since those of the text are spaces by now.
    plain = np.insert(PLAIN[data], at[1:] - at[0], END[0])
    inside, is_end = plain != SPACE, plain == END[0]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | is_end[1:] | is_end[:-1]
    return plain[inside], np.flatnonzero(begins[inside]).astype(np.int32), np.diff(at)


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 5 == 1


def pack_bag(numbers: np.ndarray) -> bytes:
    """Distinct numbers below 2**24 and how often each occurs, as four byte planes (a count over 255 repeats its number)."""
    found, times = np.unique(numbers, return_counts=True)
    copies = -(-times // 255)
    found, at = np.repeat(found, copies), np.cumsum(copies) - 1
    each = np.full(len(found), 255)
    each[at] = times - 255 * (copies - 1)
    return np.stack([found & 255, found >> 8 & 255, found >> 16, each]).astype(np.uint8).tobytes()


def unpack_bag(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(data, np.uint8).reshape(4, -1).astype(np.int64)
    return planes[0] | planes[1] << 8 | planes[2] << 16, planes[3]


def unpack_order(data: bytes) -> np.ndarray:
    """Numbers below 2**24 in order, from three byte planes."""
    planes = np.frombuffer(data, np.uint8).reshape(3, -1).astype(np.int64)
    return planes[0] | planes[1] << 8 | planes[2] << 16


# ---------------------------------------------------------------- 1. chunks
def edges_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Of each word, an end first, its head and its last bytes, as numbers.

    The head is the first symbols of the word and its space, or the end; no word holds a space or line feed.
    """
    text, at, length = bytes_of(words)
    last = len(text) - 1
    head, ending = np.zeros((2, len(words)), np.int64)
    for k in range(HEAD):
        head = head << 8 | np.where(k < length, text[np.minimum(at + k, last)], np.where(k == length, SPACE, 0))
    head[0] = END[0] << 24
    for k in range(ORDERS - 1, 0, -1):
        ending = ending << 8 | np.where(k <= length, text[np.where(k <= length, at + length - k, 0)], 0)
    return head, ending


def bytes_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of binary values, where each begins in them and its length."""
    at = np.frombuffer(words.buffers()[1], np.int32, len(words) + 1, 4 * words.offset).astype(np.int64)
    return np.frombuffer(words.buffers()[2], np.uint8)[at[0]:at[-1]], at[:-1] - at[0], np.diff(at)


def pairs_of(order: np.ndarray, head: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (previous word's number, head) of texts, ascending, and the pair of each word and end in order.

    No other word comes before a text's first, so the end's number 0 stands for that.
    """
    cur = order.astype(np.int64)
    prev = np.concatenate([[0], cur[:-1]])
    return np.unique(prev << 32 | head[cur], return_inverse=True)


def in_order(part: np.ndarray) -> np.ndarray:
    """The places of parts in stable order; numbers of two bytes at most are sorted by their digits."""
    return np.argsort(part.astype(np.min_scalar_type(part.max())), kind="stable")


def write_chunks(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """Documents (doc_id, text) to chunk rows: dictionary, one row of the words' heads and parts, pairs by part, documents."""
    types = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}
    schema = pa.schema([(c.split()[0], types[c.split()[1]]) for c in CHUNKS.split(", ")])

    def rows(kind: int, n: int, **columns) -> pa.RecordBatch:
        columns |= {"chunk": pa.array(np.full(n, name)), "kind": pa.array(np.full(n, kind, np.int32))}
        return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(n, f.type)) for f in schema], schema=schema)

    def close() -> Iterator[pa.RecordBatch]:
        # An end comes first, so its number is 0.
        text = np.concatenate([np.frombuffer(END, np.uint8), *(t for t, _ in held)])
        ends = np.cumsum([1, *(len(t) for t, _ in held)])
        begins = np.concatenate([[0], *(at + a for (_, at), a in zip(held, ends, strict=False)), [len(text)]]).astype(np.int32)
        held.clear()
        met = pa.Array.from_buffers(pa.binary(), len(begins) - 1, [None, pa.py_buffer(begins), pa.py_buffer(text)]).dictionary_encode()
        words, order = met.dictionary, met.indices.to_numpy()[1:]
        del text, begins, met
        stops = np.flatnonzero(order == 0) + 1
        size = np.diff(stops, prepend=0)
        out = [held_out(i) for i in ids]
        planes = [(order >> k & 255).astype(np.uint8) for k in (0, 8, 16)]
        data = [b"".join(x[b - n:b].tobytes() for x in planes) for b, n in zip(stops.tolist(), size.tolist(), strict=True)]
        yield rows(DOCS, len(ids), doc_id=pa.array(ids, pa.int64()), held=pa.array(out, pa.bool_()), size=pa.array(size),
                   bytes=pa.array(np.concatenate(sizes).astype(np.int64)), data=pa.array(data, pa.binary()))
        del planes, data
        learned = np.repeat(~np.array(out), size)
        train = np.bincount(order[learned], minlength=len(words))
        yield rows(WORDS, len(words), number=pa.array(np.arange(len(words), dtype=np.int32)), word=words, train=pa.array(train))
        head, ending = edges_of(words)
        before = np.frombuffer(b"".join([blake2b(w, digest_size=8).digest() for w in words.to_pylist()]), np.uint64)
        part = (before % np.uint64(parts)).astype(np.int32)
        yield rows(HEADS, 1, data=pa.array([head.astype(np.uint32).tobytes() + part.tobytes()]))
        keys, pair = pairs_of(order, head)
        counts = np.bincount(pair[learned], minlength=len(keys))
        del pair, learned
        number = keys >> 32
        by_part = in_order(part[number])
        ends = np.searchsorted(part[number][by_part], np.arange(parts + 1))
        blobs: dict[int, bytes] = {}
        for p in np.flatnonzero(np.diff(ends)):
            some = by_part[ends[p]:ends[p + 1]]
            owner, size = np.unique(number[some], return_counts=True)
            blobs[p] = pack_pairs(before[owner], ending[owner], size, keys[some] & 0xFFFFFFFF, counts[some])
            if ends[p + 1] == ends[-1] or sum(map(len, blobs.values())) >= BLOB_BYTES:
                yield rows(PAIRS, len(blobs), number=pa.array(blobs.keys(), pa.int32()), data=pa.array(blobs.values(), pa.binary()))
                blobs = {}

    let_go()
    name, held, ids, sizes, held_bytes = new_chunk(), [], [], [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            some = batch.slice(at, ROWS_AT_ONCE)
            text, begins, size = tokens(some.column(1))
            held.append((text, begins))
            ids += some.column(0).to_pylist()
            sizes.append(size)
            held_bytes += int(size.sum())
            if held_bytes >= CHUNK_BYTES:
                yield from close()
                pa.default_memory_pool().release_unused()
                name, ids, sizes, held_bytes = new_chunk(), [], [], 0
    if ids:
        yield from close()


def new_chunk() -> int:
    return uuid.uuid4().int >> 65


def pack_pairs(before, ending, size, heads, counts) -> bytes:
    """Of each previous word its digest, last bytes and number of pairs; of each pair head and training count."""
    return squeeze([before.astype(np.uint64), ending.astype(np.uint32), size.astype(np.int32), heads.astype(np.uint32),
                    counts.astype(np.int32)])


def unpack_pairs(data: bytes):
    """``(before, ending)`` of each previous word, ``(owner, head, count)`` of each pair."""
    before, ending, size, heads, counts = unsqueeze(data, (np.uint64, np.uint32, np.int32, np.uint32, np.int32))
    return before, ending, np.repeat(np.arange(len(before)), size), heads, counts.astype(np.int64)


def squeeze(arrays: list[np.ndarray]) -> bytes:
    """Arrays as their lengths and, byte by byte of the values, compressed planes."""
    planes = b"".join(x.view(np.uint8).reshape(len(x), -1).T.tobytes() for x in arrays)
    return np.array([len(planes), *map(len, arrays)], np.int64).tobytes() + pa.Codec("zstd", 1).compress(planes, asbytes=True)


def unsqueeze(data: bytes, kinds: tuple) -> list[np.ndarray]:
    total, *lengths = np.frombuffer(data, np.int64, len(kinds) + 1).tolist()
    planes = np.frombuffer(pa.Codec("zstd", 1).decompress(data[8 * len(kinds) + 8:], total, asbytes=True), np.uint8)
    at, out = 0, []
    for kind, n in zip(kinds, lengths, strict=True):
        width = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(planes[at:at + n * width].reshape(width, n).T).reshape(-1).view(kind))
        at += n * width
    return out


# ---------------------------------------------------------------- 2. packed rows
def changes(values: pa.Array) -> np.ndarray:
    """Whether each value differs from the one before it; the first does."""
    return np.concatenate([[True], pc.not_equal(values[1:], values[:-1]).to_numpy(zero_copy_only=False)])


def pack_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Dictionary rows (word, train, chunk, number), sorted by word, to packed rows of whole groups."""
    held: list[pa.RecordBatch] = []
    size, last = 0, None

    def flush() -> pa.RecordBatch:
        t = pa.Table.from_batches(held)
        held.clear()
        words = pa.concat_arrays(t.column("word").chunks).cast(pa.binary())
        new = changes(words)
        word_of = np.cumsum(new) - 1
        text, _, lengths = bytes_of(words.filter(pa.array(new)))
        counts = np.bincount(word_of, t.column("train").to_numpy()).astype(np.int64)
        chunks, chunk_of = np.unique(t.column("chunk").to_numpy(), return_inverse=True)
        row = [text.tobytes(), lengths.astype(np.int32).tobytes(),
               counts.tobytes(), chunks.tobytes(), chunk_of.astype(np.int32).tobytes(),
               t.column("number").to_numpy().astype(np.int32).tobytes(), word_of.astype(np.int32).tobytes()]
        return pa.RecordBatch.from_arrays([pa.array([x]) for x in row], [c.split()[0] for c in PACKED.split(", ")])

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        groups = pc.binary_slice(batch.column("word"), 0, GROUP_BYTES)
        new = changes(groups)
        new[0] = groups[0].as_py() != last
        starts, last = np.flatnonzero(new), groups[n - 1].as_py()
        # Only a group's start may end a packed row; its first part may lie in earlier batches.
        cuts = [0]
        while (k := int(np.searchsorted(starts, PACK_WORDS - size + cuts[-1]))) < len(starts):
            i = int(starts[k])
            if i > cuts[-1]:
                held.append(batch.slice(cuts[-1], i - cuts[-1]))
            if held:
                yield flush()
            size = 0
            cuts.append(i)
        held.append(batch.slice(cuts[-1]))
        size += n - cuts[-1]
    if held:
        yield flush()


class Pack:
    """A packed row; its events are the symbols after the heads of its words."""

    since, until = HEAD, DEEPEST

    def __init__(self, row: dict):
        self.lengths = np.frombuffer(row["lengths"], np.int32).astype(np.int64)
        self.text = np.frombuffer(row["words"], np.uint8)
        self.counts = np.frombuffer(row["counts"], np.int64)
        self.chunks = np.frombuffer(row["chunks"], np.int64)
        self.chunk_of, self.number_of, self.word_of = (
            np.frombuffer(row[k], np.int32) for k in ("chunk_of", "number_of", "word_of"))
        self.at = np.cumsum(self.lengths) - self.lengths
        is_end = (self.lengths == 1) & (self.text[np.minimum(self.at, len(self.text) - 1)] == END[0])
        # Symbols: the word's bytes and a space; an end is its one byte.
        self.symbols = self.lengths + ~is_end

    def symbol(self, words: np.ndarray, depth) -> np.ndarray:
        """The symbol at ``depth`` of each word."""
        inside = depth < self.lengths[words]
        return np.where(inside, self.text[np.where(inside, self.at[words] + depth, 0)], SPACE).astype(np.int64)

    def start(self, words: np.ndarray) -> np.ndarray:
        """A number for each head."""
        head = np.zeros(len(words), np.int64)
        for depth in range(HEAD):
            head = head << 8 | self.symbol(words, depth)
        return runs(head)[2]


class Pairs:
    """A merged part of (previous word, head) pairs, ascending; its events are the symbols of the heads."""

    since, until = 0, HEAD

    def __init__(self, row: dict):
        self.before = np.frombuffer(row["before"], np.uint64)
        self.ending = np.frombuffer(row["endings"], np.uint32).astype(np.int64)
        self.owner = np.frombuffer(row["owners"], np.int32).astype(np.int64)
        self.head = np.frombuffer(row["heads"], np.uint32).astype(np.int64)
        self.counts = np.frombuffer(row["counts"], np.int64)
        # A head ends at its space or line feed, the only one in it.
        self.symbols = np.full(len(self.head), HEAD)
        for depth in reversed(range(HEAD)):
            last = np.isin(self.head >> (24 - 8 * depth) & 255, (SPACE, END[0]))
            self.symbols[last] = depth + 1

    def symbol(self, pairs: np.ndarray, depth) -> np.ndarray:
        """The symbol at ``depth`` of each head; before it a space and the end of the previous word, or the start mark."""
        if depth >= 0:
            return self.head[pairs] >> (24 - 8 * depth) & 255
        ending = self.ending[self.owner[pairs]]
        mark = ending == END[0]
        return np.where(mark, START if depth == -1 else 0, SPACE if depth == -1 else ending >> 8 * (-2 - depth) & 255)

    def start(self, pairs: np.ndarray) -> np.ndarray:
        return self.owner[pairs]


def merge_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pair rows (number, data), sorted by part, to rows of each part's distinct pairs and their training counts, the pairs of a word in one."""
    held: list[tuple] = []
    part, size = None, 0

    def merge() -> None:
        nonlocal size
        befores, endings, owners, heads, counts = zip(*held, strict=True)
        before, first, where = np.unique(np.concatenate(befores), return_index=True, return_inverse=True)
        at = np.cumsum([0, *map(len, befores[:-1])])
        owner = where[np.concatenate([o + a for o, a in zip(owners, at, strict=True)])]
        keys, pair = np.unique(owner << 32 | np.concatenate(heads).astype(np.int64), return_inverse=True)
        total = np.zeros(len(keys), np.int64)
        np.add.at(total, pair, np.concatenate(counts))
        held[:] = [(before, np.concatenate(endings)[first], keys >> 32, (keys & 0xFFFFFFFF).astype(np.uint32), total)]
        size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        merge()
        before, ending, owner, heads, counts = held.pop()
        starts = np.searchsorted(owner, np.arange(len(before) + 1))
        a = 0
        while a < len(before):
            b = max(a + 1, int(np.searchsorted(starts, starts[a] + PACK_WORDS, side="right")) - 1)
            some = slice(starts[a], starts[b])
            row = [before[a:b], ending[a:b], (owner[some] - a).astype(np.int32), heads[some], counts[some]]
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), *[pa.array([x.tobytes()]) for x in row]],
                                             [c.split()[0] for c in MERGED.split(", ")])
            a = b

    for batch in batches:
        for number, data in zip(batch.column("number").to_pylist(), batch.column("data"), strict=True):
            if held and number != part:
                yield from flush()
            part = number
            held.append(unpack_pairs(data.as_py()))
            size += len(held[-1][3])
            if size >= MERGE_PAIRS:
                merge()
    if held:
        yield from flush()


class Events:
    """Bytes to predict: symbol, the ones before it, depth (all from ``DEPTHS`` on, or all the same), count, and the prefix's counts at each bit (8 columns)."""

    def __init__(self, symbol, before, depth, count, zeros=None, ones=None):
        self.symbol, self.count, self.zeros, self.ones = symbol, count, zeros, ones
        self.level = min(int(depth[0]), DEPTHS - 1)
        self.hashes = [(value << np.uint64(8)) * MULTIPLIER for value in contexts(before)]


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``np.unique`` with first places and numbers; values that are in order, as words and pairs lie, are not sorted again."""
    if (values[1:] < values[:-1]).any():
        return np.unique(values, return_index=True, return_inverse=True)
    new = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=new[1:])
    first = np.flatnonzero(new)
    return values[first], first, np.cumsum(new) - 1


def events_of(pack: Pack | Pairs, exact: bool = True) -> Iterator[tuple[Events, np.ndarray, np.ndarray]]:
    """(events, words or pairs, event of each): each distinct prefix and next byte is one event, level by level.

    Without ``exact`` the events lack the prefix's counts.
    """
    words = np.flatnonzero(pack.symbols > pack.since)
    prefix = pack.start(words)
    for depth in range(pack.since, pack.until):
        live = pack.symbols[words] > depth
        words, prefix = words[live], prefix[live]
        if not len(words):
            return
        pairs, first, where = runs(prefix * 256 + pack.symbol(words, depth))
        symbol, origin = pairs & 255, words[first]
        count = np.bincount(where, pack.counts[words], len(pairs))
        zeros = ones = None
        if exact:
            zeros, ones = np.empty((8, len(pairs)), np.float32), np.empty((8, len(pairs)), np.float32)
            # Pairs come sorted by prefix and symbol, so those of one node are neighbours.
            step, below, short = pairs[1:] ^ pairs[:-1], count, symbol.astype(np.uint8)
            for bit in range(7, -1, -1):
                begin = np.concatenate([[0], np.flatnonzero(step >= 1 << (8 - bit)) + 1])
                total = np.repeat(np.add.reduceat(count, begin), np.diff(begin, append=len(pairs))) if len(begin) < len(pairs) else count
                one = np.where((short >> (7 - bit) & 1).view(bool), below, total - below)
                ones[bit], zeros[bit], below = one, total - one, total
            zeros, ones = zeros.T, ones.T
        before = [pack.symbol(origin, depth - k) for k in range(1, ORDERS + 1)]
        yield Events(symbol, before, [depth], count, zeros, ones), words, where
        prefix = where
    if pack.until < DEEPEST:
        return
    # Deeper bytes: short contexts only, all positions of all long words in bounded pieces.
    rest = pack.symbols[words] - DEEPEST
    words, rest = words[rest > 0], rest[rest > 0]
    total = int(rest.sum())
    ends = np.cumsum(rest)
    for a in range(0, total, BATCH):
        at = np.arange(a, min(a + BATCH, total))
        k = np.searchsorted(ends, at, side="right")
        owner, depth = words[k], DEEPEST + at - (ends - rest)[k]
        none = np.zeros((len(at), 8), np.float32) if exact else None
        before = [pack.symbol(owner, depth - j) for j in range(1, ORDERS + 1)]
        yield (Events(pack.symbol(owner, depth), before, depth, pack.counts[owner].astype(float), none, none), owner,
               np.arange(len(at)))


# ---------------------------------------------------------------- 3. the model
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
#: By bit and symbol, what the node that the bits before it lead to adds to a context's hash.
NODES = np.array([[symbol >> (8 - bit) | 1 << bit for symbol in range(256)] for bit in range(8)], np.uint64) * MULTIPLIER
#: The class of a number of occurrences, by the smaller of it and the last index.
CLASSES = np.log2(np.arange(1 << (SEEN - 1)) + 1).astype(np.int8)

#: Neighbours are summed in different lanes: most share a class, and a sum waits for the one before it.
AT_ONCE = 8
LANES = np.arange(BATCH) % AT_ONCE * SEEN


def contexts(before: list[np.ndarray]) -> Iterator[np.ndarray]:
    """The last one to ``ORDERS`` symbols as numbers, the order above them."""
    last = np.zeros(len(before[0]), np.uint64)
    for order in range(1, ORDERS + 1):
        for symbol in before[order - 1:order]:
            last = last << np.uint64(8) | symbol.astype(np.uint64)
        yield last | np.uint64(order << 8 * min(order, len(before)))


def slots(hashes: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """The table slots of contexts at nodes."""
    at = hashes + nodes
    at >>= np.uint64(64 - SLOT_BITS)
    return at.view(np.int64)


def by_class(at: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of values by class."""
    return np.bincount(at, values, AT_ONCE * SEEN).reshape(AT_ONCE, SEEN).sum(0)


def count_contexts(batches: Iterator[pa.RecordBatch], kind: type) -> Iterator[pa.RecordBatch]:
    """Packed rows to (range, data): training counts of zeros and ones at the slots of short contexts, a task's in all."""
    table = np.zeros((ORDERS, 2 << SLOT_BITS), np.int64)
    for batch in batches:
        for row in batch.to_pylist():
            for e, _, _ in events_of(kind(row), exact=False):
                seen = np.flatnonzero(e.count)
                if not len(seen):
                    continue
                symbol, count, hashes = e.symbol[seen], e.count[seen].astype(np.int64), [h[seen] for h in e.hashes]
                for k in range(ORDERS):
                    add_slots(table[k], hashes[k], symbol, count)
    if table.any():
        yield table_rows(table)


def add_slots(table: np.ndarray, hashes: np.ndarray, symbol: np.ndarray, count: np.ndarray) -> None:
    for bit in range(8):
        np.add.at(table, slots(hashes, NODES[bit][symbol]) * 2 + (symbol >> (7 - bit) & 1), count)


def table_rows(table: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.arange(RANGES, dtype=np.int32)), pa.array(
        [squeeze([x]) for x in table.reshape(RANGES, -1)], pa.binary())], ["range", "data"])


def add_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(range, data), sorted by range, to the sum of each range."""
    at, total = None, None
    for batch in batches:
        for number, data in zip(batch.column("range").to_pylist(), batch.column("data"), strict=True):
            values, = unsqueeze(data.as_py(), (np.int64,))
            if number != at and at is not None:
                yield pa.RecordBatch.from_pydict({"range": pa.array([at], pa.int32()), "data": [squeeze([total])]})
            at, total = number, values if number != at else total + values
    if at is not None:
        yield pa.RecordBatch.from_pydict({"range": pa.array([at], pa.int32()), "data": [squeeze([total])]})


def known(zeros: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds and classes of counts."""
    least = np.float32(0.05)
    most = np.float32(len(CLASSES) - 1)
    return np.log((ones + least) / (zeros + least)), CLASSES[np.minimum(zeros + ones, most).astype(np.int32)]


class Mixer:
    """Weights by (gate, predictor, seen), and the refining map by (gate, step)."""

    def __init__(self, table: np.ndarray, weights: np.ndarray | None = None, refined: np.ndarray | None = None):
        self.table = table
        self.weights = np.full((8 * DEPTHS, ORDERS + 1, SEEN), 0.35, np.float64) if weights is None else weights
        self.refined = refined
        #: Log-odds and classes of all slots, with an occurrence's own count taken out (by slot and bit that came) or not.
        self.slots: dict[bool, tuple[np.ndarray, np.ndarray]] = {}

    def of_slots(self, own: bool) -> list[tuple[np.ndarray, np.ndarray]]:
        """By order; with ``own`` first the slots after a zero, then those after a one."""
        if own not in self.slots:
            zeros, ones = self.table
            made = [known(np.maximum(zeros - np.float32(1 - bit), 0), np.maximum(ones - np.float32(bit), 0))
                    for bit in range(2)] if own else [known(zeros, ones)]
            self.slots[own] = [tuple(np.concatenate([x[k << SLOT_BITS:(k + 1) << SLOT_BITS] for x in each])
                                     for each in zip(*made, strict=True)) for k in range(ORDERS)]
        return self.slots[own]

    def inputs(self, hashes: list[np.ndarray], symbol: np.ndarray, zeros: np.ndarray, ones: np.ndarray, bit: int, own: bool):
        """The bit that came, log-odds and classes, by lane, of each predictor; ``own`` takes an occurrence out of its counts."""
        is_one, nodes, lanes = symbol >> (7 - bit) & 1, NODES[bit][symbol], LANES[:len(symbol)]
        after = is_one << SLOT_BITS
        odds, seen = [], []
        for h, (all_odds, all_seen) in zip(hashes, self.of_slots(own), strict=True):
            at = slots(h, nodes)
            if own:
                at += after
            odds.append(np.take(all_odds, at, mode="wrap"))
            seen.append(np.take(all_seen, at, mode="wrap") + lanes)
        if own:
            one = is_one.astype(np.float32)
            zeros, ones = np.maximum(zeros - (1 - one), 0), np.maximum(ones - one, 0)
        last = known(zeros, ones)
        return is_one, [*odds, last[0]], [*seen, last[1] + lanes]

    def mixed(self, gate: int, odds: list[np.ndarray], seen: list[np.ndarray]) -> np.ndarray:
        total = np.zeros(len(odds[0]))
        for weights, o, at in zip(self.weights[gate], odds, seen, strict=True):
            each = np.take(np.tile(weights, AT_ONCE), at, mode="wrap")
            each *= o
            total += each
        return np.clip(total, -12, 12, out=total)

    def learn(self, e: Events, shown: np.ndarray) -> None:
        """One online pass; ``shown`` sums (count, ones) by gate and step of the mixed log-odds."""
        some = np.flatnonzero(e.count > 0)
        if not len(some):
            return

        def of_some(x: np.ndarray) -> np.ndarray:
            return x if len(some) == len(e.count) else x[some]

        symbol, count, hashes = of_some(e.symbol), of_some(e.count), [of_some(h) for h in e.hashes]
        for bit in range(8):
            gate = bit * DEPTHS + e.level
            zeros, ones = of_some(e.zeros[:, bit]), of_some(e.ones[:, bit])
            steps = shown[:, gate * STEPS:(gate + 1) * STEPS]
            for a in range(0, len(some), BATCH):
                part = slice(a, a + BATCH)
                is_one, odds, seen = self.inputs([h[part] for h in hashes], symbol[part], zeros[part], ones[part], bit, True)
                many = count[part]
                mixed = self.mixed(gate, odds, seen)
                p = 1 / (1 + np.exp(-mixed))
                wrong = (is_one - p) * many
                spread = many * p * (1 - p)
                for k in range(ORDERS + 1):
                    push = by_class(seen[k], wrong * odds[k])
                    mass = by_class(seen[k], spread * odds[k] ** 2) + 4.0
                    self.weights[gate, k] += np.clip(RATE * 5 * push / mass, -0.1, 0.1)
                at = np.clip(mixed + STEPS / 2, 0, STEPS - 1).astype(np.int64)
                zero, one = np.bincount(at * 2 + is_one, many, 2 * STEPS).reshape(STEPS, 2).T
                steps += zero + one, one

    def costs(self, e: Events) -> np.ndarray:
        """log10 of each event's probability."""
        # A bit's probability is 1e-6 at least, so the product of eight is far from the smallest number.
        total = np.ones(len(e.symbol))
        for a in range(0, len(total), BATCH):
            part = slice(a, a + BATCH)
            hashes = [h[part] for h in e.hashes]
            for bit in range(8):
                gate = bit * DEPTHS + e.level
                is_one, odds, seen = self.inputs(hashes, e.symbol[part], e.zeros[part, bit], e.ones[part, bit], bit, False)
                mixed = self.mixed(gate, odds, seen)
                p = 1 / (1 + np.exp(-mixed))
                if self.refined is not None:
                    at = np.clip(mixed + STEPS / 2, 0, STEPS - 1).astype(np.int64)
                    p = (p + np.take(self.refined[gate * STEPS:(gate + 1) * STEPS], at)) / 2
                p = np.clip(p, 1e-6, 1 - 1e-6)
                total[part] *= np.where(is_one == 1, p, 1 - p)
        return np.log10(total)


def event_scores(pack: Pack | Pairs, mixer: Mixer) -> np.ndarray:
    """log10 of each word's probability after its head, or of each head's after the previous word."""
    scores = np.zeros(len(pack.symbols))
    for e, words, where in events_of(pack):
        scores += np.bincount(words, mixer.costs(e)[where], len(scores))
    return scores


def word_scores(order: np.ndarray, head: np.ndarray, part: np.ndarray, tails: np.ndarray,
                heads: dict[int, bytes]) -> np.ndarray:
    """log10 of each word's and end's probability in texts in order: its head after the word before it, then the rest.

    ``tails`` by dictionary number; ``heads`` by part, in ascending order of the pairs.
    """
    keys, pair = pairs_of(order, head)
    by_part = in_order(part[keys >> 32])
    after = np.empty(len(keys), np.float32)
    after[by_part] = np.concatenate([np.frombuffer(heads[p], np.float32) for p in sorted(heads)])
    return tails[order] + after[pair]


def fit_model(packed: DataFrame, merged: DataFrame) -> dict[str, np.ndarray]:
    """The short contexts' table, the weights and the refining map, all of fixed size."""
    spark = packed.sparkSession

    def of_both(run, schema: str) -> DataFrame:
        return packed.mapInArrow(lambda batches: run(batches, Pack), schema).unionByName(
            merged.mapInArrow(lambda batches: run(batches, Pairs), schema))

    slot = of_both(count_contexts, "range int, data binary").repartition("range").sortWithinPartitions("range").mapInArrow(
        add_ranges, "range int, data binary")
    # RANGES rows, of ORDERS * 2**SLOT_BITS slots in all, whatever the corpus.
    flat = np.zeros((RANGES, (ORDERS << SLOT_BITS) * 2 // RANGES), np.float32)
    for r in materialize_alone(slot).toLocalIterator():
        flat[r["range"]] = unsqueeze(r["data"], (np.int64,))[0]
    table = flat.reshape(-1, 2).T
    sent = spark.sparkContext.broadcast(table)

    def run(batches, kind):
        mixer, shown = Mixer(sent.value), np.zeros((2, 8 * DEPTHS * STEPS))
        for batch in batches:
            for row in batch.to_pylist():
                pack = kind(row)
                for e, _, _ in events_of(pack):
                    mixer.learn(e, shown)
        mass = shown[0].reshape(-1, STEPS).sum(1)
        if mass.any():
            flat = np.concatenate([(mixer.weights * mass[:, None, None]).reshape(-1), shown.reshape(-1)])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], ["at", "value"])

    sums = of_both(run, "at long, value double").groupBy("at").agg(F.sum("value").alias("value"))
    learned = {r["at"]: r["value"] for r in sums.collect()}
    shape = (8 * DEPTHS, ORDERS + 1, SEEN)
    if not learned:
        return {"table": table, "weights": np.full(shape, 0.35), "refined": None}
    flat = np.array([learned[i] for i in range(len(learned))])
    n = int(np.prod(shape))
    shown = flat[n:].reshape(2, -1)
    # A task's weights count by what it has seen at the gate.
    mass = shown[0].reshape(-1, STEPS).sum(1)[:, None, None]
    weights = np.where(mass > 0, flat[:n].reshape(shape) / np.maximum(mass, 1), 0.35)
    middle = 1 / (1 + np.exp(-(np.tile(np.arange(STEPS), 8 * DEPTHS) - STEPS / 2 + 0.5)))
    # Rounded, since sums arrive in any order.
    return {"table": table, "weights": np.round(weights, 9), "refined": np.round((shown[1] + 8 * middle) / (shown[0] + 8), 9)}


# ---------------------------------------------------------------- 4. documents
def score_merged(batches: Iterator[pa.RecordBatch], mixer: Mixer) -> Iterator[pa.RecordBatch]:
    """Merged pairs to (part, data): each previous word's digest and number of pairs, each pair's head and score."""
    for batch in batches:
        for row in batch.to_pylist():
            pairs = Pairs(row)
            size = np.bincount(pairs.owner, minlength=len(pairs.before)).astype(np.int32)
            data = squeeze([pairs.before, size, pairs.head.astype(np.uint32), event_scores(pairs, mixer).astype(np.float32)])
            yield pa.RecordBatch.from_arrays([pa.array([row["part"]], pa.int32()), pa.array([data])], ["part", "data"])


def match_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (part, chunk): a part's scored pairs, then its pairs of each chunk, to the latter's scores."""
    part, merged, known = None, [], None
    for batch in batches:
        for row in batch.to_pylist():
            if row["part"] != part:
                part, merged, known = row["part"], [], None
            if row["chunk"] is None:
                before, size, head, scores = unsqueeze(row["data"], (np.uint64, np.int32, np.uint32, np.float32))
                merged.append((before, np.repeat(np.arange(len(before)), size), head.astype(np.int64), scores))
                continue
            if known is None:
                befores, owners, heads, scores = zip(*sorted(merged, key=lambda m: m[0][0]), strict=True)
                at = np.cumsum([0, *map(len, befores[:-1])])
                known = (np.concatenate(befores), np.concatenate([(o + a) << 32 | h for o, a, h in zip(owners, at, heads, strict=True)]),
                         np.concatenate(scores))
                merged = []
            before, _, owner, head, _ = unpack_pairs(row["data"])
            key = np.searchsorted(known[0], before)[owner] << 32 | head.astype(np.int64)
            found = known[2][np.searchsorted(known[1], key)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["chunk"]]), pa.array([PAIRS], pa.int32()), pa.array([part], pa.int32()), pa.array([found.tobytes()])], [c.split()[0] for c in FOUND.split(", ")])


def sum_documents(batches: Iterator[pa.RecordBatch], n_train: int, n_words: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (chunk, kind): a chunk's word scores, heads, pair scores, then its documents."""
    chunk, held, info, heads, docs = None, [], None, {}, []

    def close() -> Iterator[pa.RecordBatch]:
        if not docs:
            return
        number, count, tail = (np.concatenate(c) for c in zip(*held, strict=True))
        base, known, tails = np.zeros((3, len(number)))
        base[number] = np.log10((count + 0.5) / (n_train + 0.5 * (n_words + 1)))
        known[number], tails[number] = count > 0, tail
        head, part = np.frombuffer(info, np.uint32, len(number)).astype(np.int64), np.frombuffer(info, np.int32, offset=4 * len(number))
        orders = [unpack_order(x).astype(np.int32) for d in docs for x in d.column("data").to_pylist()]
        words, at = np.concatenate(orders), np.cumsum([0, *map(len, orders[:-1])])
        scores = word_scores(words, head, part, tails, heads)
        sums = [np.add.reduceat(x, at) for x in (base[words], known[words], scores)]
        a = 0
        for d in docs:
            b = a + d.num_rows
            size = d.column("bytes").to_numpy()
            bits = np.divide(-sums[2][a:b] * np.log2(10), size, out=np.full(b - a, np.nan), where=size > 0)
            yield pa.RecordBatch.from_arrays(
                [d.column("doc_id"), d.column("held"), d.column("size"), pa.array(sums[1][a:b].round().astype(np.int64)),
                 pa.array(np.full(b - a, n_train, np.int64)), pa.array(sums[0][a:b]), pa.array(sums[2][a:b]),
                 pa.array(bits, mask=size == 0)], [c.split()[0] for c in SCORED.split(", ")])
            a = b

    for batch in batches:
        names, kinds = batch.column("chunk").to_numpy(), batch.column("kind").to_numpy()
        cuts = [0, *(np.flatnonzero((names[1:] != names[:-1]) | (kinds[1:] != kinds[:-1])) + 1), len(names)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a == b:
                continue
            part = batch.slice(a, b - a)
            if names[a] != chunk:
                yield from close()
                chunk, held, info, heads, docs = names[a], [], None, {}, []
            if kinds[a] == WORDS:
                held += [unsqueeze(x, (np.int32, np.int64, np.float32)) for x in part.column("data").to_pylist()]
            elif kinds[a] == HEADS:
                info = part.column("data")[0].as_py()
            elif kinds[a] == PAIRS:
                heads.update(zip(part.column("number").to_pylist(), part.column("data").to_pylist(), strict=True))
            else:
                docs.append(part)
    yield from close()


def score_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte of every whole text."""
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    parts = max(8, (own.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // PART_BYTES)
    chunks = materialize_alone(own.mapInArrow(lambda batches: write_chunks(batches, parts), CHUNKS), compression="zstd")
    words = chunks.where(F.col("kind") == WORDS).select("word", "train", "chunk", "number")
    # A group is the start of its words, so words in order keep groups together.
    packed = materialize_alone(words.repartition(F.substring("word", 1, GROUP_BYTES)).sortWithinPartitions("word").mapInArrow(pack_words, PACKED), compression="zstd")
    pairs = chunks.where(F.col("kind") == PAIRS).select(F.col("number").alias("part"), "chunk", "data")
    merged = materialize_alone(pairs.select(F.col("part").alias("number"), "data").repartition("number").sortWithinPartitions(
        "number").mapInArrow(merge_pairs, MERGED), compression="zstd")
    model = fit_model(packed, merged)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def mixer() -> Mixer:
        return Mixer(sent.value["table"], sent.value["weights"], sent.value["refined"])

    def score_words(batches):
        own = mixer()
        for batch in batches:
            for row in batch.to_pylist():
                pack = Pack(row)
                scores, n = event_scores(pack, own), len(pack.chunks)
                order = np.argsort(pack.chunk_of, kind="stable")
                ends = np.searchsorted(pack.chunk_of[order], np.arange(n + 1))
                data = [squeeze([pack.number_of[some], pack.counts[pack.word_of[some]], scores[pack.word_of[some]].astype(np.float32)])
                        for some in (order[a:b] for a, b in zip(ends, ends[1:], strict=False))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pack.chunks), pa.array(np.full(n, WORDS, np.int32)), pa.nulls(n, pa.int32()), pa.array(data, pa.binary())],
                    [c.split()[0] for c in FOUND.split(", ")])

    def totals(batches):
        for batch in batches:
            for row in batch.to_pylist():
                counts = np.frombuffer(row["counts"], np.int64)
                yield pa.RecordBatch.from_pylist([{"n": int(counts.sum()), "v": int((counts > 0).sum())}])

    total = packed.select("counts").mapInArrow(totals, "n long, v long").agg(F.sum("n"), F.sum("v")).first()
    n_train, n_words = total[0] or 0, total[1] or 0
    scored = merged.mapInArrow(lambda batches: score_merged(batches, mixer()), "part int, data binary")
    asked = scored.withColumn("chunk", F.lit(None).cast("long")).unionByName(pairs).repartition("part").sortWithinPartitions("part", "chunk")
    found = packed.mapInArrow(score_words, FOUND).unionByName(asked.mapInArrow(match_pairs, FOUND))
    rest = chunks.where(F.col("kind").isin(HEADS, DOCS)).select("chunk", "kind", "data", "doc_id", "held", "size", "bytes")
    met = found.unionByName(rest, allowMissingColumns=True).repartition("chunk").sortWithinPartitions("chunk", "kind")
    return met.mapInArrow(lambda batches: sum_documents(batches, n_train, n_words), SCORED)
