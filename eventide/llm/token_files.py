"""Token-ID output: fixed-width bit packing with block offsets.

File layout, little-endian: magic ``TIDS0001``; six uint32 (bits per id, ids per block,
documents, blocks, and the id count as two halves); the documents' ids (int64, null as the
lowest value), their first positions in the file (int64, one more than documents), the
blocks' byte offsets in the payload (int64, one more than blocks); the payload.

Every id takes the bits that the largest id of the vocabulary needs.  Eight ids fill
exactly ``bits`` bytes, so packing and unpacking are a few numpy shifts over lanes of every
eighth id.  Blocks start on a byte, and any range of ids is read from its blocks alone.

Documents are range-partitioned and sorted by id; each task writes files of at most
``FILE_IDS`` ids (one document never spans files) under a name of its own and reports
them; a repeated attempt writes under other names, and only reported files are read.  The
position of a file in the whole stream is the running sum of that small report.

Defined cases: a null or empty text is its end id alone; a null doc_id sorts first; rows
that share a doc_id are adjacent documents; an empty table writes no file and gives no
rows; columns other than id and text are ignored.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventide.llm.bpe import NOT_BETWEEN_UNITS, rows_of
from eventide.llm.warm import warm
from eventide.session import materialize, scratch_dir

MAGIC = b"TIDS0001"
NO_ID = -(1 << 63)
BLOCK_IDS = 4096
FILE_IDS = 1 << 22
UNITS_KEPT, ASKED_AT_ONCE = 1 << 20, 4096
#: A white-space character of one byte, and stops that the pre-tokenizer cuts from letters.
SEPARATOR, STOPS = "\x0b", ".,!?;:"


#: Widths of whole bytes, where packing is numpy's own cast.
WHOLE = {8: "u1", 16: "<u2", 32: "<u4"}


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """``ids`` in ``bits`` bits each, the first in the lowest bits; the last byte is filled up with zeros."""
    if bits in WHOLE:
        return ids.astype(WHOLE[bits]).tobytes()
    lanes = np.zeros((-(-len(ids) // 8), 8), np.uint64)
    lanes.reshape(-1)[:len(ids)] = ids
    out = np.zeros((len(lanes), bits), np.uint8)
    for lane in range(8):
        at = lane * bits
        for byte in range(at // 8, (at + bits - 1) // 8 + 1):
            move = 8 * byte - at
            part = lanes[:, lane] >> np.uint64(move) if move >= 0 else lanes[:, lane] << np.uint64(-move)
            out[:, byte] |= (part & np.uint64(255)).astype(np.uint8)
    return out.tobytes()[:(len(ids) * bits + 7) // 8]


def unpack(data: bytes, bits: int, count: int) -> np.ndarray:
    """The first ``count`` ids of ``pack``'s bytes."""
    if bits in WHOLE:
        return np.frombuffer(data, WHOLE[bits], count).astype(np.uint32)
    rows = -(-count // 8)
    raw = np.zeros(rows * bits, np.uint8)
    raw[:len(data)] = np.frombuffer(data, np.uint8)[:rows * bits]
    raw = raw.reshape(rows, bits)
    out = np.zeros((rows, 8), np.uint64)
    for lane in range(8):
        at = lane * bits
        for byte in range(at // 8, (at + bits - 1) // 8 + 1):
            move = 8 * byte - at
            part = raw[:, byte].astype(np.uint64)
            out[:, lane] |= part << np.uint64(move) if move >= 0 else part >> np.uint64(-move)
    return (out & np.uint64((1 << bits) - 1)).astype(np.uint32).reshape(-1)[:count]


def file_bytes(doc_ids: list[int], starts: np.ndarray, ids: np.ndarray, bits: int) -> bytes:
    blocks = [pack(ids[i:i + BLOCK_IDS], bits) for i in range(0, len(ids), BLOCK_IDS)]
    offsets = np.cumsum([0, *map(len, blocks)]).astype("<i8")
    head = np.array([bits, BLOCK_IDS, len(doc_ids), len(blocks), len(ids) & 0xFFFFFFFF, len(ids) >> 32], "<u4")
    return b"".join([MAGIC, head.tobytes(), np.array(doc_ids, "<i8").tobytes(), starts.astype("<i8").tobytes(),
                     offsets.tobytes(), *blocks])


class TokenFile:
    """Random access to one file: only the tables and the blocks asked for are read."""

    def __init__(self, source):
        self.source = source
        if self._at(0, 8) != MAGIC:
            raise ValueError("not a token file")
        self.bits, self.block, docs, blocks, low, high = np.frombuffer(self._at(8, 24), "<u4").tolist()
        self.n_ids = low + (high << 32)
        table = np.frombuffer(self._at(32, 8 * (2 * docs + 1 + blocks + 1)), "<i8")
        self.doc_ids, self.starts, self.offsets = table[:docs], table[docs:2 * docs + 1], table[2 * docs + 1:]
        self.payload = 32 + 8 * len(table)

    def _at(self, start: int, size: int) -> bytes:
        self.source.seek(start)
        return self.source.read(size)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """The ids at positions ``start`` to ``stop`` (exclusive) of the file."""
        if stop <= start:
            return np.empty(0, np.uint32)
        first, last = start // self.block, (stop - 1) // self.block
        raw = self._at(self.payload + int(self.offsets[first]), int(self.offsets[last + 1] - self.offsets[first]))
        # Full blocks fill whole bytes, so a run of blocks unpacks in one go.
        got = unpack(raw, self.bits, min(self.n_ids, (last + 1) * self.block) - first * self.block)
        return got[start - first * self.block:stop - first * self.block]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.starts[k]), int(self.starts[k + 1]))


class LibraryEncoder:
    """The tokenizers library, asked once for each unit between spaces while a bounded cache holds it.

    The cache has two halves: when the new one is full it becomes the old one, and units found
    there move back.  Units are asked many at a time, joined by a separator that the
    pre-tokenizer sets apart as one token; a letters-only word with a stop after it is the word
    and the stop, as the pre-tokenizer cuts it.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.spaced: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.separator, = self._ids(SEPARATOR)
        self.newline = np.array(self._ids("\n"), "<u4").tobytes()
        self.stops = {c: np.array(self._ids(c), "<u4").tobytes() for c in STOPS}

    def _ids(self, text: str) -> list[int]:
        # The fast form leaves out offsets, which nothing here reads.
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _ask(self, texts: list[str]) -> list[bytes]:
        """Each text's ids; texts that could run into a separator are asked alone."""
        out: list[bytes | None] = [None] * len(texts)
        joined = []
        for i, t in enumerate(texts):
            if not t or SEPARATOR in t or t[-1].isspace() or (t[0].isspace() and t[0] != " "):
                out[i] = np.array(self._ids(t), "<u4").tobytes()
            else:
                joined.append(i)
        for a in range(0, len(joined), ASKED_AT_ONCE):
            some = joined[a:a + ASKED_AT_ONCE]
            ids = np.array(self._ids(SEPARATOR.join([texts[i] for i in some])), "<u4")
            cuts = np.flatnonzero(ids == self.separator)
            raw, starts, ends = ids.tobytes(), [0, *(4 * (cuts + 1)).tolist()], [*(4 * cuts).tolist(), 4 * len(ids)]
            for i, x, y in zip(some, starts, ends, strict=True):
                out[i] = raw[x:y]
        return out

    def _learn(self, wanted: set[str], turn: bool = True) -> None:
        """Put the ids of all ``wanted`` units into the cache.

        A unit stands after a space; one that begins with a line feed stands for itself.  Units
        of several lines are their lines, as the pre-tokenizer sets a lone line feed apart.
        """
        new = wanted.difference(self.spaced)
        if turn and len(self.spaced) + len(new) > UNITS_KEPT:
            self.before, self.spaced, new = self.spaced, {}, wanted
        again = {u for u in new if u in self.before}
        self.spaced.update((u, self.before[u]) for u in again)
        new = new - again
        broken = {u: parts for u in new if "\n" in u[1:] and (parts := self._lines(u))}
        if broken:
            self._learn(set().union(*broken.values()), turn=False)
            self.spaced.update((u, b"".join(map(self.spaced.__getitem__, parts))) for u, parts in broken.items())
        stopped = {u for u in new if u not in broken and u[-1] in STOPS and u[u[0] == "\n":-1].isalpha()}
        bare = list(new.difference(broken, stopped).union(w for u in stopped if (w := u[:-1]) not in self.spaced))
        ids = self._ask([u[1:] if u[0] == "\n" else " " + u for u in bare])
        self.spaced.update((u, self.newline + x if u[0] == "\n" else x) for u, x in zip(bare, ids, strict=True))
        self.spaced.update((u, self.spaced[u[:-1]] + self.stops[u[-1]]) for u in stopped)

    @staticmethod
    def _lines(unit: str) -> list[str] | None:
        """The unit as units of one line each, if its line feeds stand alone between other characters."""
        lines = unit[unit[0] == "\n":].split("\n")
        if all(x and not x[0].isspace() and not x[-1].isspace() for x in lines):
            return [lines[0] if unit[0] != "\n" else "\n" + lines[0], *("\n" + x for x in lines[1:])]
        return None

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian uint32; texts whose spaces or ends are inside white space go to the library whole."""
        units = [None if not t or t[0].isspace() or NOT_BETWEEN_UNITS.search(t) else t.split(" ") for t in texts]
        plain = [u for u in units if u]
        for u in plain:
            u[0] = "\n" + u[0]
        self._learn(set().union(*plain))
        rest = iter(self._ask([t for t, u in zip(texts, units, strict=True) if not u]))
        skip = len(self.newline)
        return [next(rest) if not u else b"".join(map(self.spaced.__getitem__, u))[skip:] for u in units]


def library_encoder(path: str) -> LibraryEncoder:
    return warm(("library", path), lambda: LibraryEncoder(path))


def _open(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri)


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, vocabulary: int, end_id: int,
                      doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the files and return their report: (part, seq, path, n_ids) in stream order."""
    bits = bits_for(vocabulary)

    def run(batches):
        encoder = library_encoder(tokenizer_path)
        task = TaskContext.get()
        part, attempt, end = task.partitionId(), task.taskAttemptId(), np.array([end_id], "<u4").tobytes()
        held_ids: list[int] = []
        held: list[bytes] = []
        size = seq = 0

        def flush():
            nonlocal size, seq
            path = f"{folder}/ids-{part:06d}-{seq:06d}-{attempt}.bin"
            starts = np.cumsum([0, *(len(h) // 4 for h in held)])
            where, name = _open(path)
            with where.open_output_stream(name) as out:
                out.write(file_bytes(held_ids, starts, np.frombuffer(b"".join(held), "<u4"), bits))
            row = pa.RecordBatch.from_pylist([{"part": part, "seq": seq, "path": path, "n_ids": size}])
            held_ids.clear()
            held.clear()
            size, seq = 0, seq + 1
            return row

        for batch in batches:
            for ids, texts in rows_of(batch):
                for i, coded in zip(ids, encoder.encode([t or "" for t in texts]), strict=True):
                    n = len(coded) // 4 + 1
                    if held and size + n > FILE_IDS:
                        yield flush()
                    held_ids.append(NO_ID if i is None else i)
                    held.append(coded + end)
                    size += n
        if held:
            yield flush()

    where, name = _open(folder)
    where.create_dir(name, recursive=True)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    return materialize(rows.mapInArrow(run, "part long, seq long, path string, n_ids long"))


def read_documents(report: DataFrame) -> DataFrame:
    """Read the files back: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    ahead = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    files = report.withColumn("first", F.coalesce(F.sum("n_ids").over(ahead), F.lit(0))).select("path", "first")

    def run(batches):
        for batch in batches:
            for path, first in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                where, name = _open(path)
                with where.open_input_file(name) as source:
                    f = TokenFile(source)
                    ids = f.ids(0, f.n_ids).astype("<u4")
                starts = f.starts.tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([None if d == NO_ID else d for d in f.doc_ids.tolist()], pa.int64()),
                     pa.array([first + s for s in starts[:-1]], pa.int64()),
                     pa.array(np.diff(f.starts), pa.int64()),
                     pa.array([zlib.crc32(ids[a:b]) for a, b in zip(starts, starts[1:], strict=False)], pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"])

    tasks = int(report.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(tasks, "path").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(spark: SparkSession, docs: DataFrame, tokenizer_path: str, vocabulary: int, end_id: int) -> DataFrame:
    """Write ``docs`` under the shared scratch folder and read the documents back."""
    import uuid

    folder = f"{scratch_dir(spark)}/tokens-{uuid.uuid4().hex[:8]}"
    return read_documents(write_token_files(docs, folder, tokenizer_path, vocabulary, end_id))
