"""Zstandard WARC archives: one frame a record, the dictionary in the leading skippable frame.

Written form.  A file may begin with a skippable frame (magic 0x184D2A5D) that holds the
compression dictionary, itself a Zstandard frame or plain.  Every record follows as a frame of
its own, so any record can be decoded from its offset alone.  A page is a ``response`` record
whose block is an HTTP response with the page as its payload, or a ``revisit`` record that
names the record with the same payload and keeps the HTTP head only.

Reading.  ``read_records`` takes a file frame by frame in bounded memory (one record) and
checks what it reads: the version line, the fields every record needs, Content-Length against
the block, the record's end, one record to a frame, the HTTP length against the payload and
the payload's digest.  Anything else, a frame cut short included, raises ``WarcError`` with the
offset.

Defined results: a null html is an empty payload; a null url writes no target; control
characters and spaces of a url are percent-encoded in its header.  Payloads of under
``LEAST_BYTES`` bytes are never revisits.  Rows that repeat the first page's id with the same
payload are responses like it; null ids come last, and a payload with null ids alone has
responses only.  An empty table writes nothing and reads nothing.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.warm import let_go
from eventide.session import materialize, scratch_dir

#: Magic numbers of the dictionary's skippable frame and of a Zstandard frame, and the format's texts.
DICTIONARY_MAGIC, FRAME_MAGIC = 0x184D2A5D, 0xFD2FB528
VERSION = b"WARC/1.1"
NEEDED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RESPONSE_TYPE = "application/http; msgtype=response"
PAGE_ID = re.compile(r"<urn:page:(-?\d*)>")

LEAST_BYTES = 100
#: A file ends after so many payload bytes; its dictionary is trained on at most so many of its first ones.
FILE_BYTES, SAMPLE_BYTES, DICTIONARY_BYTES = 64 << 20, 1 << 20, 16 << 10
READ_BYTES = 1 << 18


class WarcError(ValueError):
    """An archive that breaks the format, with the offset of the frame at fault."""


@dataclass
class Record:
    offset: int
    fields: dict[str, str]
    block: bytes


# ------------------------------------------------------------------ writing
def train_dictionary(samples: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary of the samples; None where there are too few to train one."""
    if len(samples) < 16:
        return None
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8)
    except zstandard.ZstdError:
        return None


def dictionary_frame(dictionary: zstandard.ZstdCompressionDict) -> bytes:
    packed = zstandard.ZstdCompressor().compress(dictionary.as_bytes())
    return struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed


def header_uri(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c.group()):02X}", url)


def page_name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One record: a response with the payload, or a revisit where ``refers_to`` is given."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", page_name(page_id)),
              ("WARC-Date", date), ("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", RESPONSE_TYPE)]
    if url is not None:
        fields.append(("WARC-Target-URI", header_uri(url)))
    if refers_to is not None:
        fields += [("WARC-Refers-To", page_name(refers_to)), ("WARC-Profile", PROFILE)]
    fields.append(("Content-Length", str(len(block))))
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


class ArchiveWriter:
    """Records into one file; the first ``SAMPLE_BYTES`` of them wait until the dictionary is trained."""

    def __init__(self, out: BinaryIO):
        self.out, self.waiting, self.held, self.pack = out, [], 0, None
        self.n = 0

    def add(self, record: bytes) -> None:
        self.n += 1
        if self.pack is not None:
            self.out.write(self.pack(record))
            return
        self.waiting.append(record)
        self.held += len(record)
        if self.held >= SAMPLE_BYTES:
            self._begin()

    def _begin(self) -> None:
        dictionary = train_dictionary(self.waiting)
        if dictionary is not None:
            self.out.write(dictionary_frame(dictionary))
            dictionary.precompute_compress(level=3)
        self.pack = zstandard.ZstdCompressor(level=3, dict_data=dictionary, write_checksum=True).compress
        for record in self.waiting:
            self.out.write(self.pack(record))
        self.waiting = []

    def close(self) -> None:
        if self.pack is None:
            self._begin()


# ------------------------------------------------------------------ reading
class _Source:
    """Bytes of a stream in order, with some that are given back."""

    def __init__(self, stream: BinaryIO):
        self.stream, self.ahead, self.offset = stream, b"", 0

    def some(self) -> bytes:
        got, self.ahead = self.ahead or self.stream.read(READ_BYTES), b""
        self.offset += len(got)
        return got

    def give_back(self, rest: bytes) -> None:
        self.offset -= len(rest)
        self.ahead = rest + self.ahead

    def exactly(self, n: int) -> bytes:
        parts = []
        while n > 0:
            got = self.some()
            if not got:
                raise WarcError(f"the file ends {n} bytes early at {self.offset}")
            parts.append(got[:n])
            self.give_back(got[n:])
            n -= len(parts[-1])
        return b"".join(parts)

    def at_end(self) -> bool:
        got = self.some()
        self.give_back(got)
        return not got


def _dictionary(source: _Source) -> zstandard.ZstdCompressionDict | None:
    """The dictionary of the leading skippable frame, if there is one."""
    if source.at_end():
        return None
    start = source.exactly(4)
    if struct.unpack("<I", start)[0] != DICTIONARY_MAGIC:
        source.give_back(start)
        return None
    content = source.exactly(struct.unpack("<I", source.exactly(4))[0])
    if content[:4] == struct.pack("<I", FRAME_MAGIC):
        try:
            content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
        except zstandard.ZstdError as broken:
            raise WarcError(f"dictionary: {broken}") from broken
    return zstandard.ZstdCompressionDict(content)


def parse_record(offset: int, data: bytes) -> Record:
    """A frame's bytes as a record, checked."""
    def fault(what: str) -> WarcError:
        return WarcError(f"record at {offset}: {what}")

    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or lines[0] != VERSION:
        raise fault(f"begins with {lines[0][:40]!r}, not {VERSION!r}")
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            raise fault(f"a header line without a name: {line[:40]!r}")
        fields[name.decode("latin-1").strip()] = value.decode("utf-8", "replace").strip()
    absent = [n for n in NEEDED if n not in fields]
    if absent:
        raise fault(f"no {', '.join(absent)}")
    if not fields["Content-Length"].isdecimal():
        raise fault(f"Content-Length {fields['Content-Length']!r}")
    size = int(fields["Content-Length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise fault(f"Content-Length {size}, but {len(rest) - 4} bytes before the record's end")
    return Record(offset, fields, rest[:size])


def read_records(stream: BinaryIO) -> Iterator[Record]:
    """The records of an archive in order, each checked."""
    source = _Source(stream)
    unpack = zstandard.ZstdDecompressor(dict_data=_dictionary(source))
    while not source.at_end():
        offset, frame, parts = source.offset, unpack.decompressobj(), []
        while not frame.eof:
            got = source.some()
            if not got:
                raise WarcError(f"the frame at {offset} is cut short")
            try:
                parts.append(frame.decompress(got))
            except zstandard.ZstdError as broken:
                raise WarcError(f"the frame at {offset}: {broken}") from broken
        source.give_back(frame.unused_data)
        data = b"".join(parts)
        if data:  # further skippable frames have no content
            yield parse_record(offset, data)


def page_of(record: Record) -> tuple[int | None, int, str, str, int | None]:
    """(page_id, payload bytes, payload digest, record type, page_id referred to) of a page's record, checked."""
    def fault(what: str) -> WarcError:
        return WarcError(f"record at {record.offset}: {what}")

    def page(field: str) -> int | None:
        named = PAGE_ID.fullmatch(record.fields.get(field, ""))
        if not named:
            raise fault(f"{field} {record.fields.get(field)!r}")
        return int(named.group(1)) if named.group(1) else None

    head, gap, payload = record.block.partition(b"\r\n\r\n")
    stated = re.search(rb"(?i)\r\nContent-Length: *(\d+)", head)
    kind, digest = record.fields["WARC-Type"], record.fields.get("WARC-Payload-Digest", "")
    if not gap or not stated or not re.fullmatch(r"sha256:[0-9a-f]{64}", digest):
        raise fault("no HTTP length or no payload digest")
    size, digest = int(stated.group(1)), digest[7:]
    if kind == "revisit":
        if payload:
            raise fault("a revisit with a payload")
        return page("WARC-Record-ID"), size, digest, kind, page("WARC-Refers-To")
    if kind != "response" or len(payload) != size or hashlib.sha256(payload).hexdigest() != digest:
        raise fault(f"a {kind} whose payload of {len(payload)} bytes is not the one of its header")
    return page("WARC-Record-ID"), size, digest, kind, None


# ------------------------------------------------------------------ on Spark
def _open(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri)


def with_first_copies(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id, url, payload, digest, refers_to``: ``refers_to`` is the smallest page with the same payload, if another.

    Copies are found from digests alone, summed before the shuffle.  The join's side of repeated
    payloads has a row a payload; Spark broadcasts it where its measured size allows and splits a
    skewed payload's rows elsewhere.
    """
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                        F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    seen = rows.where(F.octet_length("payload") >= LEAST_BYTES).groupBy("digest").agg(
        F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = F.col("page_id").isNull() | (F.col("page_id") > F.col("first"))
    return rows.join(seen.select("digest", "first"), "digest", "left").select(
        "page_id", "url", "payload", "digest", F.when(again, F.col("first")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z", **columns: str) -> DataFrame:
    """Write ``pages`` as archives in ``folder``, a URI all executors can write; the report ``path, n_records``.

    Each task writes its rows as they come.  A file's name holds the attempt, and the report names
    only files of attempts that finished, so a lost executor leaves nothing that is read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        task = TaskContext.get()
        k, writer, out, path, size = 0, None, None, None, 0

        def close() -> pa.RecordBatch:
            writer.close()
            out.close()
            return pa.RecordBatch.from_pylist([{"path": path, "n_records": writer.n}])

        for batch in batches:
            for page_id, url, payload, digest, refers_to in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if writer is None:
                    path = f"{folder}/pages-{task.partitionId():06d}-{k:06d}-{task.taskAttemptId()}.warc.zst"
                    where, name = _open(path)
                    out, k, size = where.open_output_stream(name, compression=None), k + 1, 0
                    writer = ArchiveWriter(out)
                writer.add(page_record(page_id, url, payload, digest, refers_to, date))
                size += len(payload)
                if size >= FILE_BYTES:
                    yield close()
                    writer = None
        if writer is not None:
            yield close()

    where, name = _open(folder)
    where.create_dir(name, recursive=True)
    return materialize(with_first_copies(pages, **columns).mapInArrow(run, "path string, n_records long"))


def read_archives(report: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of every record of the reported archives."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]

        def made(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        for batch in batches:
            for path, n in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                where, name = _open(path)
                rows: list[tuple] = []
                with where.open_input_stream(name, compression=None) as stream:
                    for record in read_records(stream):
                        rows.append(page_of(record))
                        n -= 1
                        if len(rows) == 4096:
                            yield made(rows)
                            rows = []
                if n:
                    raise WarcError(f"{path}: {n} records fewer than were written")
                if rows:
                    yield made(rows)

    tasks = int(report.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return report.select("path", "n_records").repartition(tasks, "path").mapInArrow(
        run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archived_pages(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as archives in the shared scratch folder and read them back."""
    folder = f"{scratch_dir(pages.sparkSession)}/warc-{uuid.uuid4().hex[:8]}"
    return read_archives(write_archives(pages, folder))
