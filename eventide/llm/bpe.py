"""Byte-level BPE encoding and decoding by prefix dynamic programming.

For a byte string, ``last[i]`` is the last token of the encoding of its first i + 1 bytes.
It is unique: of the tokens that end there, exactly one follows a prefix encoding whose own
last token it does not merge with.  A table entry depends on earlier bytes alone, so an
append only extends the table, and after an edit the old entries hold again as soon as the
last ``longest`` of them come out as before.

Whether two tokens stand side by side is decided by definition: merging their joined bytes
by rank gives the two back.  Answers are memoised.

A text is cut by the pre-tokenizer pattern.  A match begins at every space that a character
other than white space follows, so texts in which all spaces are such are cut at them and
each unit's ids are looked up; other texts go through the pattern whole.  Caches
are bounded and emptied when full, so a worker's memory does not follow the corpus.

Defined cases: a null text encodes as the empty text (no ids); any length; a document is
one row, so nothing is grouped or shuffled; rows repeated come back repeated; an empty
table gives an empty result; columns other than id and text are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.warm import warm

#: Units in one half of the cache, about 200 bytes each; half as many pieces.
UNITS_KEPT = 1 << 19
PAIRS_KEPT = 1 << 19
ROWS_AT_ONCE = 64
#: A space before white space or the end: it may belong to a match that began before it.
NOT_BETWEEN_UNITS = re.compile(r" (?:\s|\Z)")
ENCODED = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class Recent(dict):
    """``find`` of what is asked for, kept in two halves: when the new one is full, it becomes the old one."""

    def __init__(self, find, kept: int):
        super().__init__()
        self.find, self.kept, self.before = find, kept, {}

    def __missing__(self, key):
        if len(self) >= self.kept:
            self.before = dict(self)
            self.clear()
        value = self.before.get(key)
        if value is None:
            value = self.find(key)
        self[key] = value
        return value


class Vocabulary:
    """Token ids and bytes, and the prefix tables over them."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = dict(zip(ranks.values(), ranks.keys(), strict=True))
        self.longest = max(map(len, ranks))
        #: Every ending of a token: its id if it is a token itself, else -1.
        self.tails = {t[i:]: ranks.get(t[i:], -1) for t in ranks for i in range(len(t))}
        self._beside: dict[int, bool] = {}
        self._halves: dict[int, tuple[int, int] | None] = {}
        #: All tokens that end at each byte of a string, found in one pass over it.
        self.matcher = ahocorasick.Automaton()
        for t, i in ranks.items():
            self.matcher.add_word(t.decode("latin-1"), (i, len(t)))
        self.matcher.make_automaton()

    def merged(self, data: bytes, below: int | None = None) -> list[int]:
        """The definition: join the neighbours of lowest rank, leftmost first, while any pair has one (less than ``below``)."""
        parts = [data[i:i + 1] for i in range(len(data))]
        none = len(self.ranks) + len(data) if below is None else below
        while len(parts) > 1:
            rank, i = min(((self.ranks.get(a + b, none), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))))
            if rank >= none or parts[i] + parts[i + 1] not in self.ranks:
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge gives ``token``; None for a byte."""
        found = self._halves.get(token, ())
        if found == ():
            parts = self.merged(self.token[token], token)
            found = self._halves[token] = tuple(parts) if len(parts) == 2 else None
        return found

    def _stays(self, left: int, right: int) -> bool:
        """Whether no merge ever crosses the border of ``left`` and ``right``, going back through the merges that made them.

        While the neighbours at the border are (a, b), a merge of the two crosses it if it comes
        before the merge that made the next pair there.  Of equal ranks the leftmost goes first,
        which is the one across the border when that next merge is to its right.
        """
        a, b, before = left, right, len(self.ranks) + 1
        while True:
            if self.ranks.get(self.token[a] + self.token[b], before) < before:
                return False
            back = (a, b) if a > b else (b, a)
            for later in back:
                parts = self.halves(later)
                if parts is not None:
                    break
            else:
                return True
            if later == a and (a > b or self.halves(b) is None):
                a, before = parts[1], a
            else:
                b, before = parts[0], b + 1

    def beside(self, left: int, right: int) -> bool:
        """Whether ``left`` directly before ``right`` stays so under the merges."""
        key = left << 24 | right
        found = self._beside.get(key)
        if found is None:
            if len(self._beside) >= PAIRS_KEPT:
                self._beside.clear()
            found = self._beside[key] = self._stays(left, right)
        return found

    def last_token(self, data: bytes, end: int, last: list[int]) -> int:
        """The last token of ``data[:end]``, given those of all shorter prefixes."""
        tails, found = self.tails, []
        for at in range(end - 1, -1, -1):
            token = tails.get(data[at:end])
            if token is None:
                break
            if token >= 0:
                found.append((at, token))
        for start, token in reversed(found):
            if start == 0 or self.beside(last[start - 1], token):
                return token
        raise ValueError(f"the vocabulary has no token for byte {data[end - 1]}")

    def table(self, data: bytes, last: list[int] | None = None) -> list[int]:
        """Last tokens of all prefixes; ``last`` holds those of a shorter prefix, if known."""
        if not last:
            return self._whole_table(data)
        last = list(last)
        for end in range(len(last) + 1, len(data) + 1):
            last.append(self.last_token(data, end, last))
        return last

    def _whole_table(self, data: bytes) -> list[int]:
        """``table`` from the start, with the candidates of every prefix found in one pass, the longest first."""
        last: list[int] = []
        known, done = self._beside.get, -1
        for end, (token, n) in self.matcher.iter(data.decode("latin-1")):
            if end != done:
                if n <= end:
                    left = last[end - n]
                    stays = known(left << 24 | token)
                    if not (self.beside(left, token) if stays is None else stays):
                        continue
                last.append(token)
                done = end
        if len(last) < len(data):
            raise ValueError(f"the vocabulary has no token for byte {data[len(last)]}")
        return last

    def read_back(self, last: list[int]) -> list[int]:
        """The encoding, from its end: each last token leads to the prefix before it."""
        ids, end = [], len(last)
        while end:
            ids.append(last[end - 1])
            end -= len(self.token[ids[-1]])
        return ids[::-1]

    def encode(self, data: bytes) -> list[int]:
        if data in self.ranks:
            return [self.ranks[data]]
        return self.read_back(self.table(data))

    def edit(self, data: bytes, last: list[int], start: int, end: int, new: bytes) -> tuple[bytes, list[int]]:
        """Replace ``data[start:end]`` by ``new``: the new bytes and their table, recomputed near the edit only."""
        changed = data[:start] + new + data[end:]
        table, shift, same = last[:start], len(new) - (end - start), 0
        for stop in range(start + 1, len(changed) + 1):
            table.append(self.last_token(changed, stop, table))
            old = stop - 1 - shift
            # Past the edit by a longest token, entries repeat if as many before them do.
            same = same + 1 if stop > start + len(new) and last[old] == table[-1] else 0
            if same >= self.longest:
                return changed, table + last[old + 1:]
        return changed, table


class TextEncoder:
    """Whole texts: the pattern's matches, each encoded alone; and ids back to bytes."""

    def __init__(self, vocabulary: Vocabulary, pattern: str, units_kept: int = UNITS_KEPT):
        self.vocabulary, self.pattern = vocabulary, regex.compile(pattern)
        self.bytes_of = [vocabulary.token.get(i, b"") for i in range(max(vocabulary.token) + 1)]
        self.name_of = [str(i) for i in range(len(self.bytes_of))]
        self.pieces = Recent(lambda piece: tuple(vocabulary.encode(piece.encode())), units_kept // 2)
        #: Ids of a unit with its leading space.
        self.spaced = Recent(lambda unit: tuple(self.matches(" " + unit)), units_kept)
        #: What such a unit adds to a text's digests.
        self.told_of = Recent(lambda unit: self._told(self.matches(" " + unit)), units_kept)

    def matches(self, text: str) -> Iterator[int]:
        return chain.from_iterable(map(self.pieces.__getitem__, self.pattern.findall(text)))

    def encode(self, text: str) -> list[int]:
        if NOT_BETWEEN_UNITS.search(text):
            return list(self.matches(text))
        units = text.split(" ")
        return list(chain(self.matches(units[0]), chain.from_iterable(map(self.spaced.__getitem__, units[1:]))))

    def told(self, text: str) -> tuple[int, str, bytes]:
        """The number of ids, the ids in decimal joined by spaces, and the bytes they decode to: joins of the units' own."""
        if NOT_BETWEEN_UNITS.search(text):
            return self._told(self.matches(text))
        units = text.split(" ")
        first = self._told(self.matches(units[0]))
        if len(units) == 1:
            return first
        counts, names, data = zip(*map(self.told_of.__getitem__, units[1:]), strict=True)
        return first[0] + sum(counts), " ".join((first[1], *names) if first[0] else names), first[2] + b"".join(data)

    def _told(self, matches: Iterator[int]) -> tuple[int, str, bytes]:
        ids = list(matches)
        return len(ids), self.decimal(ids), self.decode(ids)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def decimal(self, ids: list[int]) -> str:
        return " ".join(map(self.name_of.__getitem__, ids))


def text_encoder(path: str, pattern: str, units_kept: int = UNITS_KEPT) -> TextEncoder:
    def make() -> TextEncoder:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        return TextEncoder(Vocabulary(ranks), pattern, units_kept)
    return warm(("bpe", path, pattern, units_kept), make)


def rows_of(batch: pa.RecordBatch, step: int = ROWS_AT_ONCE) -> Iterator[list]:
    """Lists of the batch's columns, a few rows at a time."""
    for at in range(0, batch.num_rows, step):
        yield [c.to_pylist() for c in batch.slice(at, step).columns]


def encode_texts(docs: DataFrame, ranks_path: str, pattern: str, doc_id: str = "doc_id",
                 text: str = "text", units_kept: int = UNITS_KEPT) -> DataFrame:
    """(doc_id, ids) of every whole text."""
    def run(batches):
        encoder = text_encoder(ranks_path, pattern, units_kept)
        for batch in batches:
            for ids, texts in rows_of(batch):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array([encoder.encode(t or "") for t in texts], pa.list_(pa.int32()))],
                    ["doc_id", "ids"])
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return own.mapInArrow(run, "doc_id long, ids array<int>")


def encoding_digests(docs: DataFrame, ranks_path: str, pattern: str, doc_id: str = "doc_id",
                     text: str = "text") -> DataFrame:
    """Per document: the number of ids, and the SHA-256 of the ids and of the bytes they decode to."""
    def run(batches):
        encoder = text_encoder(ranks_path, pattern)
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for ids, texts in rows_of(batch):
                for i, t in zip(ids, texts, strict=True):
                    n, names, data = encoder.told(t or "")
                    for column, value in zip(out, (i, n, hashlib.sha256(names.encode()).hexdigest(), hashlib.sha256(
                            data).hexdigest()), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string()),
                 pa.array(out[3], pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return own.mapInArrow(run, ENCODED)
