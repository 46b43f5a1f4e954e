"""Spelling variants: words one edit apart, found by Gram matrices of letter counts.

A word's letters are counted over a fixed alphabet.  One replaced letter moves two counts by
one each, one inserted or deleted letter moves one, so words one edit apart have count vectors
at a squared distance of 2 (equal lengths) or 1 (adjacent lengths).  Squared distances come
from NumPy products of blocks of count vectors: |a|^2 + |b|^2 - 2ab.

Blocks hold words that can be near.  The alphabet is cut into ``GROUPS`` groups; one edit
touches two at most, so near words agree on every count of some ``GROUPS - 2`` groups.  Each
word joins one block per choice of that many groups; a block holds the words with the same
counts there, ordered by length, and only equal and adjacent lengths are multiplied.  A pair
is kept in the first block in which it meets.  Blocks of over ``SPLIT`` words are cut into
parts, and each pair of parts is a block of its own, so no task holds an unbounded one and no
word pair is lost.

Defined results: a null text has no words, a null id counts as an empty string; equal rows
count each; an empty table gives no rows.  Columns besides the id and the text are not read,
whatever their names.  Texts are read whole, at any length.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.llm.textops import whole
from eventide.llm.warm import let_go
from eventide.session import materialize, materialize_counted

#: The letters of a word (only A-Z is lower-cased, so capitals above stay themselves).
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = "[a-zÀ-ÿ]"
ALPHABET = np.array([*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)])
#: Letters from the most to the least usual in European text, dealt to the groups in turn; the others follow by code.
USUAL = "enirtasduhlocgmbfvwkpzyéüäöèàçxqjêù"
GROUPS = 5
SHORTEST, LEAST_N, RATIO, DELETE_EVERY = 7, 2, 10, 31
TILE, SPLIT = 64, 8192
#: Rows multiplied in one call: a bound of a worker's memory (tiles x TILE x TILE floats).
CHUNK = 16_384

CHOICES = list(itertools.combinations(range(GROUPS), GROUPS - 2))


def _groups() -> np.ndarray:
    """The group of each letter of ``ALPHABET``: back and forth over the groups in order of use."""
    order = [ord(c) for c in USUAL] + [c for c in ALPHABET.tolist() if chr(c) not in USUAL]
    lap = [*range(GROUPS), *reversed(range(GROUPS))]
    of = {c: lap[k % len(lap)] for k, c in enumerate(order)}
    return np.array([of[c] for c in ALPHABET.tolist()])


GROUP_OF = _groups()
COLUMN_OF = np.zeros(256, np.int64)
COLUMN_OF[ALPHABET] = np.arange(len(ALPHABET))
#: Odd multipliers that hash a choice's counts to 64 bits; a collision only adds words to compare.
MIX = np.random.default_rng(20).integers(-2**62, 2**62, len(ALPHABET)) | 1


def words_of(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, n``: the words of at least ``SHORTEST`` letters found at least ``LEAST_N`` times.

    One letter is deleted from a run whose checksum ``DELETE_EVERY`` divides.  Built-in functions
    only; occurrences are summed before the shuffle.
    """
    runs = F.regexp_extract_all(F.translate(whole(text), UPPER, LOWER), F.lit(f"{LETTERS}{{{SHORTEST},}}"), F.lit(0))
    found = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("_id"), F.explode(runs).alias("run"))
    mark = F.crc32(F.concat(F.col("_id"), F.lit(":"), F.col("run")))
    found = found.select("run", mark.alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    words = found.select(F.when(F.col("h") % DELETE_EVERY == 0, cut).otherwise(F.col("run")).alias("word"))
    return (words.where(F.length("word") >= SHORTEST).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= LEAST_N))


def _bytes_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All letters as one Latin-1 array, and where each word starts in it."""
    starts = np.zeros(len(words) + 1, np.int64)
    np.cumsum(pc.utf8_length(words).to_numpy(), out=starts[1:])
    return np.frombuffer("".join(words.to_pylist()).encode("latin-1"), np.uint8), starts


def letter_counts(letters: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One row of counts over ``ALPHABET`` for each word."""
    n, width = len(starts) - 1, len(ALPHABET)
    cell = np.repeat(np.arange(n), np.diff(starts)) * width + COLUMN_OF[letters]
    return np.bincount(cell, minlength=n * width).reshape(n, width)


def _block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(choice, key, length, word, n): each word once for every choice of groups."""
    let_go()
    for batch in batches:
        for at in range(0, batch.num_rows, CHUNK):
            part = batch.slice(at, CHUNK)
            words, n = part.column(0), part.column(1)
            letters, starts = _bytes_of(words)
            counts = letter_counts(letters, starts)
            size = pa.array(np.diff(starts).astype(np.int32))
            for k, keep in enumerate(CHOICES):
                columns = np.flatnonzero(np.isin(GROUP_OF, keep))
                key = counts[:, columns] @ MIX[columns]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(words), k, np.int32)), pa.array(key), size, words, n],
                    ["choice", "key", "length", "word", "n"])


#: Words of up to so many letters are compared as rows of one array, longer ones each for itself.
WIDTH = 32


def _one_edit(x: bytes, y: bytes) -> bool:
    """Whether one replaced, or one inserted or deleted, letter turns ``x`` into ``y``."""
    if len(x) > len(y):
        x, y = y, x
    same = next((i for i, (a, b) in enumerate(zip(x, y, strict=False)) if a != b), len(x))
    return x[same + (len(x) == len(y)):] == y[same + 1:] and x != y


def _one_edit_rows(x: np.ndarray, y: np.ndarray, same_length: np.ndarray) -> np.ndarray:
    """``_one_edit`` for rows of letters filled up with zeros; a row of ``y`` is as long as that of ``x``, or one longer."""
    differs = x != y
    first = differs.argmax(1)
    after = np.arange(x.shape[1] - 1) >= first[:, None]
    inserted = ~((x[:, :-1] != y[:, 1:]) & after).any(1)
    return np.where(same_length, differs.sum(1) == 1, inserted)


def _first_choice(difference: np.ndarray) -> np.ndarray:
    """The first choice of groups in which each pair's counts agree; ``difference`` is a pair's count vectors' difference."""
    touched = np.stack([(difference[:, GROUP_OF == g] != 0).any(1) for g in range(GROUPS)], 1)
    agrees = np.stack([~touched[:, list(keep)].any(1) for keep in CHOICES], 1)
    return agrees.argmax(1)


class Tiles:
    """Words ordered by (block, length), multiplied tile by tile."""

    def __init__(self, block: np.ndarray, words: pa.Array):
        self.letters, self.starts = _bytes_of(words)
        self.length = np.diff(self.starts)
        self.block = block
        counts = letter_counts(self.letters, self.starts)
        # Long words have counts whose squares need more than a float's 24 bits.
        self.kind = np.float32 if self.length.max(initial=0) < 2000 else np.float64
        self.counts = counts.astype(self.kind)
        self.square = (self.counts * self.counts).sum(1)
        # Words as rows of WIDTH letters, filled up with zeros; those of longer ones are not used.
        place = np.arange(len(self.letters)) - np.repeat(self.starts[:-1], self.length)
        row = np.repeat(np.arange(len(self.length)), self.length)
        inside = place < WIDTH
        self.rows = np.zeros((len(self.length), WIDTH), np.uint8)
        self.rows[row[inside], place[inside]] = self.letters[inside]

    def spelled(self, i: int) -> bytes:
        return self.letters[self.starts[i]:self.starts[i + 1]].tobytes()

    def candidates(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(i, j), i < j, of one block whose squared distance allows one edit."""
        n = len(self.block)
        tiles = -(-n // TILE)
        pad = tiles * TILE - n
        counts = np.pad(self.counts, ((0, pad), (0, 0))).reshape(tiles, TILE, -1)
        square = np.pad(self.square, (0, pad)).reshape(tiles, TILE)
        block = np.pad(self.block, (0, pad), constant_values=-1).reshape(tiles, TILE)
        length = np.pad(self.length, (0, pad), constant_values=-9).reshape(tiles, TILE)
        last = np.minimum(np.arange(1, tiles + 1) * TILE, n) - 1
        step, left = 0, np.arange(tiles)
        while len(left):
            for some in np.array_split(left, -(-len(left) * TILE // CHUNK)):
                right = some + step
                near = square[some][:, :, None] + square[right][:, None, :]
                near -= 2 * np.matmul(counts[some], counts[right].transpose(0, 2, 1))
                t, a, b = np.nonzero((near > 0.5) & (near < 2.5))
                d = near[t, a, b].round().astype(int)
                i, j = some[t] * TILE + a, right[t] * TILE + b
                apart = np.abs(length[some[t], a] - length[right[t], b])
                good = (i < j) & (block[some[t], a] == block[right[t], b]) & (block[some[t], a] >= 0) & (apart == 2 - d)
                yield i[good], j[good]
            step += 1
            left = left[left + step < tiles]
            # On while the tile's last word can still meet words of its block that are one longer at most.
            end, first = last[left], (left + step) * TILE
            left = left[(self.block[end] == self.block[first]) & (self.length[first] - self.length[end] <= 1)]

    def _verified(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        short = np.where(self.length[i] <= self.length[j], i, j)
        long = i + j - short
        good = np.zeros(len(i), bool)
        narrow = self.length[long] < WIDTH
        s, t = short[narrow], long[narrow]
        good[narrow] = _one_edit_rows(self.rows[s], self.rows[t], self.length[s] == self.length[t])
        for k in np.flatnonzero(~narrow).tolist():
            good[k] = _one_edit(self.spelled(short[k]), self.spelled(long[k]))
        return good

    def pairs(self, choice: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(i, j) one edit apart, each pair in the first block of those in which it meets."""
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for i, j in self.candidates():
            good = self._verified(i, j)
            i, j = i[good], j[good]
            first = _first_choice(self.counts[i] - self.counts[j]) == choice[i]
            found.append((i[first], j[first]))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows again, in batches that end where a block ends."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = [batch.column(k).to_numpy() for k in range(4)]
        turns = np.flatnonzero(np.any([c[1:] != c[:-1] for c in ids], 0)) + 1
        if held:
            before = [held[-1].column(k)[-1].as_py() for k in range(4)]
            if before != [c[0] for c in ids]:
                turns = np.concatenate([[0], turns])
        if len(turns) and rows + turns[-1] >= CHUNK // 4:
            cut = int(turns[-1])
            held.append(batch.slice(0, cut))
            yield pa.Table.from_batches([h for h in held if h.num_rows]).combine_chunks().to_batches()[0]
            held, rows, batch = [], 0, batch.slice(cut)
        held.append(batch)
        rows += batch.num_rows
    if rows:
        yield pa.Table.from_batches([h for h in held if h.num_rows]).combine_chunks().to_batches()[0]


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, near, near_n), both ways, from rows (choice, key, one, other, own, length, word, n) in order."""
    let_go()
    for rows in _whole_blocks(batches):
        choice, key, one, other, own = (rows.column(k).to_numpy() for k in range(5))
        opens = np.any([c[1:] != c[:-1] for c in (choice, key, one, other)], 0)
        tiles = Tiles(np.concatenate([[0], np.cumsum(opens)]), rows.column(6))
        i, j = tiles.pairs(choice)
        # Two parts of a split block meet here; pairs inside one part have a block of their own.
        apart = (one[i] == other[i]) | (own[i] != own[j])
        a, b = np.concatenate([i[apart], j[apart]]), np.concatenate([j[apart], i[apart]])
        if len(a):
            word = rows.column(6)
            yield pa.RecordBatch.from_arrays([word.take(pa.array(a)), word.take(pa.array(b)), rows.column(7).take(
                pa.array(b))], ["word", "near", "near_n"])


def near_words(words: DataFrame, split: int = SPLIT) -> DataFrame:
    """``word, near, near_n`` for every ordered pair of words one edit apart, from distinct ``word, n``."""
    rows = materialize(words.select("word", "n").mapInArrow(
        _block_rows, "choice int, key long, length int, word string, n long"))
    large = rows.groupBy("choice", "key").agg(F.count(F.lit(1)).alias("_m")).where(F.col("_m") > split)
    rows = rows.join(large, ["choice", "key"], "left")
    parts = F.coalesce(F.ceil(F.col("_m") / split), F.lit(1)).cast("int")
    own = F.pmod(F.xxhash64("word"), parts).cast("int")
    cells = F.transform(F.sequence(F.lit(0), parts - 1), lambda k: F.struct(F.least(own, k).alias("one"), F.greatest(
        own, k).alias("other")))
    rows = rows.select("choice", "key", own.alias("own"), "length", "word", "n", F.explode(cells).alias("c")).select(
        "choice", "key", "c.one", "c.other", "own", "length", "word", "n")
    block = ["choice", "key", "one", "other"]
    return rows.repartition(*block).sortWithinPartitions(*block, "length", "word").mapInArrow(
        _near, "word string, near string, near_n long")


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root``: the last of the forms that follow each other from ``word, form``.

    A form is at least ``RATIO`` times as frequent as its word, so chains are short and have no
    cycles; each round doubles the steps taken.
    """
    reached, n = materialize_counted(forms.select("word", F.col("form").alias("root")))
    while n:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("_then"))
        reached = materialize(reached.join(onward, "root", "left").select(
            "word", F.coalesce("_then", "root").alias("root"), F.col("_then").isNotNull().alias("_moved")))
        n = 0 if reached.where("_moved").isEmpty() else 1
        reached = reached.select("word", "root")
    return reached


def spelling_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of the texts (see the module doc).

    ``form`` is the most frequent near word (ties: the first in code-point order) if it is at least
    ``RATIO`` times as frequent, else null; ``root`` the last form reached, the word itself if none.
    """
    words = materialize(words_of(docs, doc_id, text))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    near = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("b"))
    wins = -F.col("b.less") >= RATIO * F.col("n")
    found = materialize(words.join(near, "word", "left").select(
        "word", F.when(wins, F.col("b.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias(
            "n_near"), F.when(wins, -F.col("b.less")).alias("form_n")))
    roots = _roots(found.where("form IS NOT NULL"))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
