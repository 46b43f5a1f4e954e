"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word enters as its own embedding (hashed) beside the mean embedding of its character
n-grams (hashed), so unseen forms of known words are read by their characters.  A gated
recurrent layer runs over a window of words in both directions, attention pools its states,
and a linear layer gives the window's logit.  All overlapping windows of a text are scored;
the text's logit is the largest, however many windows there are.  The same pooling is
trained, so the network itself finds which windows of a labelled text carry the label.

The fit is bounded by documented parameters: at most ``MAX_TOXIC`` and ``MAX_CLEAN``
labelled rows, the first in hashed order of their ids.  Texts of up to ``TRAIN_WORDS`` words
are learned whole.  All windows of longer ones are scored by what these taught, and their
highest windows, again up to ``TRAIN_WORDS`` words, join a second fit: the largest logit
depends on no other windows.  The model's size is fixed.  Scoring covers every whole text, one pass, no shuffle.

Defined cases: a null or empty text, or one of separators only, scores the share of label 1
in the fitting sample (at most 0.49); without labelled rows of both classes every text does;
labels other than 0 and 1 are ignored, and a document labelled both ways counts as 1; very
long texts are scored window by window in bounded batches; repeated rows are scored alike;
an empty table gives an empty result; other columns are never inputs.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from eventide.llm.bpe import rows_of
from eventide.llm.textops import OTHER_SPACES, whole, words
from eventide.llm.warm import let_go

WINDOW, STRIDE = 48, 24
WORD_BUCKETS, GRAM_BUCKETS, GRAMS = 1 << 14, 1 << 15, (3, 5)
WORD_DIM, GRAM_DIM, HIDDEN, ATTENTION = 8, 8, 8, 8
MAX_TOXIC, MAX_CLEAN, TRAIN_WORDS = 1200, 3600, 2000
UPDATES, TEXTS_AT_ONCE, RATE = 500, 24, 0.01
#: More than the words of WINDOWS_AT_ONCE windows.
WORDS_KEPT = 1 << 17
WINDOWS_AT_ONCE = 1024
PUNCTUATION = ".,;:!?\"'()[]{}<>*#$%&|-_~`"



def text_words(text: str | None) -> list[str]:
    text = (text or "").lower()
    for c in OTHER_SPACES:
        text = text.replace(c, " ")
    parts = text.split(" ")
    return [w for w in parts if w] if "" in parts else parts


def word_features(found: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each word's embedding row; the rows of all their character n-grams, and how many each word has.

    N-grams are taken from ``^word$`` as bytes, punctuation at its ends left off, for all words at once.
    """
    bare = [(w.strip(PUNCTUATION) or w).encode() for w in found]
    rows = np.fromiter(map(zlib.crc32, bare), np.int64, len(bare)) % WORD_BUCKETS
    size = np.fromiter(map(len, bare), np.int64, len(bare)) + 2
    text = np.frombuffer(b"^" + b"$^".join(bare) + b"$" + bytes(max(GRAMS)), np.uint8).astype(np.uint64)
    end = np.repeat(np.cumsum(size), size)
    at = np.arange(len(end))
    owner = np.repeat(np.arange(len(bare)), size)
    grams, owners = [], []
    for n in GRAMS:
        value = np.zeros(len(end), np.uint64)
        for k in range(n):
            value = (value << np.uint64(8)) | text[k:k + len(end)]
        inside = at + n <= end
        value = (value[inside] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)
        grams.append((value % np.uint64(GRAM_BUCKETS)).astype(np.int64))
        owners.append(owner[inside])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return rows, np.concatenate(grams)[order], np.bincount(owner, minlength=len(bare))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def initial(seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    normal = lambda *shape, s=0.1: rng.normal(0, s, shape).astype(np.float32)
    return {"word": normal(WORD_BUCKETS, WORD_DIM, s=0.05), "gram": normal(GRAM_BUCKETS, GRAM_DIM, s=0.2),
            "into": normal(WORD_DIM + GRAM_DIM, 6 * HIDDEN, s=0.5), "bias": np.zeros(6 * HIDDEN, np.float32),
            "turn": normal(2, HIDDEN, 3 * HIDDEN, s=0.3), "look": normal(2 * HIDDEN, ATTENTION, s=0.5),
            "seek": normal(ATTENTION, s=0.5), "out": normal(2 * HIDDEN, s=0.5), "base": np.zeros(1, np.float32)}


def cut(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts of ``sizes`` words laid end to end: each window's text, first word and length."""
    count = np.where(sizes > WINDOW, -(-(sizes - WINDOW) // STRIDE) + 1, (sizes > 0).astype(np.int64))
    text = np.repeat(np.arange(len(sizes)), count)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    start = nth * STRIDE
    return text, start + (np.cumsum(sizes) - sizes)[text], np.minimum(sizes[text] - start, WINDOW)


class Network:
    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights

    def gates(self, vectors: np.ndarray) -> np.ndarray:
        """The part of all gates that words' input vectors give: (words, 2 directions, 3 * HIDDEN)."""
        return (vectors @ self.w["into"] + self.w["bias"]).reshape(-1, 2, 3 * HIDDEN)

    def forward(self, given: np.ndarray, there: np.ndarray, keep: bool = False):
        """Logits of windows; ``given``: gate inputs (windows, WINDOW, 2, 3 * HIDDEN), ``there``: which words exist."""
        w, (n, steps) = self.w, there.shape
        state = np.zeros((2, n, HIDDEN), np.float32)
        states = np.empty((n, steps, 2 * HIDDEN), np.float32)
        exists = there.astype(np.float32)
        trace = []
        for t in range(steps):
            back = steps - 1 - t
            x = np.stack([given[:, t, 0], given[:, back, 1]])
            own = np.matmul(state, w["turn"])
            both = sigmoid(x[..., :2 * HIDDEN] + own[..., :2 * HIDDEN])
            hold, reset = both[..., :HIDDEN], both[..., HIDDEN:]
            fresh = np.tanh(x[..., 2 * HIDDEN:] + reset * own[..., 2 * HIDDEN:])
            real = np.stack([exists[:, t], exists[:, back]])[..., None]
            after = (fresh + hold * (state - fresh)) * real
            if keep:
                trace.append((state, own[..., 2 * HIDDEN:], hold, reset, fresh, real))
            state = after
            states[:, t, :HIDDEN] = state[0]
            states[:, back, HIDDEN:] = state[1]
        seen = np.tanh(states @ w["look"])
        drive = np.where(there, seen @ w["seek"], -1e9)
        share = np.exp(drive - drive.max(axis=1, keepdims=True))
        share /= share.sum(axis=1, keepdims=True)
        pooled = np.einsum("nt,nth->nh", share, states)
        logits = pooled @ w["out"] + w["base"]
        return (logits, (states, seen, share, pooled, trace)) if keep else logits

    def backward(self, d_logits: np.ndarray, kept) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of the weights behind the gates, and of the gate inputs."""
        w, (states, seen, share, pooled, trace) = self.w, kept
        n, steps = share.shape
        g = {"out": pooled.T @ d_logits, "base": d_logits.sum(keepdims=True)}
        d_pooled = d_logits[:, None] * w["out"]
        d_states = share[..., None] * d_pooled[:, None]
        d_share = np.einsum("nth,nh->nt", states, d_pooled)
        d_drive = share * (d_share - (share * d_share).sum(axis=1, keepdims=True))
        g["seek"] = np.einsum("nt,nta->a", d_drive, seen)
        d_seen = d_drive[..., None] * w["seek"] * (1 - seen * seen)
        g["look"] = states.reshape(-1, 2 * HIDDEN).T @ d_seen.reshape(-1, ATTENTION)
        d_states = d_states + d_seen @ w["look"].T
        g["turn"] = np.zeros_like(w["turn"])
        d_given = np.empty((n, steps, 2, 3 * HIDDEN), np.float32)
        d_next = np.zeros((2, n, HIDDEN), np.float32)
        for t in reversed(range(steps)):
            back = steps - 1 - t
            state, own_fresh, hold, reset, fresh, real = trace[t]
            d = (d_next + np.stack([d_states[:, t, :HIDDEN], d_states[:, back, HIDDEN:]])) * real
            d_fresh = d * (1 - hold) * (1 - fresh * fresh)
            d_hold = d * (state - fresh) * hold * (1 - hold)
            d_reset = d_fresh * own_fresh * reset * (1 - reset)
            d_x = np.concatenate([d_hold, d_reset, d_fresh], axis=2)
            d_own = np.concatenate([d_hold, d_reset, d_fresh * reset], axis=2)
            g["turn"] += np.matmul(state.transpose(0, 2, 1), d_own)
            d_next = d * hold + np.matmul(d_own, w["turn"].transpose(0, 2, 1))
            d_given[:, t, 0], d_given[:, back, 1] = d_x[0], d_x[1]
        return g, d_given


def pool(logits: np.ndarray, text: np.ndarray, count: int, default: float) -> tuple[np.ndarray, np.ndarray]:
    """Each text's largest logit of its windows, and the windows' shares in it (equal ones share alike)."""
    top = np.full(count, -np.inf)
    np.maximum.at(top, text, logits)
    share = (logits == top[text]).astype(np.float64)
    share /= np.bincount(text, share, count)[text]
    return np.where(np.isfinite(top), top, default), share


def train(texts: list[str], labels: list[int], updates: int = UPDATES, seed: int = 7) -> dict[str, np.ndarray]:
    """Adam on the cross-entropy of whole texts, classes drawn evenly."""
    w = initial(seed)
    share = min(0.49, sum(labels) / len(labels)) if labels else 0.0
    w["prior"] = np.array([np.log(max(share, 1e-6) / (1 - share))], np.float32)
    if not 0 < sum(labels) < len(labels):
        return w | {"untrained": np.ones(1, np.float32)}
    index: dict[str, int] = {}
    coded = [np.array([index.setdefault(x, len(index)) for x in text_words(t)], np.int64) for t in texts]
    word_row, gram_row, gram_size = word_features(list(index))
    gram_at = np.concatenate([[0], np.cumsum(gram_size)])
    rng = np.random.default_rng(seed)
    groups = [np.array([i for i, y in enumerate(labels) if y == c and len(coded[i])]) for c in (0, 1)]
    if not len(groups[0]) or not len(groups[1]):
        return w | {"untrained": np.ones(1, np.float32)}
    net = Network(w)
    names = [k for k in w if k != "prior"]
    first = {k: np.zeros_like(w[k]) for k in names}
    second = {k: np.zeros_like(w[k]) for k in names}
    for step in range(1, updates + 1):
        some = np.concatenate([rng.choice(groups[0], TEXTS_AT_ONCE // 3 * 2), rng.choice(groups[1], TEXTS_AT_ONCE // 3)])
        y = np.array([labels[i] for i in some], np.float32)
        sizes = np.array([len(coded[i]) for i in some])
        used, local = np.unique(np.concatenate([coded[i] for i in some]), return_inverse=True)
        spans = gram_size[used]
        rows = gram_row[np.repeat(gram_at[used] - np.cumsum(spans) + spans, spans) + np.arange(spans.sum())]
        owner = np.repeat(np.arange(len(used)), spans)
        mean = np.add.reduceat(w["gram"][rows], np.cumsum(spans) - spans) / spans[:, None]
        vectors = np.concatenate([w["word"][word_row[used]], mean], axis=1).astype(np.float32)
        text, start, size = cut(sizes)
        there = np.arange(WINDOW) < size[:, None]
        place = local[np.minimum(start[:, None] + np.arange(WINDOW), len(local) - 1)]
        gates = net.gates(vectors)
        logits, kept = net.forward(gates[place], there, keep=True)
        whole_text, weight = pool(logits.astype(np.float64), text, len(some), 0.0)
        wrong = (sigmoid(whole_text) - y) / len(some)
        d_logits = (wrong[text] * weight).astype(np.float32)
        g, d_given = net.backward(d_logits, kept)
        d_gates = np.zeros((len(used), 6 * HIDDEN), np.float32)
        np.add.at(d_gates, place[there], d_given.reshape(*there.shape, -1)[there])
        g["into"], g["bias"] = vectors.T @ d_gates, d_gates.sum(axis=0)
        d_vectors = d_gates @ w["into"].T
        g["word"], g["gram"] = np.zeros_like(w["word"]), np.zeros_like(w["gram"])
        np.add.at(g["word"], word_row[used], d_vectors[:, :WORD_DIM])
        np.add.at(g["gram"], rows, (d_vectors[:, WORD_DIM:] / spans[:, None])[owner])
        rate = RATE * (1 - 0.9 * step / updates)
        for k in names:
            first[k] += 0.1 * (g[k] - first[k])
            second[k] += 0.01 * (g[k] * g[k] - second[k])
            w[k] -= (rate * (first[k] / (1 - 0.9 ** step))
                     / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
    return w


class Scorer:
    """Scores whole texts with a bounded table of words' gate inputs."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.net, self.default = Network(weights), float(weights["prior"][0])
        self.known = "untrained" not in weights
        self.table = np.zeros((WORDS_KEPT, 2, 3 * HIDDEN), np.float32)
        self.row: dict[str, int] = {}

    def _learn(self, new: list[str]) -> None:
        w = self.net.w
        rows, grams, spans = word_features(new)
        mean = np.add.reduceat(w["gram"][grams], np.cumsum(spans) - spans) / spans[:, None]
        vectors = np.concatenate([w["word"][rows], mean], axis=1).astype(np.float32)
        at = len(self.row)
        self.table[at:at + len(new)] = self.net.gates(vectors)
        self.row.update(zip(new, range(at, at + len(new)), strict=True))

    def rows(self, found: list[str]) -> np.ndarray:
        """The words' rows of the table, which is emptied when full; it always holds one call's words."""
        new = list(set(found).difference(self.row))
        if len(self.row) + len(new) > WORDS_KEPT:
            self.row.clear()
            new = list(set(found))
        if new:
            self._learn(new)
        return np.fromiter(map(self.row.__getitem__, found), np.int64, len(found))

    def window_logits(self, found: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """The text and the logit of every window; long texts are cut into runs of windows, so memory stays bounded."""
        text, start, size = cut(np.array([len(f) for f in found], np.int64))
        flat = [x for f in found for x in f]
        logits = np.empty(len(text))
        for a in range(0, len(text), WINDOWS_AT_ONCE):
            b = min(a + WINDOWS_AT_ONCE, len(text))
            low, high = int(start[a]), int(start[b - 1] + size[b - 1])
            index = self.rows(flat[low:high])
            there = np.arange(WINDOW) < size[a:b, None]
            place = index[np.minimum(start[a:b, None] - low + np.arange(WINDOW), high - low - 1)]
            logits[a:b] = self.net.forward(self.table[place], there)
        return text, logits

    def logits(self, texts: list[str | None]) -> np.ndarray:
        found = [text_words(t) for t in texts]
        if not self.known or not any(found):
            return np.full(len(texts), self.default)
        text, logits = self.window_logits(found)
        return pool(logits, text, len(texts), self.default)[0]

    def highest(self, text: str) -> str:
        """The windows of the largest logits, TRAIN_WORDS words at most, in the order of the text.

        Windows start at multiples of STRIDE, so each is cut from what this returns again.
        """
        found = text_words(text)
        _, logits = self.window_logits([found])
        kept = np.zeros(len(found), bool)
        for nth in np.argsort(-logits, kind="stable")[:TRAIN_WORDS // WINDOW]:
            kept[nth * STRIDE:nth * STRIDE + WINDOW] = True
        return " ".join(found[i] for i in np.flatnonzero(kept))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        return np.round(sigmoid(self.logits(texts)), 6)


def is_held_out(doc_id: str = "doc_id"):
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def fit(docs: DataFrame, labels: DataFrame, updates: int = UPDATES) -> dict[str, np.ndarray]:
    """Train on a bounded sample of the labelled rows that are not held out."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~is_held_out())
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    sample = known.where("toxic = 1").orderBy(*order).limit(MAX_TOXIC).unionByName(
        known.where("toxic = 0").orderBy(*order).limit(MAX_CLEAN))
    # MAX_TOXIC + MAX_CLEAN ids at most: a proven size for a broadcast.
    body = docs.select(F.col("doc_id").alias("_id"), whole("text").alias("_text"))
    rows = body.join(F.broadcast(sample), F.col("_id") == F.col("doc_id")).select("doc_id", "toxic", "_text")
    size = F.size(words(F.col("_text")))

    def gathered(rows: DataFrame) -> dict[int, tuple[str, int]]:
        each = rows.groupBy("doc_id").agg(F.max("_text").alias("text"), F.max("toxic").alias("toxic")).collect()
        return {r["doc_id"]: (r["text"], r["toxic"]) for r in each}

    def fitted(found: dict[int, tuple[str, int]]) -> dict[str, np.ndarray]:
        return train([found[i][0] for i in sorted(found)], [found[i][1] for i in sorted(found)], updates)

    short, long = gathered(rows.where(size <= TRAIN_WORDS)), rows.where(size > TRAIN_WORDS)
    weights = fitted(short)
    # If the short texts taught nothing, the first choice of windows is blind and is made again.
    for _ in range(2 if "untrained" in weights or not short else 1):
        sent = docs.sparkSession.sparkContext.broadcast(weights)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            let_go()
            scorer = Scorer(sent.value)
            for batch in batches:
                for ids, toxic, texts in rows_of(batch):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids, pa.int64()), pa.array(toxic, pa.int32()),
                         pa.array([scorer.highest(t) for t in texts], pa.string())], ["doc_id", "toxic", "_text"])

        picked = gathered(long.select(F.col("doc_id").cast("long"), "toxic", "_text").mapInArrow(
            run, "doc_id long, toxic int, _text string"))
        if not picked:
            break
        weights = fitted(picked | short)
    return weights


def score_texts(docs: DataFrame, weights: dict[str, np.ndarray], text: str = "text",
                keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns (all, if not given) plus ``score``, the probability of label 1 of each whole text.

    A column that is already named score is replaced.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c != "score"]
    fields = [docs.schema[c] for c in keep]
    # Inside, columns go by number, so they may have any names.
    docs = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(keep)], F.col(text).alias("text"))
    # The weights have a fixed size, about 2 MB.
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        scorer = Scorer(sent.value)
        for batch in batches:
            scores = [scorer.scores(texts) for texts, in rows_of(batch.select([len(keep)]))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(keep)], pa.array(np.concatenate(scores) if scores else [], pa.float64())],
                [*keep, "score"])

    return docs.mapInArrow(run, StructType([*fields, StructField("score", DoubleType())]))
