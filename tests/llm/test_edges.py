"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns; and the operators' inner parts."""

import io
import os
import random
import tempfile
import time

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from eventide.llm import (bpe, chosen_path, line_dedup, lm_score, mixing, quality, token_files, toxicity, url_filter,
                          va_topk)
from eventide.session import materialize, materialize_alone
from tests.llm import brute

RANKS, JSON = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")
LONG = " ".join(f"w{i % 977}" for i in range(30000)) + "\n" + "x" * 3000
LINE = "one two three four five six seven"
#: Every other column that the operators use inside, as an extra column of the input.
CLASH = ["host", "line", "n", "key", "size", "bucket", "position", "positions", "row", "_id", "_gone", "_doc", "block",
         "set_id", "score", "word", "chunk", "ids", "start", "no", "_text", "first", "label"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` int" for c in CLASH)


def frame(spark, rows):
    """(doc_id, source, text) rows with all the clashing columns."""
    return spark.createDataFrame([(i, t, None, s, None if t is None else len(t), *range(len(CLASH))) for i, s, t in rows],
                                 SCHEMA)


ODD = [(1, "a", None), (2, None, ""), (3, "a", LONG), (4, "b", LINE), (5, "b", LINE), (6, "a", LINE + " eight"),
       (6, "a", LINE + " eight"), (7, "c", " \t\n \r\n"), (8, "c", "Ünï çode 日本 \u00a0 nb\u2003sp  two"), (9, None, "a"),
       (None, "a", "no id here at all, six words")]


@pytest.fixture(scope="module")
def odd(spark):
    return frame(spark, ODD).cache()


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


def test_quality_odd(odd, none):
    got = quality.quality_rules(odd, host="source").collect()
    assert len(got) == len(ODD)
    want = {i: brute.base_counts(t) for i, _, t in ODD}
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want[r.doc_id]
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
    assert quality.quality_rules(none, host="source").count() == 0
    assert quality.remove_frequent_lines(odd, host="source").columns == odd.columns


def test_quality_frequent_lines(spark):
    rows = [(i, "hot" if i < 60 else "cold", f"All rights reserved {i % 10}\n" + " ".join(f"u{i}x{k}" for k in range(30)))
            for i in range(70)]
    rows += [(100 + i, "hot", "The same opening line for a great many of the pages here\nown words "
              + " ".join(f"v{i}y{k}" for k in range(9 if i % 2 else 20))) for i in range(40)]
    got = {r.doc_id: r for r in quality.quality_rules(frame(spark, rows), host="source").collect()}
    assert {i: r.kept for i, r in got.items()} == brute.kept_by_lines([(i, s, t) for i, s, t in rows], 30, 0.5)
    assert not all(r.kept for r in got.values()) and got[0].kept and got[65].n_removed == 0
    cut = {r.doc_id: r.text for r in quality.remove_frequent_lines(frame(spark, rows), host="source").collect()}
    assert cut[0].startswith("u0x0") and cut[65].startswith("All rights") and cut[101].startswith("own words")


def test_bpe_odd(odd, none):
    enc = brute.tiktoken_encoding()
    got = bpe.encode_texts(odd, RANKS, public_tokenizers.PATTERN).collect()
    key = lambda r: (r[0] is None, r[0], r[1])
    assert sorted(((r.doc_id, list(r.ids)) for r in got), key=key) == sorted(
        ((i, enc.encode_ordinary(t or "")) for i, _, t in ODD), key=key)
    assert bpe.encoding_digests(none, RANKS, public_tokenizers.PATTERN).count() == 0


def test_prefix_tables():
    """Appends extend a table, edits recompute near the edit; both equal a table from nothing, and the merges."""
    v, rng = bpe.text_encoder(RANKS, public_tokenizers.PATTERN).vocabulary, random.Random(3)
    data = b"internationalization of thoroughly unremarkable things " * 6
    last = v.table(data)
    assert v.read_back(last) == v.merged(data) and v.table(data, last[:100]) == last
    for _ in range(60):
        a = rng.randint(0, len(data))
        b, new = rng.randint(a, min(len(data), a + 8)), bytes(rng.choice(b"abcthe ") for _ in range(rng.randint(0, 6)))
        changed, table = v.edit(data, last, a, b, new)
        assert changed == data[:a] + new + data[b:] and table == v.table(changed)
        assert v.read_back(table) == v.merged(changed)


def test_texts_with_any_spacing():
    enc, e, rng = brute.tiktoken_encoding(), bpe.text_encoder(RANKS, public_tokenizers.PATTERN), random.Random(5)
    lib = token_files.library_encoder(JSON)
    parts = [" ", "  ", "\n", "'s", "a", "the", "é", "日", "12", "!", "\t", " \n", "<|endoftext|>", "\u00a0", "'"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(1500)]
    for t in texts:
        assert e.encode(t) == enc.encode_ordinary(t)
        assert e.decode(e.encode(t)) == t.encode()
    want = [x.ids for x in lib.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in lib.encode(texts)] == want


def test_near_odd(spark, odd, none):
    got = {(r.doc_id, r.text_key): r for r in chosen_path.near_classes(odd).collect()}
    by = {}
    for (i, _), r in got.items():
        by.setdefault(i, r)
    assert by[4].class_id == by[5].class_id == 4 and by[4].n_links >= 1
    assert by[6].n_copies == 2 and by[1].class_id == 1 and by[2].class_id == 2 and by[7].n_links == 0
    kept = chosen_path.one_of_each(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == [
        1, 2, 3, 4, 7, 8, 9] if by[6].class_id == 4 else kept.count() > 0
    assert chosen_path.near_classes(none).count() == 0 and chosen_path.one_of_each(none).count() == 0


def test_near_groups(spark):
    """A large class of near copies, exact copies, and a passage that unrelated texts share."""
    rng = random.Random(9)
    base = [f"b{k}" for k in range(120)]
    rows = []
    for i in range(300):
        w = list(base)
        w[rng.randrange(120)] = f"e{i}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, " ".join(base)) for i in range(200)]
    passage = " ".join(f"p{k}" for k in range(60))
    rows += [(2000 + i, passage + " " + " ".join(f"q{i}z{k}" for k in range(100))) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    want = brute.near(rows)
    got = {r.doc_id: (r.class_id, r.n_links) for r in chosen_path.near_classes(df).collect()}
    assert got == want and len({c for c, _ in got.values()}) == 301


def test_near_recall(spark):
    """Pairs at 0.8 whose buckets hold over LEAF sets at levels 1 and 2 without being alike meet in a leaf."""
    rng = np.random.default_rng(8)
    n, values = 2000, 5
    left = rng.integers(0, values, (n, chosen_path.SKETCH)).astype(np.uint32)
    right = np.where(rng.random(left.shape) < chosen_path.SIMILAR, left, (left + rng.integers(1, values, left.shape)) % values)
    sets = [(bytes([side]) + i.to_bytes(4, "big"), 100, row.astype(np.uint32).tobytes())
            for side, rows in enumerate((left, right)) for i, row in enumerate(rows)]
    df = spark.createDataFrame(sets, "set_id binary, n long, sketch binary")
    met = chosen_path.leaves_of(df).select("bucket", F.substring("set_id", 2, 4).alias("pair"), "set_id").distinct()
    met = met.groupBy("pair", "bucket").count().where("count = 2")
    met = met.groupBy("pair").count().count()
    assert met >= 0.985 * n
    assert chosen_path.missed(chosen_path.RUNS) <= 1 - chosen_path.RECALL


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(200 + i, 100) for i in range(50)] + [(300, 301)]
    got = chosen_path.components(spark.createDataFrame(edges, "a long, b long")).collect()
    root = {r.node: r.root for r in got}
    assert all(root[i] == 0 for i in range(1, 61)) and all(root[200 + i] == 100 for i in range(50)) and root[301] == 300


def test_toxicity_odd(spark, odd, none):
    labels = spark.createDataFrame([(i, 1, i % 3 == 0 and 1 or 0) for i in range(40)] + [(3, 0, None)],
                                   "doc_id long, quality int, toxic int")
    train = frame(spark, [(i, "s", f"plain words of {'gorblex ' * (i % 3 == 0)} text {i}") for i in range(40)])
    weights = toxicity.fit(train, labels, updates=60)
    scored = toxicity.score_texts(odd, weights)
    got = scored.collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert sorted(scored.columns) == sorted(odd.columns)
    assert all(r.score < 0.5 for r in got if not (r.text or "").strip())
    assert toxicity.score_texts(none, weights).count() == 0
    bare = toxicity.fit(train, labels.where("false"))
    assert {r.score for r in toxicity.score_texts(odd, bare).collect()} == {0.000001}


def test_toxicity_long(spark):
    """One toxic passage counts however much clean text surrounds it, and labels of long texts are learned."""
    rng = random.Random(5)
    clean = lambda n: [f"plain{rng.randrange(300)}" for _ in range(n)]
    for n in (10, 400, 5000):
        assert toxicity.pool(np.array([-3.0] * n + [3.0]), np.zeros(n + 1, int), 1, 0.0)[0][0] == 3

    def hidden(n):
        w = clean(n)
        w[n // 3:n // 3 + 30] = ["gorblex", "snarfing"] * 15
        return " ".join(w)

    texts = [hidden(200) if i % 3 == 0 else " ".join(clean(200)) for i in range(60)]
    scorer = toxicity.Scorer(toxicity.train(texts, [int(i % 3 == 0) for i in range(60)], 150))
    for n in (1000, 10000, 100000):
        toxic, plain = scorer.scores([hidden(n), " ".join(clean(n))])
        assert toxic > 0.5 > plain
    assert "gorblex" in scorer.highest(hidden(20000)) and len(scorer.highest(hidden(20000)).split()) <= toxicity.TRAIN_WORDS
    # Every labelled text is longer than TRAIN_WORDS.
    rows = [(i, "s", " ".join((clean(2300) if i % 3 else ["gorblex", "snarfing"] * 1150))) for i in range(60)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)], "doc_id long, toxic int")
    learned = toxicity.Scorer(toxicity.fit(frame(spark, rows), labels, updates=60))
    toxic = " ".join(clean(1500) + ["gorblex", "snarfing"] * 50 + clean(1500))
    assert learned.scores([toxic])[0] > 0.5 > learned.scores([" ".join(clean(3000))])[0]


def test_toxicity_gradients():
    """Backward passes agree with differences of the loss."""
    rng = np.random.default_rng(2)
    w = {k: v.astype(np.float64) for k, v in toxicity.initial().items()}
    net = toxicity.Network(w)
    given = rng.normal(size=(5, toxicity.WINDOW, 2, 3 * toxicity.HIDDEN))
    there = np.arange(toxicity.WINDOW) < np.array([48, 3, 17, 1, 30])[:, None]
    push = rng.normal(size=5)
    _, kept = net.forward(given, there, keep=True)
    g, d_given = net.backward(push, kept)
    for name in ("turn", "look", "seek", "out"):
        at = tuple(rng.integers(0, n) for n in w[name].shape)
        old, step = w[name][at], 1e-3
        w[name][at] = old + step
        up = net.forward(given, there) @ push
        w[name][at] = old - step
        down = net.forward(given, there) @ push
        w[name][at] = old
        assert abs((up - down) / (2 * step) - g[name][at]) < 2e-3 * max(1, abs(g[name][at]))
    at, step = (0, 5, 1, 4), 1e-3
    given[at] += step
    up = net.forward(given, there) @ push
    given[at] -= 2 * step
    down = net.forward(given, there) @ push
    assert abs((up - down) / (2 * step) - d_given[at]) < 2e-3


def test_line_dedup_odd(spark, odd, none):
    got = line_dedup.dedup_lines(odd)
    assert got.columns == odd.columns and got.count() == len(ODD)
    text = {r.doc_id: r.text for r in got.collect()}
    assert text[1] is None and text[2] == "" and text[4] == LINE and text[5] == "" and text[6] == ""
    assert text[7] == " \t\n \r\n" and text[3] == LONG
    assert line_dedup.dedup_lines(none).count() == 0


def test_line_dedup_random(spark):
    rng = random.Random(4)
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rng.randint(1, 6)):
            w = [rng.choice("abc") for _ in range(rng.randint(3, 8))]
            lines.append(" ".join(w) if rng.random() < 0.8 else "\t".join(w) + " ")
        rows.append((i, "\n".join(lines)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    gone = brute.removed_lines(rows)
    assert {(r.doc_id, r.no) for r in line_dedup.removed_lines(df).collect()} == gone
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(df).collect()}
    assert got == {i: brute.dedup_text(i, t, gone) for i, t in rows}


def test_mixing_odd(spark, odd, none):
    plan = mixing.mix_plan(odd).collect()
    assert len(plan) == len(ODD)
    for r in plan:
        assert len(r.positions) == r.passes <= 2 and all(0 <= p <= 1 for p in r.positions)
        assert r.passes == 0 if r.size == 0 else True
    out = mixing.mixed(odd)
    assert out.columns == odd.columns and out.count() == sum(r.passes for r in plan)
    assert mixing.mix_plan(none).count() == 0 and mixing.mixed(none).count() == 0


def test_mixing_curriculum(spark):
    """Positions integrate to the schedule, targets are met, and the order is by position."""
    rows = [(i, "abc"[i % 3], " ".join(["w"] * (1 + i % 17))) for i in range(3000)]
    df = frame(spark, rows)
    plan = mixing.mix_plan(df).collect()
    sources, taken = brute.mix(rows)
    assert {r.doc_id: r.size * r.passes for r in plan} == taken
    for k, slope in enumerate(mixing.SLOPES):
        mine = [(p, r.size) for r in plan if r.source == "abc"[k] for p in r.positions]
        total = sum(n for _, n in mine)
        assert abs(total - sources["abc"[k]][1]) < 20
        for t in (0.25, 0.5, 0.75):
            share = sum(n for p, n in mine if p <= t) / total
            assert abs(share - (t + slope * (t * t - t))) < 0.01
    again = mixing.mix_plan(df.repartition(13)).collect()
    assert {(r.doc_id, tuple(r.positions)) for r in plan} == {(r.doc_id, tuple(r.positions)) for r in again}


URLS = [None, "", "no scheme", "http://", "HTTP://EXAMPLE.com/en/x?y#z", "https://www.example.com/en/1", "ftp://a.net/es/",
        "x://net/fr", "x://net/fr/", "s://ÄB.example.COM", "http://h?q/en/", "http://" + "a" * 5000 + "/" + "b/" * 5000,
        "http://sub.www.example.com/en/2", "http://notexample.com/en/3", "a://b://c.com/d"]


def test_urls_odd(spark):
    rows = [(i, u, 0, 0) for i, u in enumerate(URLS)] * 2
    df = spark.createDataFrame(rows, "page_id long, url string, grams int, weight int")
    got = url_filter.filter_urls(df).collect()
    assert len(got) == len(rows)
    for r in got:
        host, path = brute.url_parts(r.url)
        rule, verdict = brute.url_rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict == (verdict or r.verdict)
        assert r.verdict in ("allow", "block")
    assert url_filter.filter_urls(df.where("false")).count() == 0


def test_urls_learn(spark):
    rng = random.Random(1)
    name = lambda: "".join(rng.choice("aeioubcdr") for _ in range(6))
    rows = [(f"http://{name()}.org/{'casino-bonus' if k % 2 else 'library'}/{name()}", k % 2) for k in range(400)]
    df = spark.createDataFrame(rows, "url string, label int")
    got = url_filter.filter_urls(df, df.limit(300), rules=()).collect()
    assert np.mean([(r.verdict == "block") == (r.label == 1) for r in got]) > 0.98


def test_vectors_odd(spark):
    rng = random.Random(6)
    rows = [(i, [rng.uniform(-2, 2) for _ in range(8)]) for i in range(450)]
    rows += [(700, None), (800, []), (900, [1.0, None] + [0.0] * 6), (1000, [float("nan")] * 8),
             (1100, [float("inf")] * 8)]
    rows += [(2000 + i, [0.5] * 8) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1))
    v = va_topk.integer_vectors(df)
    want = brute.top10([(r.vec_id, r.embedding) for r in df.collect()])
    for block_rows in (8192, 64):
        got = va_topk.top_k(v, v.where("id % 100 = 0"), block_rows=block_rows).collect()
        assert {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in got} == want
    few = va_topk.top_k(v.where("id < 4"), v.where("id = 0"))
    assert few.count() == 3 and va_topk.top_k(v.where("false"), v.where("false")).count() == 0
    assert va_topk.top_k(v, v.where("false")).count() == 0


def test_lm_odd(odd, none):
    got = lm_score.score_documents(odd).collect()
    assert len(got) == len(ODD) and all(r.score < 0 and r.base_score < 0 for r in got)
    assert sorted(r.n_tokens for r in got) == sorted(len(brute.words(t)) + 1 for _, _, t in ODD)
    assert lm_score.score_documents(none).count() == 0
    only_held = odd.where(F.col("doc_id").isin([i for i in range(1, 10) if brute.crc(i) == 1]))
    assert all(r.train_tokens == 0 and r.n_known == 0 for r in lm_score.score_documents(only_held).collect())


def test_lm_is_a_distribution():
    """The probabilities of all next bytes after a prefix sum to one."""
    table = np.random.default_rng(1).integers(0, 50, (2, lm_score.ORDERS << lm_score.SLOT_BITS)).astype(np.float32)
    mixer = lm_score.Mixer(table)
    every = np.arange(256)
    before = [np.full(256, ord(c)) for c in "tha"]
    e = lm_score.Events(every, before, np.full(256, 3), np.ones(256), np.zeros((256, 8)), np.zeros((256, 8)))
    assert abs((10 ** mixer.costs(e)).sum() - 1) < 1e-9


def test_lm_reads_texts_in_order(spark):
    """The word before changes a word's score; bits a byte."""
    pair = ["alpha beta", "gamma delta"]
    rows = [(i, " ".join(pair[(i + k) % 2] for k in range(6))) for i in range(200) if brute.crc(i) != 1]
    out = [i for i in range(400) if brute.crc(i) == 1][:4]
    rows += list(zip(out, ["alpha beta gamma delta", "alpha delta gamma beta", "delta gamma beta alpha", ""], strict=True))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in lm_score.score_documents(df).collect()}
    good, crossed, back, empty = (got[i] for i in out)
    assert len({good.base_score, crossed.base_score, back.base_score}) == 1
    assert good.score > crossed.score + 1 and good.score > back.score + 1 and good.score > good.base_score
    assert abs(good.bits_per_byte + good.score / np.log10(2) / len("alpha beta gamma delta")) < 1e-9
    assert empty.bits_per_byte is None and empty.n_tokens == 1


def test_lm_tokens():
    """Words and ends in bytes, of texts with nulls, other spaces and characters, also from the middle of a batch."""
    texts = ["skipped", None, "", " \t", "Ab\nC\x1cD\u00a0E\u0130 f", "\x00 x\x0b\x0c\r\u2003Y", "z"]
    text, begins, sizes = lm_score.tokens(pa.array(texts)[1:])
    got = [bytes(x) for x in np.split(text, begins[1:])]
    assert got == [w for t in texts[1:] for w in [*(t or "").encode().lower().split(), b"\n"]]
    assert list(sizes) == [len((t or "").encode()) for t in texts[1:]]


def test_shuffle_files_go(spark):
    """What a table was shuffled through is gone soon after it is written."""
    def shuffled() -> set[str]:
        top = os.environ.get("SPARK_LOCAL_DIRS") or spark.sparkContext.getConf().get("spark.local.dir", tempfile.gettempdir())
        return {f for d in os.listdir(top) if d.startswith("blockmgr-") for _, _, names in os.walk(os.path.join(top, d))
                for f in names if f.startswith("shuffle_") and f.endswith(".data")}

    kept = shuffled()
    df = spark.range(1000).withColumn("x", F.col("id") % 7).repartition("x").sortWithinPartitions("x")
    assert materialize(df).count() == 1000 and shuffled() - kept
    kept = shuffled()
    out = materialize_alone(df)
    ended = time.time() + 20
    while shuffled() - kept and time.time() < ended:
        time.sleep(0.1)
    assert not shuffled() - kept and sorted(r.id for r in out.collect()) == list(range(1000))


def test_pairs_merge():
    """Merged pieces of a part hold each (previous word, head) once, with all its counts."""
    rng, every = np.random.default_rng(3), {}
    batches = []
    for k in range(6):
        before = np.unique(rng.integers(1, 50, 20).astype(np.uint64))
        size = rng.integers(1, 4, len(before))
        heads = np.concatenate([np.sort(rng.choice(9, n, replace=False)) for n in size]) + (ord(" ") << 24)
        counts = rng.integers(0, 5, len(heads))
        for b, h, c in zip(np.repeat(before, size), heads, counts, strict=True):
            every[k // 3, int(b), int(h)] = every.get((k // 3, int(b), int(h)), 0) + int(c)
        batches.append(pa.RecordBatch.from_pydict({"number": [k // 3], "data": [lm_score.pack_pairs(
            before, before.astype(np.uint32), size, heads, counts)]}))
    found = {}
    for batch in lm_score.merge_pairs(iter(batches)):
        for row in batch.to_pylist():
            p = lm_score.Pairs(row)
            for o, h, c in zip(p.owner, p.head, p.counts, strict=True):
                assert (key := (row["part"], int(p.before[o]), int(h))) not in found and p.ending[o] == p.before[o]
                found[key] = int(c)
    assert found == every


def test_bags():
    numbers = np.array([5] * 700 + [1 << 20, 7, 7, 0])
    found, times = lm_score.unpack_bag(lm_score.pack_bag(numbers))
    assert {int(k): int(times[found == k].sum()) for k in set(found)} == {5: 700, 1 << 20: 1, 7: 2, 0: 1}


def test_token_files_odd(spark, odd, none):
    got = token_files.token_files(spark, odd, JSON, 50257, 2).collect()
    assert len(got) == len(ODD)
    got.sort(key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None] + sorted(i for i, _, _ in ODD if i is not None)
    assert all(b.start == a.start + a.n_tokens for a, b in zip(got, got[1:], strict=False)) and got[0].start == 0
    assert token_files.token_files(spark, none, JSON, 50257, 2).count() == 0


@pytest.mark.parametrize("vocabulary", [2, 50257, 65537, 1 << 31])
def test_packing(vocabulary):
    bits, rng = token_files.bits_for(vocabulary), np.random.default_rng(vocabulary)
    ids = rng.integers(0, vocabulary, 10007).astype(np.uint32)
    starts = np.array([0, 0, 5, 9000, 10007])
    data = token_files.file_bytes([4, 5, 6, 7], starts, ids, bits)
    f = token_files.TokenFile(io.BytesIO(data))
    assert f.n_ids == len(ids) and (f.ids(0, len(ids)) == ids).all()
    for a, b in ((0, 1), (4095, 4097), (8191, 10007), (17, 17), (10006, 10007)):
        assert (f.ids(a, b) == ids[a:b]).all()
    assert (f.document(2) == ids[5:9000]).all() and len(f.document(0)) == 0
    assert len(data) - f.payload == -(-4096 * bits // 8) * 2 + -(-(10007 - 8192) * bits // 8)


@pytest.mark.parametrize("name", ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def test_neighbours_stay_as_merging_says(name):
    """Going back through the merges at a border against merging the bytes; and one-pass tables against byte by byte ones."""
    words = bpe.text_encoder(public_tokenizers.path(name), public_tokenizers.PATTERN).vocabulary
    rng, ids = random.Random(1), sorted(words.token)
    short = [i for i in ids if len(words.token[i]) < 4]
    for k in range(6000):
        a, b = (rng.choice(ids if k % 2 else short) for _ in "ab")
        data = words.token[rng.choice(ids)]
        cut = rng.randrange(len(data))
        if k % 3 == 0 and {data[:cut], data[cut:]} <= words.ranks.keys():
            a, b = words.ranks[data[:cut]], words.ranks[data[cut:]]
        b = a if k % 7 == 0 else b
        both = words.token[a] + words.token[b]
        assert words._stays(a, b) == (words.merged(both) == [a, b])
        if k % 20 == 0:
            assert words.table(both) == words.table(both, words.table(both[:1]))


def test_line_dedup_cuts_a_text_once(spark):
    """A long text of which every line has a near one: its lines' words are found together, not by cutting the text for each."""
    lines = [f"line {k} of a long text with {k} words" for k in range(25_000)]
    df = spark.createDataFrame([(1, "\n".join(lines)), (2, "\n".join(x + " more" for x in lines))], "doc_id long, text string")
    begin = time.time()
    gone = line_dedup.removed_lines(df).groupBy("doc_id").count().collect()
    assert [tuple(r) for r in gone] == [(2, 25_000)]
    assert time.time() - begin < 60
