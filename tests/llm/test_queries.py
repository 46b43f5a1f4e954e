"""Registered queries over whole tables, against DuckDB, brute force, or the libraries."""

import hashlib
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
from tests.llm import brute
from tools.oracle_check import TABLES, canon

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.fixture(scope="module")
def docs(con):
    return con.execute("select doc_id, source, text from documents").fetchall()


def rows(spark, name, sf=SF):
    return entry.queries()[name](spark, sf).collect()


@pytest.mark.parametrize("name", ["op1_quality_rules", "op5_line_dedup", "op6_source_mixing", "op8_va_topk"])
def test_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    res = con.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(cols, res.fetchall())


def test_bpe(spark, docs):
    enc = brute.tiktoken_encoding()
    got = {r.doc_id: r for r in rows(spark, "op2_bpe")}
    assert len(got) == len(docs)
    for i, _, t in docs:
        ids = enc.encode_ordinary(t or "")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_near_classes(spark, docs):
    want = brute.near([(i, t) for i, _, t in docs])
    assert {r.doc_id: (r.class_id, r.n_links) for r in rows(spark, "op3_ngram_jaccard")} == want


def test_toxicity_held_out(spark, con):
    """About a seventh of the documents labelled toxic here hold none of the words that mark the others."""
    sf = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in rows(spark, "op4_toxicity", sf)}
    labels = con.execute(f"select doc_id, toxic from '{sf}/labels.parquet'").fetchall()
    assert len(got) == 10000 and all(r.held_out == (brute.crc(i) == 0) for i, r in got.items())
    out = [(y, got[i].predicted) for i, y in labels if got[i].held_out]
    right = np.mean([y == p for y, p in out])
    found = np.mean([p for y, p in out if y])
    clean = np.mean([p for y, p in out if not y])
    assert right > 0.96 and found > 0.75 and clean < 0.02


def test_mixing(spark, docs):
    sources, taken = brute.mix(docs)
    got = rows(spark, "op6_source_mixing")
    assert {r.doc_id: r.taken for r in got} == taken
    source = {i: s for i, s, _ in docs}
    for r in got:
        n, target = sources[source[r.doc_id]]
        assert r.source_size == n and abs(r.target - target) < 1e-6 * target and r.taken <= 2 * r.size


def test_url_rules(spark, con):
    got = {r.page_id: r for r in rows(spark, "op7_url_filter")}
    for i, url in con.execute("select page_id, url from pages").fetchall():
        host, path = brute.url_parts(url)
        rule, verdict = brute.url_rule(host, path)
        r = got[i]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")


def test_lm(spark, docs):
    n, want = brute.base_scores([(i, t) for i, _, t in docs])
    got = {r.doc_id: r for r in rows(spark, "op9_lm_score")}
    assert len(got) == len(want)
    for i, (held, size, known, base) in want.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, size, known, n)
        assert abs(r.base_score - base) < 1e-9 * abs(base) + 1e-9 and r.score < 0
    # Under three bits a byte on texts it has not learned from: far below the eight of no model.
    out = [(r.score, len((t or "").encode())) for i, _, t in docs if (r := got[i]).held_out]
    assert -sum(s for s, _ in out) / np.log10(2) / sum(b for _, b in out) < 3


def test_token_files(spark, docs):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {r.doc_id: r for r in rows(spark, "op10_token_files")}
    at = 0
    for i, _, t in sorted(docs):
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_pipeline(spark, docs, con):
    """Stage by stage: the first by the scorer itself, the others by brute force."""
    import corpus_pipeline
    from eventide.llm import toxicity

    own = spark.read.parquet(f"{SF}/documents.parquet")
    weights = toxicity.fit(own, spark.read.parquet(f"{SF}/labels.parquet"))
    scores = toxicity.Scorer(weights).scores([t for _, _, t in docs])
    left = [d for d, s in zip(docs, scores, strict=True) if s < 0.5]
    gone = brute.removed_lines([(i, t) for i, _, t in left])
    left = [(i, s, brute.dedup_text(i, t, gone)) for i, s, t in left]
    classes = brute.near([(i, t) for i, _, t in left])
    left = [d for d in left if classes[d[0]][0] == d[0]]
    _, taken = brute.mix(left)
    enc = brute.tiktoken_encoding()
    want = sorted((i, enc.encode_ordinary(t or "")) for i, _, t in left
                  for _ in range(taken[i] // max(1, len(brute.words(t)))))
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r.doc_id, list(r.ids)) for r in got) == want
    assert all(r.n_tokens == len(r.ids) for r in got)
