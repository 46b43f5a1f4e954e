"""Spelling groups, Zstandard archives and the conversation trie: SQL, brute force, faults and odd inputs."""

import hashlib
import io
import random
import re
import zlib
from collections import Counter

import duckdb
import pytest
import zstandard
from pyspark.sql import functions as F

import __spark_entry__ as entry
from eventide.llm import conv_trie, spelling, warc
from tools.oracle_check import TABLES, canon

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_spelling", "op12_warc", "op13_conv_trie"])
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = entry.queries()[name](spark, SF)
    res = con.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(cols, res.fetchall())


# ------------------------------------------------------------------ spelling
CLASHES = ["word", "n", "h", "run", "choice", "key", "length", "own", "near", "_id", "_m"]


def docs(spark, rows):
    schema = "doc_id long, text string, " + ", ".join(f"`{c}` int" for c in CLASHES)
    return spark.createDataFrame([(i, t, *range(len(CLASHES))) for i, t in rows], schema)


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_groups(rows):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] is not None else None))
    return out


def misspelt(seed, n=120):
    rng = random.Random(seed)
    letters = "abcdeéünÀ÷ß"
    base = ["".join(rng.choice(letters) for _ in range(rng.randrange(7, 13))) for _ in range(25)] + ["aaaaaaa", "banana" * 400]
    words = [w for k, w in enumerate(base) for _ in range(400 // (k + 1) ** 2 + 3)]
    for w in base:
        for _ in range(12):
            v = list(w)
            at = rng.randrange(len(v))
            v[at:at + rng.randrange(2)] = [rng.choice(letters)] if rng.random() < .7 else []
            words += ["".join(v)] * rng.choice([1, 2, 2, 3, 30])
    rng.shuffle(words)
    cut = [words[k::n] for k in range(n)]
    return [(k, " ".join(w.title() if rng.random() < .1 else w for w in ws)) for k, ws in enumerate(cut)]


def test_groups_equal_brute_force(spark):
    rows = misspelt(4) + [(None, "anagrams nagarams listens silents"), (5000, None), (5001, ""), (7, "anagrams listens 1 x"),
                          (7, "repeated repeated Repeated ÉCLAIRS éclairs ÉCLAIRS éclairs")]
    got = {tuple(r) for r in spelling.spelling_groups(docs(spark, rows)).select(
        "word", "form", "root", "n", "n_near", "form_n").collect()}
    assert got == brute_groups(rows)
    assert any(r[1] and r[2] != r[1] for r in got) and any(r[4] > 3 for r in got)


def test_split_blocks_lose_no_pair(spark):
    """Blocks of over three words are cut: the same pairs, each once."""
    words = spelling.words_of(docs(spark, misspelt(9)))
    whole = sorted(tuple(r) for r in spelling.near_words(words).collect())
    parts = sorted(tuple(r) for r in spelling.near_words(words, split=3).collect())
    assert whole == parts and len(whole) == len(set(whole)) > 100


def test_no_documents_no_words(spark):
    assert spelling.spelling_groups(docs(spark, [])).count() == 0
    assert spelling.spelling_groups(docs(spark, [(1, "short words only"), (2, None)])).count() == 0


# ------------------------------------------------------------------ archives
def archive(records):
    out = io.BytesIO()
    writer = warc.ArchiveWriter(out)
    for r in records:
        writer.add(r)
    writer.close()
    return out.getvalue()


def record(i, payload=b"<html>some page</html>", refers_to=None, url="http://h/"):
    return warc.page_record(i, url, payload, hashlib.sha256(payload).hexdigest(), refers_to, "2024-01-01T00:00:00Z")


def pages_of(data):
    return [warc.page_of(r) for r in warc.read_records(io.BytesIO(data))]


MANY = [f"<html><body>page {i} {'of the archive ' * (i % 50)}</body></html>".encode() * (1 + i % 7) for i in range(300)]


def test_archive_round_trip_and_random_access():
    data = archive([record(i, p) for i, p in enumerate(MANY)])
    assert data[:4] == bytes.fromhex("5d2a4d18")  # the dictionary leads
    assert [(p[0], p[1], p[2]) for p in pages_of(data)] == [
        (i, len(p), hashlib.sha256(p).hexdigest()) for i, p in enumerate(MANY)]
    # One frame a record: a record is decoded from its offset alone, given the dictionary.
    found = list(warc.read_records(io.BytesIO(data)))
    source = warc._Source(io.BytesIO(data))
    unpack = zstandard.ZstdDecompressor(dict_data=warc._dictionary(source))
    one = unpack.decompressobj().decompress(data[found[150].offset:])
    assert warc.page_of(warc.parse_record(0, one))[0] == 150


def test_archive_without_or_with_plain_dictionary():
    assert pages_of(archive([record(1), record(2, b"")])) == [
        (1, 22, hashlib.sha256(b"<html>some page</html>").hexdigest(), "response", None),
        (2, 0, hashlib.sha256(b"").hexdigest(), "response", None)]
    assert pages_of(b"") == []
    plain = warc.train_dictionary([record(i, p) for i, p in enumerate(MANY)])
    frame = zstandard.ZstdCompressor(dict_data=plain).compress(record(7, MANY[7]))
    raw = plain.as_bytes()
    head = (0x184D2A5D).to_bytes(4, "little") + len(raw).to_bytes(4, "little")
    assert pages_of(head + raw + frame)[0][0] == 7


@pytest.mark.parametrize("broken, says", [
    (lambda r: r.replace(b"WARC/1.1", b"WARC/9.9", 1), "begins with"),
    (lambda r: r.replace(b"WARC-Date", b"WARC-Dat", 1), "no WARC-Date"),
    (lambda r: r[:-6] + r[-4:], "bytes before the record's end"),
    (lambda r: r + b"more", "bytes before the record's end"),
    (lambda r: r + r, "bytes before the record's end"),
    (lambda r: r.replace(b"some page", b"sOme page", 1), "not the one of its header"),
    (lambda r: r.replace(b"WARC-Type: response", b"a line without a colon", 1), "without a name"),
    (lambda r: r.replace(b"<urn:page:1>", b"<urn:uuid:1>", 1), "WARC-Record-ID"),
])
def test_faulty_records_are_found(broken, says):
    data = zstandard.ZstdCompressor().compress(broken(record(1)))
    with pytest.raises(warc.WarcError, match=re.escape(says)):
        pages_of(data)


def test_cut_files_are_found():
    data = archive([record(i, p) for i, p in enumerate(MANY)])
    for end in (6, 100, len(data) - 3):
        with pytest.raises(warc.WarcError):
            pages_of(data[:end])


def pages(spark, rows):
    clash = ["payload", "digest", "first", "refers_to", "n", "path"]
    schema = "page_id long, url string, html string, " + ", ".join(f"`{c}` int" for c in clash)
    return spark.createDataFrame([(*r, *range(len(clash))) for r in rows], schema)


def test_pages_odd(spark):
    copy, other = "é" * 60, "x" * 100
    rows = [(5, "http://a b\r\nWARC-Type: x", copy), (3, None, copy), (9, "u", copy), (None, "u", copy), (1, "u", "x" * 99),
            (2, "u", "x" * 99), (4, "u", None), (6, "u", ""), (7, "u", other + "\r\n\r\nrest"), (8, "u", "y" * 3_000_000),
            (11, "u", other), (11, "u", other), (12, "u", other), (None, "u", "only nulls " * 20), (None, "u", "only nulls " * 20)]
    got = Counter(tuple(r) for r in warc.archived_pages(pages(spark, rows)).collect())
    want = Counter()
    for i, _, h in rows:
        body = (h or "").encode()
        known = [k for k, _, x in rows if x == h and k is not None]
        first = min(known, default=None) if len(body) >= 100 else None
        again = first is not None and (i is None or i > first)
        want[(i, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", first if again else None)] += 1
    assert got == want
    assert warc.archived_pages(pages(spark, [])).count() == 0


# ------------------------------------------------------------------ trie
def talks(spark, rows):
    clash = ["pos", "digest", "words", "k", "ts", "depth", "n", "owner", "leaf", "_b", "tie"]
    schema = "conv_id long, turn long, role string, text string, " + ", ".join(f"`{c}` int" for c in clash)
    return spark.createDataFrame([(*r, *range(len(clash))) for r in rows], schema)


def brute_trie(rows):
    own = {}
    for c, t, r, x in rows:
        if c is not None:
            own.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(own.get(c - c % 20, [])[:h] + own[c][h:])
    members = {}
    for c, path in built.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    saved = {p: (len(m) - 1) * len(re.findall("[^\x20\x09-\x0D]+", p[-1][1])) if p else 0 for p, m in members.items()}
    children = Counter(p[:-1] for p in members if p)
    out = Counter()
    for p, m in members.items():
        under = [q for q in members if q[:len(p)] == p]
        ends = ",".join(map(str, sorted(c for c in m if built[c] == p)))
        out[(min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], sum(not children[q] for q in under),
             sum(saved[q] for q in under), hashlib.sha256(ends.encode()).hexdigest())] += 1
    return out


def random_talks(seed, n=90, most=14):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        if c % 20 == 0 and c % 40:
            continue  # a family without its first conversation
        for t in range(rng.randrange(1, most)):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["a", "a a", "b c d"]) if t > 3 else "hello there"))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_equals_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(conv_trie, "STRETCH", 2)
    monkeypatch.setattr(conv_trie, "PIECE", 3)
    rows = random_talks(seed) + [(c, t, "user", f"copy {t}") for c in range(200, 230) for t in range(9)]
    rows += [(500, t, "user", f"long {t}") for t in range(60)] + [(501, 0, None, None), (501, None, "x", None), (502, 3, "r", "tie"),
             (502, 3, "a", "tie"), (502, 3, "a", "tie"), (None, 0, "user", "lost"), (520, 0, "user:", "a"), (540, 0, "user", ":a")]
    random.Random(seed).shuffle(rows)
    got = Counter(tuple(r) for r in conv_trie.conversation_trie(talks(spark, rows)).collect())
    assert got == brute_trie(rows)


def test_trie_of_nothing(spark):
    assert conv_trie.conversation_trie(talks(spark, [])).count() == 0
    # Every turn of one conversation is replaced by those of an absent family head: the root alone.
    c = next(c for c in range(21, 39) if zlib.crc32(str(c).encode()) % 4 >= 1)
    (root,) = conv_trie.conversation_trie(talks(spark, [(c, 0, "user", "gone")])).collect()
    assert (root.conv_id, root.depth, root.n_convs, root.n_children, root.n_leaves, root.saved_tokens) == (c, 0, 1, 0, 1, 0)
    assert root.ends_sha256 == hashlib.sha256(str(c).encode()).hexdigest()


def test_blocks_alone_are_not_refined(spark):
    """A thousand copies are one block a level before any turn is looked at."""
    turns = spark.range(1000).select(F.col("id").alias("conv_id"), F.explode(F.sequence(F.lit(1), F.lit(8))).alias("pos")).select(
        "conv_id", F.col("pos").cast("long").alias("pos"), F.md5(F.col("pos").cast("string")).alias("digest"), F.lit(1).cast(
            "long").alias("words"))
    blocks = conv_trie.blocks_of(turns)
    assert blocks.count() == 2000 and blocks.select(*conv_trie._KEY).distinct().count() == 2
    nodes = conv_trie.trie(turns, spark.range(1000).withColumnRenamed("id", "conv_id")).collect()
    assert sorted((r.depth, r.n_convs, r.saved_tokens) for r in nodes) == [(d, 1000, 999 * (9 - max(d, 1))) for d in range(9)]
