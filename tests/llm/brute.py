"""Plain Python answers to the operators' questions, for small tables."""

from __future__ import annotations

import base64
import math
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers

WORD = re.compile("[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def crc(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5


def tiktoken_encoding():
    import tiktoken
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def base_counts(text):
    t, w = text or "", words(text)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    at = defaultdict(list)
    for i in range(len(w) - 7):
        at[tuple(w[i:i + 8])].append(i)
    covered = {j for places in at.values() if len(places) > 1 for i in places for j in range(i, i + 8)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))


def kept_by_lines(rows, max_docs, max_removed):
    """rows: (doc_id, host, text). doc_id -> kept, by the frequency of normalised lines within a host."""
    found, own = defaultdict(set), defaultdict(list)
    for i, host, text in rows:
        for line in (text or "").split("\n"):
            if WORD.search(line):
                key = (host, re.sub("[0-9]", "0", line.lower()).strip(" \t\x0b\x0c\r"))
                found[key].add(i)
                own[i].append((key, len(words(line))))
    out = {}
    for i, _, text in rows:
        n, _, _, _, rep = base_counts(text)
        lost = sum(k for key, k in own[i] if len(found[key]) > max_docs)
        out[i] = n >= 20 and 100 * rep <= 30 * n and lost <= max_removed * n
    return out


def shingles(text):
    w = words(text)
    n = min(5, len(w))
    return {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if n else set()


def near(rows):
    """rows: (doc_id, text) with distinct ids -> doc_id: (class, number of links)."""
    sets = {i: shingles(t) for i, t in rows}
    holders = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    shared = Counter()
    for ids in holders.values():
        for a in range(len(ids)):
            for b in ids[:a]:
                shared[min(ids[a], b), max(ids[a], b)] += 1
    head = {i: i for i in sets}
    links = Counter()

    def find(x):
        while head[x] != x:
            x = head[x]
        return x
    for (a, b), n in shared.items():
        if 5 * n >= 4 * (len(sets[a]) + len(sets[b]) - n):
            links[a] += 1
            links[b] += 1
            x, y = sorted((find(a), find(b)))
            head[y] = x
    return {i: (find(i), links[i]) for i in sets}


def one_edit(a, b):
    """At most one word inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    p = 0
    while p < len(a) and a[p] == b[p]:
        p += 1
    return a[p + (len(a) == len(b)):] == b[p + 1:]


def removed_lines(rows, min_words=5):
    """rows: (doc_id, text) with distinct ids -> {(doc_id, line number)} of lines that repeat or nearly repeat an earlier one."""
    lines = [((i, no), words(line)) for i, text in sorted(rows) for no, line in enumerate((text or "").split("\n"))]
    lines = [(at, w) for at, w in lines if len(w) >= min_words]
    return {at for k, (at, w) in enumerate(lines) if any(one_edit(v, w) for _, v in lines[:k])}


def dedup_text(i, text, gone):
    if not any(d == i for d, _ in gone):
        return text
    return "\n".join(x for no, x in enumerate(text.split("\n")) if (i, no) not in gone)


def mix(rows):
    """rows: (doc_id, source, text) -> {source: (size, target)} and doc_id: words taken, by documents in md5 order."""
    import hashlib
    size = {i: len(words(t)) for i, _, t in rows}
    total = Counter()
    for i, s, _ in rows:
        total[s] += size[i]
    order = sorted(total, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    target, open_, left = {}, set(order), 1.5 * sum(total.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if 2 * total[s] <= level * weight[s]}
        if not full:
            target |= {s: level * weight[s] for s in open_}
            break
        for s in full:
            target[s] = 2.0 * total[s]
            left -= target[s]
        open_ -= full
    taken = {}
    for s in order:
        n, at = total[s], 0
        whole = math.floor(target[s] / n) if n else 0
        for i in sorted((i for i, x, _ in rows if x == s), key=lambda i: hashlib.md5(str(i).encode()).hexdigest()):
            part = size[i] and 2 * at + size[i] <= 2 * (target[s] - whole * n) + 1e-6 and whole < 2
            taken[i] = size[i] * (whole + bool(part))
            at += size[i]
    return {s: (total[s], target[s]) for s in order}, taken


def url_parts(url):
    url = url or ""
    if "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):], re.S).group()
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def url_rule(host, path):
    rules = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/"))
    fit = [(len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[1:] if fit else (None, None)


def top10(rows):
    """rows: (vec_id, list) -> {(query, rank): (vec_id, score)}."""
    ok = {i: [math.floor(1024 * float(x)) for x in v] for i, v in rows
          if v and all(x is not None and math.isfinite(x) for x in v)}
    out = {}
    for q, v in ok.items():
        if q % 100 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in ok.items() if i != q)
            for rank, (s, i) in enumerate(scored[:10], 1):
                out[q, rank] = (i, -s)
    return out


def base_scores(rows):
    """rows: (doc_id, text) -> N and doc_id: (held_out, tokens, known, base score)."""
    tokens = {i: [w.encode().lower() for w in words(t)] + [b"\n"] for i, t in rows}
    c = Counter(w for i, ws in tokens.items() if crc(i) != 1 for w in ws)
    n, v = sum(c.values()), len(c)
    return n, {i: (crc(i) == 1, len(ws), sum(c[w] > 0 for w in ws),
                   sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)) for i, ws in tokens.items()}
