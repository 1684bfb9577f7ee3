"""Scores and draws against a plain version."""

import hashlib
import math
import re
import zlib
from collections import Counter

from edgeframe.llm import importance as imp


def grams(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    return len(w), w + [" ".join(p) for p in zip(w, w[1:])]


def brute(docs, target, buckets=10000, share=25, least=20):
    at = lambda g: zlib.crc32(g.encode()) % buckets
    made = [(i, *grams(t)) for i, t in docs]
    s = Counter(at(g) for _, _, gs in made for g in gs)
    t = Counter(at(g) for x in target for g in grams(x)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets))))
    rows = []
    for i, n, gs in made:
        w = sum(gain(at(g)) for g in gs) // len(gs) if gs else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(gs), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    able = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[:share * len(able) // 100], 1):
        r[4] = k
    return sorted((tuple(r[:5]) for r in rows), key=str)


def test_like_the_plain_version(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    target = spark.read.parquet(f"{sf}/benchmark.parquet")
    got = sorted((tuple(r) for r in imp.resampled(docs, target).collect()), key=str)
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()])
    assert imp.draw(docs, target).count() == sum(r[4] is not None for r in got)


def test_odd_rows(spark):
    long = "Tie " * 50
    rows = [(1, None), (2, ""), (3, "!!! ,"), (None, "Word " * 30), (None, "Word " * 30), (4, "x"), (5, "日本 é-É " * 12),
            (6, "a b " * 100000), (7, "\x00A\x7fb\x80c " * 9)] + [(k, long) for k in (8, 8, 8, 9, 10, 11, 12, 13)]
    docs = spark.createDataFrame([(*r, 1, 2, "g") for r in rows], "doc_id long, text string, row int, rank int, grams string")
    target = spark.createDataFrame([("word tie", 1), (None, 2)], "text string, doc_id int")
    got = sorted((tuple(r) for r in imp.resampled(docs, target).collect()), key=str)
    assert got == brute(rows, ["word tie", None])
    none = imp.resampled(docs.limit(0), target)
    assert none.count() == 0 and none.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted((tuple(r) for r in imp.resampled(docs, target.limit(0)).collect()), key=str) == brute(rows, [])


def test_spans_are_the_ngrams():
    flat = imp.collapsed("One, two;  three--FOUR".encode())
    assert [m[0] for m in imp.scanner(1).finditer(flat, overlapped=True)] == [b"one", b"two", b"three", b"four"]
    assert [m[0] for m in imp.scanner(3).finditer(flat, overlapped=True)] == [b"one two three", b"two three four"]
    assert not list(imp.scanner(1).finditer(imp.collapsed(b""), overlapped=True))
