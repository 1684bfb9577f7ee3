"""Consistent weighted sampling near duplicates against brute force."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa

from edgeframe.llm import near_dup
from edgeframe.operators import common


def brute(rows, idf, threshold):
    """Classes by exact weighted similarity of all pairs of different texts."""
    texts = sorted({t or "" for _, t in rows})
    b = pa.RecordBatch.from_pydict({"text": texts})
    vec = list(near_dup.each(b))
    parent = {t: t for t in texts}

    def find(t):
        while parent[t] != t:
            t = parent[t]
        return t

    for i in range(len(texts)):
        for j in range(i):
            if near_dup.similarity(vec[i], vec[j], idf) >= threshold:
                parent[find(texts[i])] = find(texts[j])
    out = {}
    for d, t in rows:
        out.setdefault(find(t or ""), set()).add((d is not None, d))
    return sorted(sorted(x) for x in out.values())


def corpus():
    r = random.Random(3)
    vocab = [f"w{i}" for i in range(400)]
    rows, d = [], 0
    for group in range(40):
        base = [r.choice(vocab) for _ in range(r.randint(30, 120))]
        for copy in range(r.choice([1, 1, 2, 3, 12])):
            w = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 4, 8])):
                w[r.randrange(len(w))] = r.choice(vocab)
            rows.append((d, " ".join(w)))
            d += 1
    rows += [(d, "one two"), (d + 1, "one two"), (d + 2, ""), (d + 3, None), (None, rows[0][1]), rows[5], rows[5]]
    r.shuffle(rows)
    return rows


def test_classes(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    idf = near_dup.idf_table(docs, near_dup.IDF_SHARE)
    got = near_dup.classes(docs).collect()
    assert len(got) == len(rows)
    groups = {}
    for r in got:
        groups.setdefault(bytes(r["class"]), set()).add((r.doc_id is not None, r.doc_id))
        assert r.class_id is None or r.class_id <= r.doc_id
    assert sorted(sorted(x) for x in groups.values()) == brute(rows, idf, near_dup.THRESHOLD)
    assert any(len(x) > 5 for x in groups.values())


def test_blocks_lose_no_link(spark, monkeypatch):
    """Bands of one sampler put strangers into a bucket; the blocks must sort them out."""
    monkeypatch.setattr(near_dup, "BLOCK", 5)
    monkeypatch.setattr(near_dup, "HOT_BUCKET", 4)      # hot buckets, copies, classes and nodes are split out
    monkeypatch.setattr(common, "HOT_KEY_ROWS", 2)
    monkeypatch.setattr(near_dup.components, "__defaults__", (2,))
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    idf = near_dup.idf_table(docs, near_dup.IDF_SHARE)
    groups = {}
    for r in near_dup.classes(docs, bands=16, rows=1).collect():
        groups.setdefault(bytes(r["class"]), set()).add((r.doc_id is not None, r.doc_id))
    assert sorted(sorted(x) for x in groups.values()) == brute(rows, idf, near_dup.THRESHOLD)


def test_weights_are_of_exact_document_frequencies(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    df = Counter()
    for _, t in rows:
        w = (t or "").split()
        own = {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, min(len(w), 1)))}
        df.update(own)
    values = {g: near_dup.shingle_hashes(next(near_dup.documents(pa.RecordBatch.from_pydict({"text": [" ".join(g)]}))))[0] for g in df}
    assert len(set(values.values())) == len(df)
    for most in (near_dup.FREQUENT, 1000, 200, 1):
        floor = max(1, sum(df.values()) // most)
        idf = near_dup.idf_table(docs, 0.5, most)
        got = idf.of(np.array([values[g] for g in df], np.uint64))
        want = [1 + 0.5 * math.log1p(len(rows) / max(n, floor)) / math.log1p(len(rows) / floor) for n in df.values()]
        assert np.allclose(got, want, rtol=1e-12)
        assert len(idf.hashes) == sum(n > floor for n in df.values()) < most
    none = near_dup.idf_table(docs.limit(0), 0.5)
    assert len(none.hashes) == 0 and none.rare == 1.5


def test_sampling_matches_similarity():
    r = np.random.default_rng(2)
    s = near_dup.Sampler(400, 1)
    h = r.integers(0, 1 << 63, 300, np.uint64)
    w = r.uniform(1, 3, 300)
    a, b = slice(0, 240), slice(60, 300)
    agree = (s.sketch(h[a], w[a]) == s.sketch(h[b], w[b])).mean()
    both, whole = w[60:240].sum(), w.sum()
    assert abs(agree - both / whole) < 0.08


def test_keep_one_and_empty(spark):
    rows = [(1, "a b c d e f", "x"), (2, "a b c d e f", "y"), (2, "a b c d e f", "y"), (3, None, "z"), (4, "", "z"),
            (None, "q r s", "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node string")
    assert sorted(near_dup.keep_one(docs).collect(), key=repr) == sorted(
        [r for r in docs.collect() if r.doc_id in (1, 3, None)], key=repr)
    assert near_dup.near_duplicates(docs.limit(0)).count() == 0
    assert near_dup.keep_one(docs.limit(0)).columns == ["doc_id", "text", "node"]


def test_sketch_follows_its_law():
    """One shingle at a time, in the same single precision: the least c / exp(r (t - beta + 1)) wins."""
    from edgeframe.llm.recurrence import BASE, mixed
    rng = np.random.default_rng(2)
    s = near_dup.Sampler(2, 2)
    for n in (1, 40, 2500):
        h, w = rng.integers(0, 1 << 63, n).astype(np.uint64), 1 + rng.random(n)
        picks = []
        for spin in s.spin:
            at = [int(x & np.uint64(0xFFFFFFFF)) * int(spin) % (1 << 32) >> 16 for x in h]
            t = [np.floor(np.float32(np.log(v)) * s.inverse[k] + s.beta[k]) for k, v in zip(at, w)]
            a = [s.ln_c[k] - s.r[k] * (x - s.beta[k] + np.float32(1)) for k, x in zip(at, t)]
            picks.append((h[int(np.argmin(a))], int(t[int(np.argmin(a))])))
        with np.errstate(over="ignore"):
            one = [mixed(p + mixed(np.array([t], np.int64).astype(np.uint64) + BASE)) for p, t in picks]
            want = []
            for band in (0, 1):
                out = np.array([band + 1], np.uint64) * BASE
                for row in (0, 1):
                    out = mixed(out * BASE + one[2 * band + row])
                want.append(int(out.view(np.int64)[0]))
        assert s.sketch(h, w).tolist() == want
