"""Suffix-array and automaton removal against brute force."""

import hashlib
import random

import numpy as np
import pytest

from edgeframe.llm import phrase_dedup, suffix_dedup
from edgeframe.llm.recurrence import BATCH_BYTES, byte_units, contexts, recurring_hashes, tagged, word_units


def brute(docs, length, split, glue):
    """docs: (doc_id, text).  Rows that agree in id and text are one document."""
    order = sorted({(d, t) for d, t in docs}, key=lambda r: r[0])
    seen, out = set(), {}
    for d, t in order:
        u = split(t)
        hit = [False] * len(u)
        for i in range(len(u) - length + 1):
            w = tuple(u[i:i + length])
            if w in seen:
                hit[i:i + length] = [True] * length
            seen.add(w)
        kept = glue([x for x, h in zip(u, hit) if not h])
        spans = sum(h and not (i and hit[i - 1]) for i, h in enumerate(hit))
        out[d, t] = (len(u), sum(hit), spans, hashlib.sha256(kept).hexdigest())
    return out


def corpus(seed, alphabet, parts, docs):
    r = random.Random(seed)
    piece = lambda n: "".join(r.choice(alphabet) for _ in range(n))
    shared = [piece(r.randint(5, 60)) for _ in range(parts)]
    rows = []
    for d in range(docs):
        t = "".join(r.choice(shared) if r.random() < 0.6 else piece(r.randint(0, 30)) for _ in range(r.randint(0, 8)))
        rows.append((d, t))
    rows += [(docs + k, rows[k][1]) for k in range(5)] + [rows[3], rows[3]]     # copies, a repeated row
    rows += [(docs + 9, ""), (docs + 10, shared[0] * 30)]
    r.shuffle(rows)
    return rows


def test_suffix_array_is_the_sorted_order():
    r = np.random.default_rng(4)
    for _ in range(60):
        n = int(r.integers(1, 200))
        x = r.integers(97, 97 + int(r.integers(1, 5)), n).astype(np.uint8)
        raw = x.tobytes()
        sa = suffix_dedup.suffix_array(x, n + 1)
        assert sa.tolist() == sorted(range(n), key=lambda i: raw[i:])
        small = suffix_dedup.smaller_than_next(x)
        assert small.tolist() == [raw[i:] < raw[i + 1:] for i in range(n - 1)] + [False]
        lcp = suffix_dedup.common_prefixes(x, sa, 12)
        for k, v in enumerate(lcp):
            a, b = raw[sa[k]:], raw[sa[k + 1]:]
            want = next((i for i, (p, q) in enumerate(zip(a, b)) if p != q), min(len(a), len(b)))
            assert v == min(want, 12)


@pytest.mark.parametrize("seed", [1, 2])
def test_suffix_removal(spark, seed):
    rows = corpus(seed, "abé\n", 6, 60)
    want = brute(rows, 12, lambda t: list(t.encode()), bytes)
    got = suffix_dedup.removed(spark.createDataFrame(rows, "doc_id long, text string").repartition(3),
                               length=12, gram=4).collect()
    assert len(got) == len(rows)
    assert sorted(tuple(r) for r in got) == sorted((d, *want[d, t]) for d, t in rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_phrase_removal(spark, seed):
    rows = [(d, t.replace("c", " ").replace("d", " \t")) for d, t in corpus(seed, "abcdcd", 6, 60)]
    want = brute(rows, 6, lambda t: t.encode().split(), b" ".join)
    got = phrase_dedup.removed(spark.createDataFrame(rows, "doc_id long, text string").repartition(3),
                               length=6, gram=2).collect()
    assert sorted(tuple(r) for r in got) == sorted((d, n, g, k) for d, t in rows for n, g, _, k in [want[d, t]])


def test_edge_cases(spark):
    long = "x y " * 40_000
    rows = [(None, "tail " * 60), (1, None), (2, ""), (3, long), (4, long), (5, "tail " * 60), (5, "tail " * 60)]
    extra = spark.createDataFrame([(*r, 1, "a", "b") for r in rows], "doc_id long, text string, tag int, marks string, h string")
    got = {(r.doc_id, r.n_bytes, r.n_removed, r.n_spans) for r in suffix_dedup.removed(extra).collect()}
    n = len(long)
    # a null id is first; a periodic text keeps its first 100 bytes' worth of distinct windows
    assert (None, 300, 300 - 5, 1) in got or (None, 300, 295, 1) in got
    assert {(1, 0, 0, 0), (2, 0, 0, 0), (4, n, n, 1), (5, 300, 300, 1)} <= got
    words = {(r.doc_id, r.n_words, r.n_removed) for r in phrase_dedup.removed(extra).collect()}
    assert {(1, 0, 0), (2, 0, 0), (4, 80_000, 80_000), (5, 60, 60)} <= words
    none = extra.limit(0)
    assert suffix_dedup.removed(none).count() == 0 and phrase_dedup.removed(none).count() == 0


def test_contexts_do_not_depend_on_the_order_of_rows(spark):
    docs = spark.createDataFrame(corpus(3, "ab", 6, 60), "doc_id long, text string")
    source = tagged(docs, "doc_id", "text")
    joined = source.join(recurring_hashes(source, byte_units, 12, 4, 4), "tag").select("tag", "key", "text", "hashes")
    rows = sorted(joined.collect(), key=lambda r: (r.key, r.tag))
    sent = []
    for order in (rows, rows[::-1], rows[1::2] + rows[::2]):
        one = spark.createDataFrame(order, joined.schema).coalesce(1)
        sent.append(contexts(one, byte_units, 12, 4).collect())
    assert any(r.ctx is None for r in sent[0])
    assert sent[0] == sent[1] == sent[2]


def test_every_copy_goes_through_the_automaton(spark):
    text = " ".join(f"w{k}" for k in range(40))
    docs = spark.createDataFrame([(d, f"{text} own{d}") for d in range(9)], "doc_id long, text string").coalesce(1)
    source = tagged(docs, "doc_id", "text")
    joined = source.join(recurring_hashes(source, word_units, 20, 8, 4), "tag")
    sent = contexts(joined, word_units, 20, 8, fold=False).collect()
    assert all(r.ctx is not None for r in sent) and {r.key for r in sent} == set(range(9))
    folded = contexts(joined, word_units, 20, 8).collect()
    assert any(r.ctx is None for r in folded)
    assert {(r.n_removed, r.n_words) for r in phrase_dedup.removed(docs).where("doc_id > 0").collect()} == {(40, 41)}


def test_windows_of_one_hash_and_other_words_stay_apart(monkeypatch):
    monkeypatch.setattr(phrase_dedup, "window_hashes", lambda word, length: np.zeros(len(word) - length + 1, np.uint64))
    cls = phrase_dedup.equal_windows(2)([b"a b c", b"x a b", b"b c d"], np.array([2, 2, 2]))
    ab, bc, xa, ab2, bc2, cd = cls.tolist()
    assert ab == ab2 and bc == bc2 and len({ab, bc, xa, cd}) == 4


@pytest.mark.parametrize("seed", [1, 2])
def test_removal_with_hot_anchors(spark, seed):
    rows = corpus(seed, "abé\n", 6, 60)
    want = brute(rows, 12, lambda t: list(t.encode()), bytes)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = suffix_dedup.removed(df, length=12, gram=4, hot=3).collect()
    assert sorted(tuple(r) for r in got) == sorted((d, *want[d, t]) for d, t in rows)
    rows = [(d, t.replace("c", " ").replace("d", " \t")) for d, t in corpus(seed, "abcdcd", 6, 60)]
    want = brute(rows, 6, lambda t: t.encode().split(), b" ".join)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = phrase_dedup.removed(df, length=6, gram=2, hot=3).collect()
    assert sorted(tuple(r) for r in got) == sorted((d, n, g, k) for d, t in rows for n, g, _, k in [want[d, t]])


def test_a_hot_anchor_is_not_one_group(spark):
    r = random.Random(8)
    phrase = "".join(r.choice("abcdefghij") for _ in range(60))     # too short to be removed
    docs = spark.createDataFrame([(d, f"{r.getrandbits(200):060x}{phrase}{r.getrandbits(200):060x}") for d in range(20_000)],
                                 "doc_id long, text string")
    source = tagged(docs, "doc_id", "text")
    joined = source.join(recurring_hashes(source, byte_units, 100, 32, 16), "tag")
    sizes = contexts(joined, byte_units, 100, 32).selectExpr("h", "length(ctx) size").groupBy("h").sum("size")
    assert max(n or 0 for _, n in sizes.collect()) <= BATCH_BYTES
