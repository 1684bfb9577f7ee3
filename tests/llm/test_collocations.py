"""Phrases, scores, drops and ranks against a plain version."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from edgeframe.llm import collocations as col


def brute(rows, longest=3, least=10, share=50, top=2000):
    f = Counter()
    for lang, text in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f["und" if lang is None else lang, tuple(w[i:i + k])] += 1
    out = []
    for lang in {x[0] for x in f}:
        own = {p: n for (x, p), n in f.items() if x == lang}
        total = sum(n for p, n in own.items() if len(p) == 1)
        cand = {p: n for p, n in own.items() if len(p) > 1 and n >= least}
        rows = []
        for p, a in cand.items():
            if any(len(q) > len(p) and 100 * b >= share * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                   for q, b in cand.items()):
                continue
            score, _, l, r = min((10**6 * a * a // (own[p[:k]] * own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
            rows.append((score, a, " ".join(p), l, r))
        rows.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, i, p, a, l, r, total, s) for i, (s, a, p, l, r) in enumerate(rows[:top], 1)]
    return sorted(out)


def mined(df, **options):
    return sorted(tuple(r) for r in col.collocations(df, **options).collect())


def test_like_the_plain_version(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert mined(docs) == brute([(r.lang, r.text) for r in docs.collect()])


def test_odd_rows_and_other_parameters(spark):
    rng = random.Random(5)
    words = ["a", "B", "c d", "é", "New", "york", "x\x00y", "-", "日"]
    rows = [(rng.choice(["en", None, "und", ""]), "".join(rng.choice(words) + rng.choice([" ", "\t", "  ", ". ", ",", "\x0b", "\r\n"])
                                                         for _ in range(rng.randrange(60)))) for _ in range(150)]
    rows += [(None, None), ("en", ""), ("de", "...!"), ("en", "new york times " * 3000)] + [("fr", "same row here")] * 40
    docs = spark.createDataFrame([(*r, 7, "n", 1) for r in rows], "lang string, text string, n int, phrase string, w1 int")
    assert mined(docs) == brute(rows)
    assert mined(docs, longest=4, least=3, share=70, top=25) == brute(rows, 4, 3, 70, 25)
    assert mined(docs, longest=2, least=1) == brute(rows, 2, 1)
    assert mined(docs.limit(0)) == []


def test_scores_are_exact_beyond_64_bits(spark):
    a, l, r = 9 * 10**11 + 7, 10**12 + 1, 10**12 + 3
    one = spark.createDataFrame([(a, l, r)], "a long, l long, r long")
    got = one.select(col.association(one.a, one.l, one.r)).first()[0]
    assert got == 10**6 * a * a // (l * r)


def unpacked(batch, longest):
    """{window: count}, and the rows that hold each first word."""
    out, rows = Counter(), Counter()
    for r in batch.to_pylist():
        rows[r["lang"], r["w1"]] += 1
        for line in r["packed"].split("\n"):
            *tail, n = line.split("\t")
            assert len(tail) == longest - 1
            out[(r["lang"], r["w1"], *tail)] += int(n)
    return out, rows


def test_windows_of_a_slice(monkeypatch):
    b = pa.RecordBatch.from_pydict({"lang": ["x", "y", "x"], "text": ["a b a b a, b a", "a b", ""]})
    small, rows = unpacked(col.windows(b, 3), 3)
    assert small["x", "a", "b", "a"] == 2 and small["x", "a", "", ""] == 2 and sum(small.values()) == 9
    assert set(rows.values()) == {1}
    dealt, rows = unpacked(col.windows(b, 3, frozenset([("x", "a"), ("z", "b"), ("x", "none")]), 50), 3)
    assert dealt == small and rows["x", "a"] == 2 and rows["x", "b"] == rows["y", "a"] == 1
    monkeypatch.setattr(np, "argsort", None)            # a vocabulary too large for one number
    wide, _ = unpacked(col.windows(b, 60), 60)
    assert Counter({k[:4]: 0 for k in wide}) == Counter({k: 0 for k in small}) and sum(wide.values()) == 9


def test_hot_words_are_found_and_change_nothing(spark, monkeypatch):
    rows = [("en", f"hot w{k % 7} hot v{k % 5}. hot") for k in range(200)] + [("en", f"cold{k} word{k}") for k in range(300)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert ("en", "hot") in col.hot_words(docs, 1 / 16) and len(col.hot_words(docs, 1 / 16)) < 32
    want = brute(rows)
    assert mined(docs) == want
    monkeypatch.setattr(col, "hot_words", lambda *_: frozenset())
    assert mined(docs) == want


def test_windows_are_counted_once(spark, monkeypatch):
    from edgeframe.llm import collocations as c
    from edgeframe.plans.inspect import plan_text
    seen, put = [], c.written
    monkeypatch.setattr(c, "written", lambda df, name: seen.append(plan_text(df)) or put(df, name))
    docs = spark.createDataFrame([(i, "en", "a b c d. a b x") for i in range(12)], "doc_id long, lang string, text string")
    got = {(r["k"], r["phrase"]): r["f"] for r in c.frequencies(docs, 3, 10, "text", "lang").collect()}
    assert got[3, "a b c"] == got[3, "b c d"] == got[3, "a b x"] == 12 and got[2, "a b"] == got[1, "a"] == 24 and got[0, ""] == 84
    assert seen[0].split("\n\n")[0].count("MapInArrow") == 1
