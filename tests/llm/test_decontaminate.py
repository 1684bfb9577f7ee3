"""Positional index search against brute force."""

import hashlib
import random
import re

import pytest

from edgeframe.llm import decontaminate as d
from edgeframe.llm.queries import op1_decontaminate
from edgeframe.llm.textcol import written


def words(t):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)


def brute(docs, items, window):
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for item, it in items:
            b = words(it)
            for p in [b] if 0 < len(b) < window else [b[i:i + window] for i in range(len(b) - window + 1)]:
                for i in range(len(w) - len(p) + 1):
                    if w[i:i + len(p)] == p:
                        hit |= set(range(i, i + len(p)))
                        found.add("" if item is None else str(item))
        ids = ",".join(sorted(found))
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def cases(seed):
    r = random.Random(seed)
    vocab = ["a", "B", "é", "Ünd", "x1", "9", "the"]
    text = lambda n: r.choice([" ", ", ", "-"]).join(r.choice(vocab) for _ in range(n))
    docs = [(k, text(r.randint(0, 60))) for k in range(60)]
    items = [(k, text(r.choice([1, 3, 4, 5, 7]))) for k in range(12)]
    docs += [(100, items[3][1] + " " + items[5][1]), (101, None), (102, ""), (None, items[0][1]), docs[0], docs[0]]
    items += [(50, None), (51, ""), (None, "x1 9 x1 9"), items[0], (52, items[0][1])]
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("block_words", [8, 100_000])
def test_exact_phrases(spark, seed, block_words):
    docs, items = cases(seed)
    got = d.contamination(spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
                          spark.createDataFrame(items, "item_id long, text string"), window=4, block_words=block_words)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs, items, 4)


def test_each_block_is_written_once_and_none_is_empty(spark, monkeypatch):
    items = spark.createDataFrame([(k, f"w{k} x y z") for k in range(6)], "item_id long, text string")
    docs = spark.createDataFrame([(k, f"a w{k} x y z b") for k in range(6)], "doc_id long, text string")
    sizes = [len(b["items"]) for b in d.query_blocks(items, "item_id", "text", 4, 4)]
    assert sizes == [1] * 6
    assert [len(b["items"]) for b in d.query_blocks(items.limit(0), "item_id", "text", 4, 4)] == [0]
    names = []
    monkeypatch.setattr(d, "written", lambda df, name: names.append(name) or written(df, name))
    got = d.contamination(docs, items, window=4, block_words=4)
    assert names.count("matches") == 6
    assert [(r.doc_id, r.n_hit, r.n_items) for r in got.orderBy("doc_id").collect()] == [(k, 4, 1) for k in range(6)]


def test_proximity(spark):
    docs = [(1, "one two x three four"), (2, "four three two one"), (3, "one two"), (4, "three four"), (5, "one two three four")]
    items = spark.createDataFrame([(7, "one two three four")], "item_id long, text string")
    frame = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    hits = lambda slop: sorted(r.doc_id for r in d.find_phrases(frame, items, window=4, slop=slop).collect() if r.spans)
    assert hits(0) == [5] and hits(1) == [1, 5]
    spans = {r.doc_id: [tuple(s) for s in r.spans] for r in d.find_phrases(frame, items, window=4, slop=0).collect()}
    assert spans[5] == [(0, 4)] and spans[1] == []


def test_empty_tables_and_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a b c", 5, "x")], "doc_id long, text string, shard int, items string")
    items = spark.createDataFrame([(1, "b c")], "item_id long, text string")
    assert [tuple(r)[:4] for r in d.contamination(docs, items).collect()] == [(1, 3, 2, 1)]
    assert [tuple(r)[:4] for r in d.contamination(docs, items.limit(0)).collect()] == [(1, 3, 0, 0)]
    assert d.contamination(docs.limit(0), items).count() == 0
    assert d.drop_contaminated(docs, items).count() == 0
    assert d.drop_contaminated(docs, items.limit(0)).collect() == docs.collect()


def test_drop_keeps_rows_that_share_an_id(spark):
    docs = spark.createDataFrame([(1, "clean text"), (1, "q b c"), (2, "b  c"), (None, "fine")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "b c")], "item_id long, text string")
    assert sorted(map(tuple, d.drop_contaminated(docs, items).collect()), key=repr) == [(1, "clean text"), (None, "fine")]


def test_query(spark, sf):
    assert op1_decontaminate(spark, sf).count() == spark.read.parquet(f"{sf}/documents.parquet").count()
