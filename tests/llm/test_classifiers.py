"""Held-out accuracy of the two classifiers, and their edge cases."""

import zlib

import pyarrow as pa
from pyspark.sql import functions as F

from edgeframe.llm import langid, quality
from edgeframe.llm.textcol import table

SF = "/root/testdata/sf0.01"


def test_quality_held_out(spark):
    labels = table(spark, SF, "labels")
    got = {r.doc_id: r for r in quality.scores(table(spark, SF, "documents"), labels).collect()}
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) for d, r in got.items())
    held = [(got[r.doc_id].predicted, r.quality) for r in labels.collect() if got[r.doc_id].held_out]
    assert sum(p == q for p, q in held) > 0.9 * len(held)
    bad = [p for p, q in held if q == 0]
    assert sum(p == 0 for p in bad) > 0.5 * len(bad)


def test_quality_learns_nothing_from_held_out_labels(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    labels = table(spark, "/root/testdata/sf0.001", "labels")
    held = quality.fold(3) == 1
    flipped = labels.where(~held).unionByName(labels.where(held).selectExpr("doc_id", "1 - quality AS quality", "toxic"))
    assert (quality.fit(docs, labels) == quality.fit(docs, flipped)).all()


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, "a b", 1.0), (2, "", 0.0), (3, None, 0.0), (None, "c", 0.0), (1, "a b", 1.0)],
                                 "doc_id long, text string, score double")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in quality.scores(docs, none).collect()] == [0.5] * 5
    some = spark.createDataFrame([(1, 1), (2, 0), (1, 1), (None, 0), (3, None)], "doc_id long, quality int")
    got = quality.scores(docs, some).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    assert quality.scores(docs.limit(0), some).count() == 0


def test_quality_trains_on_one_text_per_id_and_a_bounded_number_of_features(spark):
    rows = [(1, f"text number {k}") for k in range(3000)] + [(2, "bad bad"), (3, "fine words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "doc_id long, quality int")
    learned = [d for d in (1, 2, 3) if zlib.crc32(str(d).encode()) % 3 != 1]
    assert 1 in learned
    first = docs.where("doc_id = 1").orderBy(F.xxhash64("text")).limit(1)
    one = first.unionByName(docs.where("doc_id > 1"))
    assert (quality.fit(docs.repartition(5), labels) == quality.fit(one, labels)).all()
    by_hash = [r.doc_id for r in labels.orderBy(F.xxhash64("doc_id"), "doc_id").collect() if r.doc_id in learned]
    alone = quality.fit(one, labels.where(F.col("doc_id") == by_hash[0]))
    size = len(next(quality.bags(pa.RecordBatch.from_pydict(
        {"text": [r.text for r in one.collect() if r.doc_id == by_hash[0]]})))[0])
    assert (quality.fit(docs, labels, most=size) == alone).all()
    assert (quality.fit(docs, labels, most=size - 1) == 0).all()


def test_language_held_out(spark):
    docs = table(spark, SF, "documents")
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = langid.predictions(docs).collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) > 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_language_edges(spark):
    rows = [(k, "der hund und die katze " * 3, "de") for k in range(20)] + [(k, "the dog and the cat " * 3, "en") for k in range(20, 40)]
    rows += [(50, None, "en"), (51, "123 !? …", "de"), (52, "", None), (None, "the dog", None), (53, "ЖЖЖЖ щщщ", None)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, v string")
    got = {r.doc_id: r for r in langid.predictions(docs).collect()}
    assert got[50].lang_pred == got[51].lang_pred == got[52].lang_pred == "und" and got[50].score == 0
    assert got[None].lang_pred == "en" and got[0].lang_pred == "de" and got[53].rejected and not got[0].rejected
    assert langid.predictions(docs.limit(0)).count() == 0
    assert {r.lang_pred for r in langid.predictions(docs.selectExpr("doc_id", "text", "cast(null as string) lang")).collect()} == {"und"}
