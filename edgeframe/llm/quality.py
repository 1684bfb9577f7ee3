"""Quality classifier: supervised subword embeddings.

A document is the mean of the vectors of its words and of their byte 3- to 5-grams, hashed into
``CLASSES`` rows; a softmax layer gives the two labels.  Vectors and layer are learned together by
stochastic gradient descent in numpy, inside one Spark task, from at most ``SAMPLE`` labelled
documents (those of the least hash of their id, one text per id) with at most ``FEATURES`` distinct
features between them.  A score is linear in the mean, so each row of
the table is reduced to one number before all texts are scored, and a word's features are summed
once per slice.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from edgeframe.llm.ngrams import fold, hashed_ngrams
from edgeframe.llm.textcol import column, slices, spans, sums, texts, written

SAMPLE = 6000
#: features (8 bytes each) of all documents that the training task holds
FEATURES = 24_000_000
CLASSES = 1 << 17
SIZES = (3, 4, 5)
DIMS, EPOCHS, RATE = 16, 6, 0.4
FOLDS, HELD_OUT = 3, 1


def words(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(word numbers of all documents end to end, ends of documents, the distinct words)."""
    cut = [t.split() for t in texts(b)]
    coded = pa.array(list(itertools.chain.from_iterable(cut)), pa.binary()).dictionary_encode()
    return (coded.indices.to_numpy().astype(np.int64), np.cumsum(np.fromiter(map(len, cut), np.int64, len(cut))),
            coded.dictionary.to_pylist())


def bags(b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per document its features and their shares."""
    word, ends, distinct = words(b)
    n, feature = hashed_ngrams(distinct, SIZES, CLASSES, whole=True)
    first = np.cumsum(n) - n
    for s, e in zip([0, *ends[:-1].tolist()], ends.tolist()):
        w = word[s:e]
        got, count = np.unique(feature[np.repeat(first[w], n[w]) + spans(n[w])] if e > s else feature[:0],
                               return_counts=True)
        yield got, (count / max(count.sum(), 1)).astype(np.float32)


def train(sample: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 11) -> np.ndarray:
    """One number per feature class: what an occurrence adds to the log odds of label 1, and at the
    end the log odds of a document without words."""
    draw = np.random.default_rng(seed)
    table = draw.uniform(-1 / DIMS, 1 / DIMS, (CLASSES, DIMS)).astype(np.float32)
    layer = np.zeros((DIMS, 2), np.float32)
    used = [i for i, (f, _) in enumerate(sample) if len(f)]
    steps, done = EPOCHS * max(len(used), 1), 0
    for _ in range(EPOCHS):
        for i in draw.permutation(used).tolist() if used else []:
            feature, share = sample[i]
            mean = share @ table[feature]
            logit = mean @ layer
            p = np.exp(logit - logit.max())
            error = p / p.sum()
            error[int(labels[i])] -= 1
            rate = RATE * (1 - done / steps)
            done += 1
            back = layer @ error
            layer -= rate * np.outer(mean, error)
            # a mean over n features moves each by 1/n: the step is scaled to move the mean itself
            table[feature] -= rate * np.outer(share / max(float((share * share).sum()), 1e-6), back).astype(np.float32) * 0.1
    share = (float(labels.sum()) + 1) / (len(labels) + 2)
    return np.append(table @ (layer[:, 1] - layer[:, 0]), np.log(share / (1 - share))).astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", sample: int = SAMPLE,
        most: int = FEATURES) -> np.ndarray:
    """The scorer, learned from rows of (doc_id, label) outside the held-out fold.  The sample is
    bounded by ``sample`` labels, by one document for each (of those that share an id, the text of the
    least hash) and by ``most`` features: documents in the order of their id's hash, as long as all up
    to them hold no more.  A document is brought as its words' features, not as text."""
    rows = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
            .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & (fold(FOLDS) != HELD_OUT))
            .groupBy("doc_id").agg(F.max("label").alias("label")))
    chosen = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def bag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            got = list(bags(b))
            yield pa.RecordBatch.from_pydict({
                "doc_id": column(b, "doc_id"), "label": column(b, "label"),
                "many": pa.array([len(f) for f, _ in got], pa.int64()), "feature": pa.array([f.astype(np.int32).tobytes() for f, _ in got], pa.binary()),
                "share": pa.array([s.tobytes() for _, s in got], pa.binary())})

    def learn(t: pa.Table) -> pa.Table:
        order = np.argsort([xxhash.xxh3_64_intdigest(x) >> 1 for x in t.column("feature").to_pylist()], kind="stable")
        t = t.take(pa.array(order))             # the result must not depend on the order of arrival
        got = [(np.frombuffer(f, np.int32), np.frombuffer(s, np.float32))
               for f, s in zip(t.column("feature").to_pylist(), t.column("share").to_pylist())]
        model = train(got, np.array(t.column("label").to_pylist()))
        return pa.table({"model": pa.array([model.tobytes()], pa.binary())})

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    one = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
           .join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label")
           .agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text"))["text"].alias("text")))
    bagged = written(one.mapInArrow(bag, "doc_id long, label int, many long, feature binary, share binary"), "bags")
    # a running sum over at most ``sample`` numbers
    fits = (bagged.select("doc_id", F.sum("many").over(Window.orderBy(F.xxhash64("doc_id"), "doc_id")).alias("held"))
            .where(F.col("held") <= most).select("doc_id"))
    found = (bagged.join(F.broadcast(fits), "doc_id").select("label", "feature", "share")
             .withColumn("all", F.lit(1)).groupBy("all").applyInArrow(learn, "model binary").collect())
    return np.frombuffer(found[0]["model"], np.float32) if found else np.zeros(CLASSES + 1, np.float32)


def scores(docs: DataFrame, labels: DataFrame, label_col: str = "quality", sample: int = SAMPLE) -> DataFrame:
    """Query op5, one row per row of ``docs``: doc_id, held_out, score, predicted.  A text without
    words (null or empty) gets the share of label 1 in the sample; without any labels every score
    is 0.5.  Repeated rows get equal scores, rows that share an id each the score of their text; other
    columns are not read."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, label_col, sample))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value.astype(np.float64)
        for b in slices(batches):
            word, ends, distinct = words(b)
            n, feature = hashed_ngrams(distinct, SIZES, CLASSES, whole=True)
            of_word = sums(model[feature], np.cumsum(n))
            many = sums(n[word], ends)
            total = sums(of_word[word], ends)
            logit = np.where(many > 0, total / np.maximum(many, 1), model[-1])
            yield pa.RecordBatch.from_pydict({"doc_id": column(b, "doc_id"), "held_out": column(b, "held_out"),
                                              "score": pa.array(1 / (1 + np.exp(-np.clip(logit, -30, 30))))})

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold(FOLDS) == HELD_OUT).alias("held_out"),
                         F.col("text").cast("string").alias("text"))
    return (source.mapInArrow(score, "doc_id long, held_out boolean, score double")
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))
