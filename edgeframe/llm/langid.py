"""Language identification by the nearest of several centroids per language.

A text is the TF-IDF vector of the byte 2- and 3-grams of its words (letters only, lower case),
hashed into ``DIMS`` classes and scaled to length one.  Document frequencies are counted over all
training documents.  The centroids of a language come from spherical k-means over at most about
``SAMPLE`` of its training documents (chosen by a hash of the id), one language per task; each
keeps the cosine distance that ``REJECT`` of its own members stay within.  A text gets the
language of the nearest centroid; ``rejected`` says that it is further away than that distance.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeframe.llm.ngrams import fold, hashed_ngrams
from edgeframe.llm.textcol import column, slices, spans, texts, written
from edgeframe.operators.common import bounded_broadcast

DIMS = 4096
SIZES = (2, 3)
CENTROIDS = 3
SAMPLE = 1500
REJECT = 0.995
FOLDS, HELD_OUT = 4, 2

#: bytes of ASCII that are no letters become blanks
LETTERS = bytes(c if c > 0x7F or 0x61 <= c <= 0x7A else 0x20 for c in range(256))


def counts(b: pa.RecordBatch) -> Iterator[np.ndarray | None]:
    """Per document the feature counts; None where it has no letter."""
    raw = [t.decode().lower() for t in texts(b)]
    cut = [t.encode().translate(LETTERS).split() for t in raw]
    coded = pa.array(list(itertools.chain.from_iterable(cut)), pa.binary()).dictionary_encode()
    word = coded.indices.to_numpy().astype(np.int64)
    n, feature = hashed_ngrams(coded.dictionary.to_pylist(), SIZES, DIMS)
    first = np.cumsum(n) - n
    s = 0
    for t, own in zip(raw, cut):
        w = word[s:s + len(own)]
        s += len(own)
        if not own or not any(map(str.isalpha, t)):
            yield None
        else:
            yield np.bincount(feature[np.repeat(first[w], n[w]) + spans(n[w])], minlength=DIMS)


def vector(count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = (count * idf).astype(np.float32)
    return v / max(float(np.sqrt(v @ v)), 1e-12)


def inverse_frequency(train: DataFrame) -> np.ndarray:
    """ln(1 + N / df) per feature class, over all training documents; the sums have a fixed size."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(DIMS + 1, np.int64)
        for b in slices(batches):
            for c in counts(b):
                if c is not None:
                    df[:-1] += c > 0
                    df[-1] += 1
        yield pa.RecordBatch.from_pydict({"part": pa.array([TaskContext.get().partitionId() % 64], pa.int32()),
                                          "df": pa.array([df.tobytes()], pa.binary())})

    def total(t: pa.Table) -> pa.Table:
        return pa.table({"df": pa.array([sum(np.frombuffer(x, np.int64) for x in t.column("df").to_pylist()).tobytes()],
                                        pa.binary())})

    # summed in two steps: 64 groups of tasks, then one row for each group
    rows = (train.select("text").mapInArrow(count, "part int, df binary")
            .groupBy("part").applyInArrow(total, "df binary").collect())
    df = sum((np.frombuffer(r["df"], np.int64) for r in rows), np.zeros(DIMS + 1, np.int64))
    return np.log1p(df[-1] / np.maximum(df[:-1], 1)).astype(np.float32)


def cluster(x: np.ndarray, k: int = CENTROIDS, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means: centroids of length one and the member distances' REJECT quantile."""
    centre = [x[0]]
    for _ in range(min(k, len(x)) - 1):         # the next seed is the row least like the others
        centre.append(x[np.max(x @ np.stack(centre).T, axis=1).argmin()])
    centre = np.stack(centre)
    for _ in range(rounds):
        near = (x @ centre.T).argmax(1)
        new = np.stack([x[near == j].sum(0) if (near == j).any() else centre[j] for j in range(len(centre))])
        centre = new / np.maximum(np.linalg.norm(new, axis=1, keepdims=True), 1e-12)
    like = x @ centre.T
    near = like.argmax(1)
    radius = [np.quantile(1 - like[near == j, j], REJECT) if (near == j).any() else 0.0 for j in range(len(centre))]
    return centre.astype(np.float32), np.array(radius, np.float64)


def fit(docs: DataFrame, sample: int = SAMPLE) -> dict:
    """Learned from text and non-null lang of the documents outside the held-out fold."""
    train = docs.where((F.col("fold") != HELD_OUT) & F.col("lang").isNotNull())
    idf = inverse_frequency(train)
    shared = docs.sparkSession.sparkContext.broadcast(idf)
    # one row per language, broadcast if that is proven small: texts must not be dealt by language
    share, _ = bounded_broadcast(written(
        train.groupBy("lang").agg((F.lit(sample) / F.count(F.lit(1))).alias("share")), "shares"))
    chosen = (train.join(share, "lang")
              .where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) < F.col("share") * (1 << 20)))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            got = [None if c is None else vector(c, shared.value).tobytes() for c in counts(b)]
            rows = pa.RecordBatch.from_pydict({"lang": column(b, "lang"), "v": pa.array(got, pa.binary())})
            yield rows.filter(rows.column(1).is_valid())

    def centroids(t: pa.Table) -> pa.Table:
        x = np.stack([np.frombuffer(v, np.float32) for v in sorted(t.column("v").to_pylist())])
        centre, radius = cluster(x)
        return pa.table({"lang": pa.array([t.column("lang")[0].as_py()] * len(centre), pa.string()),
                         "v": pa.array([c.tobytes() for c in centre], pa.binary()), "radius": pa.array(radius, pa.float64())})

    rows = (chosen.select("lang", "text").mapInArrow(vectors, "lang string, v binary")
            .groupBy("lang").applyInArrow(centroids, "lang string, v binary, radius double")
            .orderBy("lang", "v").collect())
    return {"idf": idf, "lang": [r["lang"] for r in rows], "radius": np.array([r["radius"] for r in rows]),
            "centre": np.stack([np.frombuffer(r["v"], np.float32) for r in rows]) if rows else np.zeros((0, DIMS))}


def predictions(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Query op8, one row per row of ``docs``: doc_id, held_out, lang_pred, score (cosine with the
    nearest centroid), rejected.  Null or letterless texts are ``und`` with score 0, as is all where
    there is nothing to learn from; ties go to the first language by name."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                         F.col("lang").cast("string").alias("lang"), fold(FOLDS).alias("fold"))
    shared = docs.sparkSession.sparkContext.broadcast(fit(source, sample))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in slices(batches):
            lang, score, out = [], [], []
            for c in counts(b):
                if c is None or not m["lang"]:
                    best, s, far = "und", 0.0, True
                else:
                    like = m["centre"] @ vector(c, m["idf"])
                    k = int(like.argmax())
                    best, s = m["lang"][k], float(min(max(like[k], 0.0), 1.0))
                    far = 1 - s > m["radius"][k] + 1e-6
                lang.append(best), score.append(s), out.append(far)
            yield pa.RecordBatch.from_pydict({
                "doc_id": column(b, "doc_id"), "held_out": column(b, "held_out"), "lang_pred": pa.array(lang, pa.string()),
                "score": pa.array(score, pa.float64()), "rejected": pa.array(out, pa.bool_())})

    return source.select("doc_id", (F.col("fold") == HELD_OUT).alias("held_out"), "text").mapInArrow(
        predict, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")
