"""Importance resampling towards a target distribution over hashed n-grams.

A text is folded and its separators collapse to single blanks.  Per n-gram order one regular
expression then runs over it with ``overlapped=True``; its boundary lookarounds let a match begin
at the start of a word only and end at the end of one, so the spans that it emits are the
n-grams, every one of them, and a span's bytes are hashed (CRC-32) to a bucket as it is emitted.
No word list and no n-gram list is built.

The bucket numbers of every document are written once; the bucket counts of both sides, the
gain of each bucket and the scores are made from them.  Only bucket counts, as many as there are
buckets, meet on the driver.  The draw takes the highest scores by a global rank over range
partitions.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeframe.llm.ranks import with_rank
from edgeframe.llm.textcol import column, slices, texts, written

ORDERS = (1, 2)
BUCKETS = 10_000
SHARE = 25
LEAST_WORDS = 20
SEED = 7

#: every byte of a separator becomes a blank, A-Z become a-z; bytes of non-ASCII characters stay
FOLD = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c > 0x7F
             else 0x20 for c in range(256))
BLANKS = regex.compile(rb"  +")


def scanner(order: int):
    """Spans of ``order`` words in collapsed text that has a blank before and after every word."""
    return regex.compile(rb" \K[^ ]++(?: [^ ]++){%d}(?= )" % (order - 1))


def collapsed(text: bytes) -> bytes:
    return b" " + BLANKS.sub(b" ", text.translate(FOLD)).strip(b" ") + b" "


def gram_buckets(text: bytes, scanners: Sequence, buckets: int) -> np.ndarray:
    """The bucket of every n-gram of the text, order by order."""
    flat = collapsed(text)
    return np.concatenate([np.fromiter((crc32(m[0]) for m in s.finditer(flat, overlapped=True)), np.uint32) % buckets
                           for s in scanners]).astype(np.uint32)


def featured(docs: DataFrame, id_col: str | None, text_col: str, orders: Sequence[int], buckets: int,
             name: str) -> DataFrame:
    """Written (doc_id, n_words, n_features, grams): a row per row of ``docs``; ``grams`` holds the
    bucket numbers as 32-bit integers."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanners = [scanner(n) for n in orders]
        for b in slices(batches):
            raw = texts(b)
            found = [gram_buckets(t, scanners, buckets) for t in raw]
            yield pa.RecordBatch.from_pydict({
                "doc_id": column(b, "doc_id"),
                "n_words": pa.array([len(t.translate(FOLD).split()) for t in raw], pa.int64()),
                "n_features": pa.array([len(x) for x in found], pa.int64()),
                "grams": pa.array([x.tobytes() for x in found], pa.binary())})

    doc_id = F.col(id_col).cast("long") if id_col else F.lit(None).cast("long")
    source = docs.select(doc_id.alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return written(source.mapInArrow(scan, "doc_id long, n_words long, n_features long, grams binary"), name)


def bucket_counts(features: DataFrame, buckets: int) -> list[int]:
    """How often each bucket occurs.  A task sends one row per bucket at most; the driver gets one
    row per bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for grams in texts(b, "grams"):
                total += np.bincount(np.frombuffer(grams, np.uint32), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(at, pa.int64()), "n": pa.array(total[at], pa.int64())})

    out = [0] * buckets
    for r in features.select("grams").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: list[int], target: list[int]) -> list[int]:
    """Per bucket 1000 times the log of the target's smoothed share over the source's, floored."""
    n = len(source)
    s_all, t_all = float(sum(source) + n), float(sum(target) + n)
    return [math.floor(1000 * math.log((t + 1) * s_all / ((s + 1) * t_all))) for s, t in zip(source, target)]


def noise(doc_id: int | None, seed: int) -> int:
    """A fixed Gumbel draw of the document, times 1000 and floored; a null id counts as an empty one."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(features: DataFrame, gain: list[int], seed: int) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score)."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = np.array(gain, np.int64)
        for b in batches:
            weight = [int(of[np.frombuffer(g, np.uint32)].sum()) // (len(g) // 4) if g else 0 for g in texts(b, "grams")]
            drawn = [w + noise(i, seed) for w, i in zip(weight, column(b, "doc_id").to_pylist())]
            yield pa.RecordBatch.from_pydict({
                "doc_id": column(b, "doc_id"), "n_words": column(b, "n_words"), "n_features": column(b, "n_features"),
                "weight": pa.array(weight, pa.int64()), "score": pa.array(drawn, pa.int64())})

    return features.mapInArrow(score, "doc_id long, n_words long, n_features long, weight long, score long")


def resampled(docs: DataFrame, target: DataFrame, share: int = SHARE, least_words: int = LEAST_WORDS,
              orders: Sequence[int] = ORDERS, buckets: int = BUCKETS, seed: int = SEED, id_col: str = "doc_id",
              text_col: str = "text", target_text_col: str = "text") -> DataFrame:
    """Query op12, one row per row of ``docs``: doc_id, n_features, weight, score, rank.

    Of the N documents with ``least_words`` words or more, floor(share * N / 100) are drawn, by
    score, then by smaller id (null: last); rank is null for all others.  Null texts are empty and
    have weight 0; repeated rows are rows and may both be drawn, in either order; an empty target or
    an empty table counts 0 everywhere.  Other columns are not read."""
    features = featured(docs, id_col, text_col, orders, buckets, "resample_source")
    aims = featured(target, None, target_text_col, orders, buckets, "resample_target")
    gain = gains(bucket_counts(features, buckets), bucket_counts(aims, buckets))
    rows = written(scored(features, gain, seed).withColumn("row", F.monotonically_increasing_id()), "resample_scores")
    enough = F.col("n_words") >= least_words
    n_drawn = share * rows.where(enough).count() // 100
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row")]
    out = ["doc_id", "n_features", "weight", "score"]
    ranked = with_rank(rows.where(enough).select(*out, "row"), order, "rank", "resample_ranks")
    drawn = F.when(F.col("rank") <= n_drawn, F.col("rank")).alias("rank")
    return ranked.select(*out, drawn).unionByName(rows.where(~enough).select(*out, F.lit(None).cast("long").alias("rank")))


def draw(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The rows of :func:`resampled` that are drawn, best first by ``rank``."""
    return resampled(docs, target, **options).where(F.col("rank").isNotNull())
