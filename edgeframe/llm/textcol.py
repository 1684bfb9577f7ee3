"""Helpers shared by the text operators: UTF-8 views of Arrow batches, bounded slices,
shared-folder tables and the row key of a document."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeframe.session import scratch_path

SLICE_BYTES = 4 << 20

#: order key of a null doc_id: before every other id
NO_ID = -(1 << 63)


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once (zstd Parquet) under ``spark.checkpoint.dir`` and read back: cuts
    the lineage, survives lost executors, and fixes rows whose order a retry could change."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def doc_key(id_col: str = "doc_id") -> Column:
    """The order of documents as a long: the id, null first."""
    return F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, th, doc_id, text): rows that agree in id and text share (key, th) and are one
    document; rows that agree in the id alone are ordered by ``th``.  Null text: empty."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(doc_key(id_col).alias("key"), F.xxhash64(text).alias("th"),
                       F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without a copy; a null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type)
                            else b"")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, ends, data = col.buffers()
    off = np.frombuffer(ends, np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1]
    off = off.astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), off
    return np.frombuffer(data, np.uint8)[off[0]:off[-1]], off - off[0]


def slices(batches: Iterator[pa.RecordBatch], col: str = "text",
           most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row slices of each batch with about ``most`` bytes of ``col`` (one row at least), so
    that a task holds a few MB of work arrays however large the batches are."""
    for b in batches:
        if not b.num_rows:
            continue
        _, off = utf8(b.column(b.schema.get_field_index(col)))
        i = 0
        while i < b.num_rows:
            j = max(i + 1, int(np.searchsorted(off, off[i] + most, "right")) - 1)
            yield b.slice(i, j - i)
            i = j


def column(b: pa.RecordBatch, name: str) -> pa.Array:
    return b.column(b.schema.get_field_index(name))


def texts(b: pa.RecordBatch, col: str = "text") -> list[bytes]:
    """The column as UTF-8 byte strings; a null is empty."""
    data, off = utf8(column(b, col))
    raw = data.tobytes()
    return [raw[s:e] for s, e in zip(off[:-1].tolist(), off[1:].tolist())]


def spans(lens: np.ndarray) -> np.ndarray:
    """0..n-1 for each n of ``lens``, end to end."""
    ends = np.cumsum(lens)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - lens, lens)


def sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``values`` that end at ``ends`` (empty runs: 0)."""
    acc = np.concatenate([[0], np.cumsum(values)])
    ends = np.asarray(ends, np.int64)
    return acc[ends] - acc[np.concatenate([[0], ends[:-1]]).astype(np.int64)]
