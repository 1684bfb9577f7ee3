"""Substring removal with suffix arrays built by two-stage sorting.

Every byte covered by a ``length``-byte string that also starts earlier (in a document of a
smaller id, or further up in the same one) is removed.  ``recurrence`` brings the passages that
can recur together; here a suffix array of such passages tells which are equal:

* stage one sorts only the suffixes that are smaller than their successors, eight bytes a
  round, up to ``length`` bytes;
* stage two induces all others by scanning the buckets of first bytes in order: a suffix that
  is larger than its successor goes to the end of what its bucket holds so far;
* then the common prefixes of neighbours are computed, and neighbours that share ``length``
  bytes start equal strings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from edgeframe.llm.recurrence import byte_units, covered, rewritten, runs, with_marks
from edgeframe.llm.textcol import column, slices, sums, utf8

LENGTH = 100
GRAM = 32
#: stands between passages: no byte of UTF-8
BREAK = 0xFF


def octets(x: np.ndarray) -> np.ndarray:
    """The eight bytes from each place as one number, big end first; zeros beyond the end."""
    w = np.concatenate([x, np.zeros(8, np.uint8)]).astype(np.uint64)
    for size in (1, 2, 4):
        w = (w[:-size] << np.uint64(8 * size)) | w[size:]
    return w[:len(x)]


def smaller_than_next(x: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than their successors (the last one is larger than nothing)."""
    n = len(x)
    differs = np.flatnonzero(x[:-1] != x[1:])
    at = np.searchsorted(differs, np.arange(n))
    up = np.append(x[differs] < x[differs + 1], False)      # beyond: equal bytes to the end
    return up[at]


def sort_directly(at: np.ndarray, word: np.ndarray, depth: int) -> np.ndarray:
    """``at`` in the order of the first ``depth`` bytes of their suffixes (ties: any order)."""
    out = at[np.argsort(word[at], kind="stable")]
    key = word[out]
    group = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])]) if len(out) else np.zeros(0, np.int64)
    for step in range(8, depth, 8):
        tied = np.zeros(len(out), bool)
        same = group[1:] == group[:-1]
        tied[1:] |= same
        tied[:-1] |= same
        todo = np.flatnonzero(tied)
        if not len(todo):
            break
        p = out[todo] + step
        key = np.where(p < len(word), word[np.minimum(p, len(word) - 1)], 0)
        order = np.lexsort((key, group[todo]))
        out[todo], key, own = out[todo][order], key[order], group[todo]
        # new groups keep their order: count the changes inside each old group
        change = np.zeros(len(out), np.int64)
        change[todo[1:]] = (own[1:] == own[:-1]) & (key[1:] != key[:-1])
        change[1:] += group[1:] != group[:-1]
        group = np.cumsum(change)
    return out


def suffix_array(x: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes of bytes ``x`` in the order of their first ``depth`` bytes, at least."""
    n = len(x)
    if not n:
        return np.zeros(0, np.int64)
    small = smaller_than_next(x)
    direct = sort_directly(np.flatnonzero(small), octets(x), depth)
    first = x[direct]
    edge = np.searchsorted(first, np.arange(257))
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    induced[x[-1]].append(np.array([n - 1]))
    out: list[np.ndarray] = []

    def induce(scanned: np.ndarray) -> None:
        before = scanned[scanned > 0] - 1
        before = before[~small[before]]
        c = x[before]
        order = np.argsort(c, kind="stable")
        before, c = before[order], c[order]
        for k in np.flatnonzero(np.bincount(c, minlength=256)).tolist():
            i, j = np.searchsorted(c, [k, k + 1])
            induced[k].append(before[i:j])

    for c in range(256):
        done = 0
        while done < len(induced[c]):       # suffixes of this bucket may induce more of it
            part = induced[c][done]
            done += 1
            out.append(part)
            induce(part)
        part = direct[edge[c]:edge[c + 1]]
        if len(part):
            out.append(part)
            induce(part)
    return np.concatenate(out)


def common_prefixes(x: np.ndarray, sa: np.ndarray, most: int) -> np.ndarray:
    """For each suffix but the first of ``sa``, the bytes it shares with the one before it, up to
    ``most``."""
    word = octets(x)
    shared = np.zeros(max(len(sa) - 1, 0), np.int64)
    room = len(x) - np.maximum(sa[1:], sa[:-1])
    todo = np.arange(len(shared))
    for step in range(0, most, 8):
        a, b = sa[todo] + step, sa[todo + 1] + step
        inside = np.maximum(a, b) < len(x)
        todo, a, b = todo[inside], a[inside], b[inside]
        xor = word[a] ^ word[b]
        shared[todo] += sum((xor >> np.uint64(8 * k)) == 0 for k in range(8))
        todo = todo[xor == 0]
    return np.minimum(np.minimum(shared, room), most)


def equal_windows(length: int):
    """``find`` of ``recurrence.verdicts`` for bytes."""

    def find(passages: list[bytes], n: np.ndarray) -> np.ndarray:
        x = np.frombuffer(bytes([BREAK]).join(passages), np.uint8)
        sa = suffix_array(x, length)
        cls = np.empty(len(x), np.int64)
        cls[sa] = np.concatenate([[0], np.cumsum(common_prefixes(x, sa, length) < length)])
        lens = np.fromiter(map(len, passages), np.int64, len(passages))
        begin = np.cumsum(lens + 1) - (lens + 1)
        within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        return cls[np.repeat(begin, n) + within]

    return find


def removed(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id",
            text_col: str = "text", carry: tuple[str, ...] = (), hot: int | None = None) -> DataFrame:
    """Query op6, one row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256;
    ``carry`` adds
    ``kept`` (the remaining bytes; a character of which only a part remains is left out) and ``rest``
    (a struct of these columns).  Null and empty texts have no bytes; rows that agree in id and
    text are one document and get the same figures; of documents that share an id, the one of
    the smaller hash comes first; a null id comes before all."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            data, off = utf8(column(b, "text"))
            ends = off[1:]
            hit = covered(b, ends, length)
            gone = sums(hit.astype(np.int64), ends)
            rest = data[~hit].tobytes()
            to = np.concatenate([[0], np.cumsum(np.diff(off) - gone)]).astype(np.int64).tolist()
            kept = [rest[i:j] for i, j in zip(to, to[1:])]
            out = {"doc_id": column(b, "doc_id"), "n_bytes": pa.array(np.diff(off)), "n_removed": pa.array(gone),
                   "n_spans": pa.array(runs(hit, ends)),
                   "kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in kept], pa.string())}
            if carry:
                out |= {"kept": pa.array([t.decode("utf-8", "ignore") for t in kept], pa.string()),
                        "rest": column(b, "rest")}
            yield pa.RecordBatch.from_pydict(out)

    marked = with_marks(docs, byte_units, length, gram, equal_windows(length), id_col, text_col, carry,
                        hot=hot)
    schema = StructType.fromDDL("doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    if carry:
        schema = schema.add("kept", "string").add(marked.schema["rest"])
    return marked.mapInArrow(cut, schema)


def rewrite(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` with what remains of their texts; nothing is dropped."""
    cut = removed(docs, id_col=id_col, text_col=text_col, carry=tuple(docs.columns), **options)
    return rewritten(docs, cut, id_col, text_col)
