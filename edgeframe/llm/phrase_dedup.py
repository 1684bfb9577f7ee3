"""Removal of repeated phrases with Aho-Corasick automata.

Every word covered by a window of ``length`` words that also starts earlier (in a document of a
smaller id, or further up in the same one) is removed.  ``recurrence`` brings the passages that
can recur together, sharded by anchor hash, and does not fold equal ones; each batch of a shard
confirms which windows recur, compiles them into one pyahocorasick automaton over word numbers,
and streams every passage through it to locate every occurrence (those of a batch that are equal
byte by byte once for all).  Windows whose anchor is hot are combined by their task before that:
the earliest one it saw is streamed for all.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from edgeframe.llm.recurrence import BASE, covered, mixed, rewritten, with_marks, word_units
from edgeframe.llm.textcol import column, slices, spans, sums, texts

LENGTH = 20
GRAM = 8
#: context bytes compiled into one automaton
BATCH_BYTES = 512 << 10


def window_hashes(word: np.ndarray, length: int) -> np.ndarray:
    """A hash of the ``length`` numbers from each place on (fewer places than numbers)."""
    with np.errstate(over="ignore"):
        h = np.zeros(len(word) - length + 1, np.uint64)
        for k in range(length):
            h = h * BASE + word[k:len(word) - length + 1 + k].astype(np.uint64) + np.uint64(1)
        return mixed(h)


def equal_windows(length: int):
    """``find`` of ``recurrence.verdicts`` for words."""

    def find(passages: list[bytes], n: np.ndarray) -> np.ndarray:
        # copies of a passage, byte by byte, are streamed once for all of them
        coded = pa.array(passages, pa.binary()).dictionary_encode()
        copy, row_n = coded.indices.to_numpy(), n
        _, first = np.unique(copy, return_index=True)
        n, copies = n[first], np.bincount(copy)
        cut = [p.split() for p in coded.dictionary.to_pylist()]
        lens = np.fromiter(map(len, cut), np.int64, len(cut))
        word = pa.array(list(itertools.chain.from_iterable(cut)), pa.binary()).dictionary_encode().indices.to_numpy()
        begin = np.cumsum(lens) - lens
        within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        start = np.repeat(begin, n) + within
        # phrases worth a place in the automaton: a window whose hash comes twice, once for each hash
        # and again for every window that has the hash and other words
        _, at, of = np.unique(window_hashes(word, length)[start], return_index=True, return_inverse=True)
        count = np.bincount(of, np.repeat(copies, n))
        same = np.ones(len(start), bool)
        for k in range(length):
            same &= word[start + k] == word[start[at[of]] + k]
        again = np.concatenate([start[at[count > 1]], start[~same]])
        found = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        numbers = word.tolist()
        for s in again.tolist():
            phrase = tuple(numbers[s:s + length])
            if not found.exists(phrase):
                found.add_word(phrase, len(found))
        cls = np.arange(len(start)) + len(found)        # a window of its own
        begin_cls = np.cumsum(n) - n
        rows = np.repeat(begin_cls[copy], row_n) + spans(row_n)
        if not len(found):
            return cls[rows]
        found.make_automaton()
        first = begin_cls.tolist()
        for k, (b, m, many) in enumerate(zip(begin.tolist(), lens.tolist(), n.tolist())):
            for end, phrase in found.iter(tuple(numbers[b:b + m])):
                s = end - length + 1
                if s < many:
                    cls[first[k] + s] = phrase
        return cls[rows]

    return find


def removed(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id",
            text_col: str = "text", carry: tuple[str, ...] = (), hot: int | None = None) -> DataFrame:
    """Query op10, one row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256 (the
    remaining words joined by one blank); ``carry`` adds ``kept`` and
    ``rest`` (a struct of these columns).  Null and
    empty texts have no words; rows that agree in id and text are one document and get the same
    figures; of documents that share an id, the one of the smaller hash comes first; a null id
    comes before all."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            words = [t.split() for t in texts(b)]
            n = np.fromiter(map(len, words), np.int64, len(words))
            ends = np.cumsum(n)
            hit = covered(b, ends, length)
            gone = sums(hit.astype(np.int64), ends)
            stay = (~hit).tolist()
            kept, at = [], 0
            for w, g in zip(words, gone.tolist()):
                kept.append(b" ".join(itertools.compress(w, stay[at:at + len(w)]) if g else w))
                at += len(w)
            out = {"doc_id": column(b, "doc_id"), "n_words": pa.array(n), "n_removed": pa.array(gone),
                   "kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in kept], pa.string())}
            if carry:
                out |= {"kept": pa.array([t.decode() for t in kept], pa.string()), "rest": column(b, "rest")}
            yield pa.RecordBatch.from_pydict(out)

    marked = with_marks(docs, word_units, length, gram, equal_windows(length), id_col, text_col, carry, BATCH_BYTES,
                        hot, fold=False)
    schema = StructType.fromDDL("doc_id long, n_words long, n_removed long, kept_sha256 string")
    if carry:
        schema = schema.add("kept", "string").add(marked.schema["rest"])
    return marked.mapInArrow(cut, schema)


def rewrite(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` with what remains of their texts; nothing is dropped."""
    cut = removed(docs, id_col=id_col, text_col=text_col, carry=tuple(docs.columns), **options)
    return rewritten(docs, cut, id_col, text_col)
