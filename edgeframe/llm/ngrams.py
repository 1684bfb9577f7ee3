"""Hashed character n-grams of many words at once, and the folds of held-out rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from edgeframe.llm.recurrence import BASE, BYTE_VALUES, mixed


def hashed_ngrams(words: list[bytes], sizes: tuple[int, ...], dims: int, whole: bool = False
                  ) -> tuple[np.ndarray, np.ndarray]:
    """(number of features of each word, their hash classes below ``dims`` word by word): the byte
    n-grams of ``<word>``, and with ``whole`` the word itself."""
    raw = np.frombuffer(b"".join([b"<%b>" % w for w in words]), np.uint8)
    lens = np.fromiter(map(len, words), np.int64, len(words)) + 2
    begin = np.cumsum(lens) - lens
    word_of = np.repeat(np.arange(len(words)), lens)
    left = np.repeat(lens, lens) - (np.arange(len(raw)) - np.repeat(begin, lens))   # bytes up to the word's end
    values = BYTE_VALUES[raw]
    owner, classes = [], []
    with np.errstate(over="ignore"):
        for n in sizes:
            if len(raw) < n:
                continue
            h = np.zeros(len(raw) - n + 1, np.uint64)
            for k in range(n):
                h = h * BASE + values[k:len(raw) - n + 1 + k]
            ok = np.flatnonzero(left[:len(h)] >= n)
            owner.append(word_of[ok])
            classes.append(mixed(h[ok] + np.uint64(n)))
        if whole and len(words):
            place = np.arange(len(raw)).astype(np.uint64)
            own = mixed(values + mixed((place - np.repeat(begin, lens).astype(np.uint64)) * BASE))
            owner.append(np.arange(len(words)))
            classes.append(mixed(np.add.reduceat(own, begin) * BASE))
    if not owner:
        return np.zeros(len(words), np.int64), np.zeros(0, np.int64)
    owner, classes = np.concatenate(owner), np.concatenate(classes)
    order = np.argsort(owner, kind="stable")
    return (np.bincount(owner, minlength=len(words)),
            (classes[order] >> np.uint64(20)).astype(np.int64) % dims)


def fold(mod: int, id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``mod`` (a null id counts as an empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % mod
