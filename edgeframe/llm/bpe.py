"""Byte-level BPE: backtracking encoder and offset-table decoder.

The encoder cuts a text into pieces with the vocabulary's pattern and encodes each piece from
left to right.  At a position it takes the longest token that an Aho-Corasick automaton over the
vocabulary found there; a token may follow the one before it only if the pair is compatible,
that is, if merging the two tokens' bytes by rank would give back exactly these two tokens.  On a
clash it tries the next shorter token, and with none left it drops the last token and marks the
position as a dead end.  A position is marked once, so the work is linear in the piece, and the
one sequence whose neighbours are all compatible is the sequence that rank-ordered merging gives.

Decoding gathers token bytes through a table of offsets into one blob.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeframe.llm.textcol import column, slices, spans, sums, texts

#: fixed value: the byte-level pattern of the vocabulary's pre-tokenizer
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: distinct pieces whose ids a task keeps, and the longest of them (characters): at most some 200 MB,
#: whatever the texts hold; the memo is emptied when it is full, longer pieces are encoded each time
MEMO = 400_000
MEMO_PIECE = 64

#: bytes of text that a task encodes at a time
SLICE = 2 << 20


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable Latin-1
    characters stand for themselves, the other bytes in order for the characters from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Memo(dict):
    """Keeps what ``make`` gives for a key; starts anew when it holds MEMO keys, and does not keep
    strings above MEMO_PIECE."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        if isinstance(key, str) and len(key) > MEMO_PIECE:
            return self.make(key)
        if len(self) >= MEMO:
            self.clear()
        got = self[key] = self.make(key)
        return got


class Bpe:
    """The vocabulary of a tokenizers JSON file (byte-level, rank-ordered merges)."""

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        letters = byte_letters()
        as_bytes = lambda s: bytes(letters[c] for c in s)
        added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.ids = {as_bytes(s): i for s, i in spec["model"]["vocab"].items() if s not in added}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}    # pair: (rank, merged token)
        self.split: dict[int, tuple[int, int]] = {}               # token: the pair it came from
        for r, (a, b) in enumerate(pairs):
            a, b = as_bytes(a), as_bytes(b)
            pair, made = (self.ids[a], self.ids[b]), self.ids[a + b]
            self.rank.setdefault(pair, (r, made))
            self.split.setdefault(made, pair)
        # bytes are fed to the automaton as characters of the same number
        self.found = ahocorasick.Automaton()
        for b, i in self.ids.items():
            self.found.add_word(b.decode("latin-1"), i)
        self.found.make_automaton()
        # the longest token at a place: the automaton's trie says how far the text agrees with
        # any token, and each such agreement knows the longest whole token within it
        self.best: dict[str, int] = {}
        for b in sorted(self.ids, key=len):
            self.best[b.decode("latin-1")] = self.ids[b]
        for b in sorted(self.ids, key=len):
            s = b.decode("latin-1")
            for n in range(2, len(s)):
                self.best.setdefault(s[:n], self.best[s[:n - 1]])
        self.widest = max(map(len, self.ids))
        size = max([*self.ids.values(), *added.values()]) + 1
        raw = [b""] * size
        for b, i in self.ids.items():
            raw[i] = b
        for s, i in added.items():
            raw[i] = s.encode()
        self.blob, self.at, self.len = offsets(raw)
        self.digits = offsets([b"%d," % i for i in range(size)])
        self.size = self.len.tolist()
        self.shorter = self._prefixes(raw, size)
        self.special = regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True)))) \
            if added else None
        self.added = added
        self.pieces = regex.compile(PIECES)
        # the same pattern over characters up to U+00FF, where the three classes are short
        of = lambda p: "".join(re.escape(c) for c in map(chr, range(256)) if regex.match(p, c))
        kinds = {r"[^\s\p{L}\p{N}]": f"[{of(r'[^\s\p{L}\p{N}]')}]", r"\p{L}": f"[{of(r'\p{L}')}]",
                 r"\p{N}": f"[{of(r'\p{N}')}]", r"\s": f"[{of(r'\s')}]", r"\S": f"[{of(r'\S')}]"}
        self.latin = re.compile(regex.sub("|".join(map(regex.escape, kinds)), lambda m: kinds[m[0]], PIECES))
        self.fits = Memo(lambda ab: self._fits(*divmod(ab, size)))
        self.memo = Memo(
            lambda p: array("i", [self.added[p]] if p in self.added else self.encode_piece(p.encode())).tobytes())

    def _prefixes(self, raw: list[bytes], size: int) -> list[int]:
        """For each token, the next shorter token that it begins with (-1: none)."""
        out = [-1] * size
        for b, i in self.ids.items():
            for n in range(len(b) - 1, 0, -1):
                if b[:n] in self.ids:
                    out[i] = self.ids[b[:n]]
                    break
        return out

    def _fits(self, a: int, b: int) -> bool:
        """Whether ``a`` then ``b`` stays two tokens under rank-ordered merging: undo the merges
        of both from the latest backwards and see that no pair across the seam came earlier."""
        limit = 1 << 60
        while True:
            r = self.rank.get((a, b))
            if r is not None and r[0] < limit:
                return False
            sa, sb = self.split.get(a), self.split.get(b)
            ra = self.rank[sa][0] if sa else -1
            rb = self.rank[sb][0] if sb else -1
            if ra < 0 and rb < 0:
                return True
            # equal ranks: the left one merged first, so the right one is undone first
            if ra > rb:
                limit, a = ra, sa[1]
            else:       # at the same rank the pair across the seam, on the left, merges first
                limit, b = rb + 1, sb[0]

    def encode_piece(self, piece: bytes) -> list[int]:
        known = self.ids.get(piece)
        if known is not None:       # the longest token is the piece, with none before it
            return [known]
        letters, n = piece.decode("latin-1"), len(piece)
        size, shorter, fits, best, reach = self.size, self.shorter, self.fits, self.best, self.found.longest_prefix
        ids = len(size)
        dead: set[int] = set()
        out: list[int] = []
        pos, last = 0, -1
        token = best[letters[:reach(letters)]]
        while pos < n:
            end = pos + size[token]
            if end not in dead and (last < 0 or fits[last * ids + token]):
                out.append(token)
                pos, last = end, token
                if pos < n:
                    rest = letters[pos:pos + self.widest]
                    token = best[rest[:reach(rest)]]
            elif shorter[token] != -1:
                token = shorter[token]
            else:
                dead.add(pos)
                token = out.pop()
                pos -= size[token]
                last = out[-1] if out else -1
        return out

    def cut(self, text: str) -> list[str]:
        """The pieces of a text; an added token is a piece of its own."""
        out, begin = [], 0
        for m in (*self.special.finditer(text), None) if self.special else (None,):
            part = text[begin:m.start()] if m else text[begin:] if begin else text
            try:
                part.encode("latin-1")
                out += self.latin.findall(part)
            except UnicodeEncodeError:
                out += self.pieces.findall(part)
            if m:
                out.append(m[0])
                begin = m.end()
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, and the end of each text's ids."""
        cut = [self.cut(t) for t in texts]
        coded = pa.array(list(chain.from_iterable(cut)), pa.string()).dictionary_encode()
        known = [self.memo[p] for p in coded.dictionary.to_pylist()]
        at = coded.indices.to_numpy()
        lens = np.fromiter(map(len, known), np.int64, len(known)) >> 2
        first, n = (np.cumsum(lens) - lens)[at], lens[at]
        ids = np.frombuffer(b"".join(known), np.int32)[np.repeat(first, n) + spans(n)]
        ends = np.cumsum(np.fromiter(map(len, cut), np.int64, len(cut)))
        return ids, np.cumsum(sums(n, ends))

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the tokens."""
        return gathered(self.blob, self.at, self.len, ids)

    def decimals(self, ids: np.ndarray) -> bytes:
        """The ids in decimals, a comma after each."""
        return gathered(*self.digits, ids)


def gathered(blob: np.ndarray, at: np.ndarray, lens: np.ndarray, ids: np.ndarray) -> bytes:
    """The entries ``ids`` of a table of byte strings, end to end: entry i is lens[i] bytes of
    ``blob`` from at[i] on."""
    n = lens[ids]
    return blob[np.repeat(at[ids], n) + spans(n)].tobytes()


def offsets(entries: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lens = np.fromiter(map(len, entries), np.int64, len(entries))
    return np.frombuffer(b"".join(entries), np.uint8), np.cumsum(lens) - lens, lens


@lru_cache(1)
def vocabulary(path: str) -> Bpe:
    made = Bpe(path)
    gc.freeze()         # its tables live as long as the task's process: not to be walked again
    return made


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ``ids`` (the tokens of the whole text).  A null or empty text gives no tokens;
    repeated rows each get a row; other columns are not read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for b in slices(batches):
            ids, ends = bpe.encode([t.decode() for t in texts(b)])
            yield pa.RecordBatch.from_pydict({
                "doc_id": column(b, "doc_id"),
                "ids": pa.ListArray.from_arrays(np.r_[0, ends].astype(np.int32), pa.array(ids, pa.int32()))})

    return source(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and ``text`` of rows (doc_id, ids).  Null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for b in batches:
            got = [bpe.decode(np.array(x or [], np.int64)).decode("utf-8", "replace")
                   for x in column(b, "ids").to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": column(b, "doc_id"), "text": pa.array(got, pa.string())})

    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, text string")


def source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Query op7: encode, digest the ids, decode them again and digest the decoded text, one pass:
    doc_id, n_tokens, ids_sha256, decoded_sha256."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for b in slices(batches, most=SLICE):
            ids, ends = bpe.encode([t.decode() for t in texts(b)])
            first = np.r_[0, ends[:-1]].astype(np.int64)
            n = (ends - first).tolist()
            said = cut_up(bpe.decimals(ids), bpe.digits[2][ids], ends)
            text = cut_up(bpe.decode(ids), bpe.len[ids], ends)
            yield pa.RecordBatch.from_pydict({
                "doc_id": column(b, "doc_id"), "n_tokens": pa.array(n, pa.int64()),
                "ids_sha256": pa.array([hashlib.sha256(x[:-1]).hexdigest() for x in said], pa.string()),
                "decoded_sha256": pa.array([hashlib.sha256(x.decode("utf-8", "replace").encode()).hexdigest()
                                            for x in text], pa.string())})

    def cut_up(raw: bytes, lens: np.ndarray, ends: np.ndarray) -> list[bytes]:
        to = np.r_[0, np.cumsum(sums(lens, ends))].astype(np.int64).tolist()
        return [raw[i:j] for i, j in zip(to, to[1:])]

    return source(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
