"""Quality rules with tokeniser fertility.

Base rules on words (runs of anything but ASCII white space): too few words, too many words in
repeated 5-word windows.  The method: public vocabularies encode the words of a document, each
word with a blank before it, and give per document

* characters per token of each vocabulary (low: the text is not what the vocabulary knows),
* the byte-fallback share (tokens that are single bytes because no piece fits),
* the entropy of the document's tokens, block by block, as a share of the most that as many tokens
  can have.

A document is rejected where a measure leaves the band of its language.  Bands come from all
documents: per language (or, without one, the script of most letters) the quartiles, widened by
``fences`` times their distance.  Where a language has a tight band, ``floor`` keeps it from
cutting normal variation.  A document's measures of few words vary, so the distance from the
middle is scaled by sqrt(n / (n + ``steady``)) before it is held against the band.
"""

from __future__ import annotations

import base64
import itertools
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeframe.llm.bpe import PIECES
from edgeframe.llm.textcol import column, slices, spans, sums, texts, written
from edgeframe.operators.common import bounded_broadcast

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 10
REPEAT_WINDOW = 5
REPEAT_PERCENT = 20

#: tokens of an entropy block: all blocks count, the last may be shorter
ENTROPY_BLOCK = 512
FENCES = 3.0
#: how much wider a two-sided band is above: there a text is only better known to the vocabulary than
#: others, until it is rulers and runs of one character
HIGH = 2.0
STEADY = 100
#: measure: (side that is rejected, least half-width of the band)
MEASURES = {"cpt_byte": ("both", 0.1), "cpt_piece": ("both", 0.1), "fallback_share": ("high", 0.05),
            "entropy_share": ("low", 0.15)}

#: fixed values: first and last code point of the scripts that are told apart
SCRIPTS = {"latin": (0x41, 0x24F), "greek": (0x370, 0x3FF), "cyrillic": (0x400, 0x52F),
           "hebrew": (0x590, 0x5FF), "arabic": (0x600, 0x6FF), "devanagari": (0x900, 0x97F),
           "kana": (0x3040, 0x30FF), "han": (0x4E00, 0x9FFF), "hangul": (0xAC00, 0xD7AF)}

RAW = ("doc_id long, lang string, script string, n_words long, word_chars long, n_symbols long, "
       "n_dup_lines long, n_repeat_words long, cpt_byte double, cpt_piece double, "
       "fallback_share double, entropy_share double")


@lru_cache(2)
def byte_vocabulary(path: str) -> tiktoken.Encoding:
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("words", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})


@lru_cache(2)
def piece_vocabulary(path: str) -> tuple[sentencepiece.SentencePieceProcessor, np.ndarray]:
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return sp, np.array([sp.IsByte(i) or sp.IsUnknown(i) for i in range(sp.GetPieceSize())])


def script_of(text: str) -> str:
    """The script of most letters, of a document without a language (null: no letter)."""
    at = np.array([ord(c) for c in text if c.isalpha()])
    n = {s: int(((at >= a) & (at <= z)).sum()) for s, (a, z) in SCRIPTS.items()} if len(at) else {}
    n["other"] = len(at) - sum(n.values())
    best = max(n, key=n.get)
    return best if n[best] else "none"


def repeat_words(word: np.ndarray, ends: np.ndarray, window: int = REPEAT_WINDOW) -> np.ndarray:
    """Per document the words inside ``window``-word windows found twice or more in it."""
    n = len(word)
    if n < window:
        return np.zeros(len(ends), np.int64)
    doc = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    starts = np.flatnonzero(doc[:n - window + 1] == doc[window - 1:])
    # windows get exact numbers two words at a time: the number of a pair of numbers
    code = doc[starts]
    for k in range(window):
        _, code = np.unique(code * (int(word.max()) + 1) + word[starts + k], return_inverse=True)
    again = starts[np.bincount(code)[code] > 1] if len(starts) else starts
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, again, 1)
    np.add.at(change, again + window, -1)
    return sums((np.cumsum(change[:-1]) > 0).astype(np.int64), ends)


def dup_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return len(lines) - len(set(lines))


def entropy_share(lens: np.ndarray, token: np.ndarray, block: int = ENTROPY_BLOCK) -> np.ndarray:
    """Per document of ``lens`` tokens the entropy of its blocks of ``block`` tokens, each over log2 of
    the block's tokens (1: below two), in the mean over tokens: it does not fall with the length."""
    parts = -(-lens // block)
    part = np.repeat(np.cumsum(parts) - parts, lens) + spans(lens) // block
    pair, n = np.unique(part * (int(token.max(initial=0)) + 1) + token, return_counts=True)
    of, many = pair // (int(token.max(initial=0)) + 1), int(parts.sum())
    total = np.bincount(of, n, many)
    nlogn = np.bincount(of, n * np.log2(n), many)
    with np.errstate(divide="ignore", invalid="ignore"):
        share = np.where(total < 2, 1.0, (np.log2(total) - nlogn / total) / np.log2(total))
    return sums(share * total, np.cumsum(parts)) / np.maximum(lens, 1)


def measures(docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id",
             text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The base figures and the fertility measures, one row per row of ``docs``.  A text without
    words (null or empty) has zeros and null measures; a null id is kept; repeated rows are measured
    row by row; a very long text is measured whole, its entropy in blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, (sp, is_byte) = byte_vocabulary(byte_path), piece_vocabulary(piece_path)
        for b in slices(batches):
            raw = texts(b)
            cut = [t.split() for t in raw]
            n = np.fromiter(map(len, cut), np.int64, len(cut))
            ends = np.cumsum(n)
            coded = pa.array(list(itertools.chain.from_iterable(cut)), pa.binary()).dictionary_encode()
            word = coded.indices.to_numpy().astype(np.int64)
            distinct = [w.decode() for w in coded.dictionary.to_pylist()]
            chars = np.fromiter(map(len, distinct), np.int64, len(distinct))
            spaced = [" " + w for w in distinct]
            n_byte = np.fromiter(map(len, map(bpe.encode_ordinary, spaced)), np.int64, len(distinct))
            ids = sp.encode(distinct, num_threads=1) if distinct else []
            n_piece = np.fromiter(map(len, ids), np.int64, len(distinct))
            flat = np.fromiter(itertools.chain.from_iterable(ids), np.int64, int(n_piece.sum()))
            n_fall = sums(is_byte[flat].astype(np.int64), np.cumsum(n_piece))
            lens = n_piece[word]
            token = flat[np.repeat((np.cumsum(n_piece) - n_piece)[word], lens) + spans(lens)]
            word_chars, pieces = sums(chars[word], ends), sums(lens, ends)
            none = n == 0
            with np.errstate(divide="ignore", invalid="ignore"):
                given = {"cpt_byte": word_chars / sums(n_byte[word], ends), "cpt_piece": word_chars / pieces,
                         "fallback_share": sums(n_fall[word], ends) / pieces,
                         "entropy_share": entropy_share(pieces, token)}
            langs = column(b, "lang").to_pylist()
            yield pa.RecordBatch.from_pydict({
                "doc_id": column(b, "doc_id"), "lang": pa.array(langs, pa.string()),
                "script": pa.array([script_of(t.decode()) if x is None else None for x, t in zip(langs, raw)], pa.string()),
                "n_words": pa.array(n), "word_chars": pa.array(word_chars),
                "n_symbols": pa.array([len(t) - len(t.translate(None, SYMBOLS)) for t in raw], pa.int64()),
                "n_dup_lines": pa.array(list(map(dup_lines, raw)), pa.int64()),
                "n_repeat_words": pa.array(repeat_words(word, ends)),
                **{k: pa.array(v, pa.float64(), mask=none) for k, v in given.items()}})

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.col(lang_col).cast("string").alias("lang")).mapInArrow(run, RAW)


def bands(measured: DataFrame, fences: float = FENCES) -> DataFrame:
    """One row per language or script: ``grp`` and per measure the band's middle and half width.  A
    quartile is a value that occurs, the smaller one on ties."""
    at = [F.percentile_approx(m, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 10_000).alias(m) for m in MEASURES]
    q = measured.groupBy(group().alias("grp")).agg(*at)
    ends = []
    for m, (_, floor) in MEASURES.items():
        half = F.greatest(fences * (F.col(m)[2] - F.col(m)[0]), F.lit(floor))
        ends += [F.col(m)[1].alias(f"{m}_mid"), half.alias(f"{m}_half")]
    return q.select("grp", *ends)


def group():
    return F.coalesce(F.concat(F.lit("lang:"), "lang"), F.concat(F.lit("script:"), "script"))


def judged(docs: DataFrame, byte_path: str, piece_path: str, fences: float = FENCES, steady: float = STEADY,
           id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Query op2: the base figures, base_failed and kept, then the measures and ``reason`` (the
    measure that left its band, null where none did).  Texts are tokenised once; the figures are
    written and read for the bands and for the verdict."""
    seen = written(measures(docs, byte_path, piece_path, id_col, text_col, lang_col), "fertility")
    of, _ = bounded_broadcast(written(bands(seen, fences), "bands"))     # a language may hold most rows
    row = seen.withColumn("grp", group()).join(of, "grp", "left")
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    scale = F.sqrt(F.col("n_words") / (F.col("n_words") + F.lit(steady)))
    reason = F.lit(None).cast("string")
    for m, (side, _) in MEASURES.items():
        off = (F.col(m) - F.col(f"{m}_mid")) * scale
        out = {"both": F.greatest(-off, off / HIGH), "high": off, "low": -off}[side] > F.col(f"{m}_half")
        reason = F.when(out, F.lit(m)).otherwise(reason)
    return row.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      base.alias("base_failed"), (~base & reason.isNull()).alias("kept"),
                      *MEASURES, reason.alias("reason"))


def keep(docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text",
         lang_col: str = "lang", **options) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns as they were.  Rows are judged by a tag of
    what the verdict depends on, so rows that share an id are judged one by one."""
    tag = F.xxhash64(F.col(id_col).cast("long"), F.coalesce(F.col(text_col).cast("string"), F.lit("")),
                     F.col(lang_col).cast("string"))
    seen = judged(docs.select(tag.alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")),
                  byte_path, piece_path, **options)
    bad = seen.where(~F.col("kept")).select(F.col("doc_id").alias("tag")).distinct()
    return docs.select(tag.alias("tag"), F.struct("*").alias("row")).join(bad, "tag", "left_anti").select("row.*")
