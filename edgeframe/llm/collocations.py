"""Collocation mining by marginalising the highest order.

A text is cut into pieces and those into words.  For every word the lead columns hold the words
that follow it in its piece, padded with '' beyond the end, up to the longest phrase: one window
per word, and no other n-gram is ever made.  Every occurrence of a shorter phrase is the
beginning of exactly one window, so a ROLLUP over the window columns sums the frequency of all
shorter ones.  A phrase's parts and its longer phrases are at least as frequent as asked, so only
frequent ones are kept after that.

The windows of a slice of texts are made and counted column by column (Arrow and numpy) before
they are shuffled; the frequent phrases meet their parts in plain joins.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add, and_
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edgeframe.llm.textcol import column, slices, utf8, written

LONGEST = 3
LEAST = 10
SHARE = 50
TOP = 2000
SLICE_BYTES = 8 << 20

#: A-Z become a-z; every other byte stays
LOWER = np.array([c + 32 if 0x41 <= c <= 0x5A else c for c in range(256)], np.uint8)
#: 1: blank between words, 2: end of a piece
KIND = np.array([1 if c in b" \t" else 2 if c in b".,;:!?\n\x0b\x0c\r" else 0 for c in range(256)], np.uint8)


def word_columns(col: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(words, piece of each word, text of each word); pieces do not cross texts."""
    data, off = utf8(col)
    kind = KIND[data]
    inside = kind == 0
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True                                    # texts begin and end here
    out = np.concatenate([[False], inside, [False]])
    starts = np.flatnonzero(inside & (~out[:-2] | edge[:-1]))
    ends = np.flatnonzero(inside & (~out[2:] | edge[1:])) + 1
    lens = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(lens), pa.py_buffer(LOWER[data[inside]])])
    text = np.searchsorted(off, starts, "right") - 1
    return words, np.cumsum(kind == 2)[starts] + text if len(starts) else text, text


def coded_words(b: pa.RecordBatch) -> tuple[pa.Array, np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """(vocabulary in byte order after '', place in it, languages, language, piece) of all words."""
    words, piece, text = word_columns(column(b, "text"))
    coded = words.dictionary_encode()
    order = pc.sort_indices(coded.dictionary)
    vocabulary = pa.concat_arrays([pa.array([b""], pa.large_binary()), coded.dictionary.take(order)]).cast(pa.large_string())
    place = np.empty(len(order), np.int64)
    place[order.to_numpy()] = np.arange(1, len(order) + 1)
    langs = column(b, "lang").dictionary_encode()
    code = place[coded.indices.to_numpy()] if len(words) else np.zeros(0, np.int64)
    return vocabulary, code, langs.dictionary, langs.indices.to_numpy()[text].astype(np.int64), piece


def windows(b: pa.RecordBatch, longest: int, hot: frozenset = frozenset(), salts: int = 1) -> pa.RecordBatch:
    """(lang, w1, salt, packed): the padded windows of a slice of texts, counted.  ``packed`` has a
    line for each window of a first word: its other words and its count, parted by tabs, which no
    word holds.  Windows that begin with a hot (lang, word) are dealt by their second word."""
    vocabulary, code, langs, lang, piece = coded_words(b)
    lead = [lang]
    for k in range(longest):
        same = np.zeros(len(code), bool)
        rest = max(0, len(code) - k)
        same[:rest] = piece[len(code) - rest:] == piece[:rest]
        lead.append(np.where(same, np.roll(code, -k), 0))
    base = len(vocabulary)
    if len(langs) * base ** longest < 1 << 63:              # one number per window
        key = lead[0]
        for c in lead[1:]:
            key = key * base + c
        at = np.argsort(key, kind="stable")
        new = np.diff(key[at], prepend=-1) != 0
    else:
        at = np.lexsort(lead[::-1])
        new = np.any([np.diff(c[at], prepend=-1) != 0 for c in lead], axis=0)
    first = np.flatnonzero(new)
    n = np.diff(np.concatenate([first, [len(at)]]))
    lead = [c[at[first]] for c in lead]
    salt = np.zeros(len(first), np.int64)
    if hot:
        number = {w: i for i, w in enumerate(vocabulary.to_pylist())}
        hot_at = {(i, number[w]) for i, x in enumerate(langs.to_pylist()) for y, w in hot if x == y and w in number}
        of = np.fromiter((1 + crc32(w.encode()) % salts for w in number), np.int64, base)
        for i, c in hot_at:
            mine = (lead[0] == i) & (lead[1] == c)
            salt[mine] = of[lead[2][mine]]
    again = np.lexsort((salt, lead[1], lead[0]))            # stable: lines stay in order
    lead, n, salt = [c[again] for c in lead], n[again], salt[again]
    group = np.flatnonzero(np.any([np.diff(c, prepend=-1) != 0 for c in (lead[0], lead[1], salt)], axis=0))
    word = lambda c: vocabulary.take(pa.array(c))
    lines = pc.binary_join_element_wise(*map(word, lead[2:]), pa.array(n).cast(pa.large_string()), pa.scalar("\t", pa.large_string()))
    packed = pa.LargeListArray.from_arrays(pa.array(np.concatenate([group, [len(n)]]), pa.int64()), lines)
    return pa.RecordBatch.from_pydict({
        "lang": langs.cast(pa.string()).take(pa.array(lead[0][group])), "w1": word(lead[1][group]).cast(pa.string()),
        "salt": pa.array(salt[group], pa.int32()),
        "packed": pc.binary_join(packed, pa.scalar("\n", pa.large_string())).cast(pa.string())})


def hot_words(source: DataFrame, share: float) -> frozenset:
    """The (lang, word) that are more than about ``share`` of all words: fewer than 3 / share, as words take
    two characters with their blank, and six are counted for one."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, most=SLICE_BYTES):
            vocabulary, code, langs, lang, _ = coded_words(b)
            n = np.bincount(lang * len(vocabulary) + code, minlength=1)
            often = np.flatnonzero(n * 2 > share * len(code))
            yield pa.RecordBatch.from_pydict({
                "lang": langs.cast(pa.string()).take(pa.array(often // len(vocabulary))),
                "word": vocabulary.take(pa.array(often % len(vocabulary))).cast(pa.string()),
                "n": pa.array(n[often], pa.int64()), "every": pa.array(np.full(len(often), len(code)), pa.int64())})

    found = source.mapInArrow(count, "lang string, word string, n long, every long") \
        .groupBy("lang", "word").agg(F.sum("n").alias("n"))
    every = source.select(F.sum(F.length("text")).alias("c")).first()["c"] or 0
    return frozenset((r["lang"], r["word"]) for r in found.where(F.col("n") * 6 > share * every).collect())


def frequencies(docs: DataFrame, longest: int, least: int, text_col: str, lang_col: str) -> DataFrame:
    """Written (lang, k, phrase, f): phrases of 1 to ``longest`` words found ``least`` times or
    more, and as k = 0 the number of all words of a language.

    Windows are shuffled once, by language and first word (hot ones by second word too).  There a
    window found too rarely is put to the rest of its head, the window without its last word,
    and a head found too rarely to the rest of its own: neither can be a phrase of its length, and the
    ROLLUP, which sums them to all that is shorter, gets few rows."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    source = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                         F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    hot = hot_words(source, 1 / (4 * parts))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, most=SLICE_BYTES):
            yield windows(b, longest, hot, parts)

    line = F.explode(F.split("packed", "\n")).alias("line")
    top = source.mapInArrow(count, "lang string, w1 string, salt int, packed string") \
        .repartition(parts, "lang", "w1", "salt").select("lang", "w1", "salt", line) \
        .groupBy("lang", "w1", "salt", F.substring_index("line", "\t", longest - 1).alias("tail")) \
        .agg(F.sum(F.substring_index("line", "\t", -1).cast("long")).alias("n"))
    # in one pass: every window counts for its head, and one that is not rare stands for itself too
    rare = F.col("n") < least
    roles = F.when(rare, F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True)))
    whole = F.col("whole")
    both = top.withColumn("whole", F.explode(roles)) \
        .groupBy("lang", "w1", "salt", "whole",
                 F.when(whole, F.col("tail")).otherwise(F.substring_index("tail", "\t", longest - 2)).alias("others")) \
        .agg(F.sum("n").alias("all"), F.sum(F.when(whole | rare, F.col("n")).otherwise(0)).alias("n")).where("n > 0")
    cols = [f"w{k}" for k in range(1, longest + 1)]
    others = F.split("others", "\t")
    own = [F.get(others, F.lit(i)) for i in range(longest - 1)]
    own[-1] = F.when(whole, own[-1]).otherwise("")
    if longest > 2:
        own[-2] = F.when(~whole & (F.col("all") < least), "").otherwise(own[-2])
    kept = both.select("lang", "w1", *[c.alias(x) for c, x in zip(own, cols[1:])], "n")
    # how many words of the window a sum keeps
    level = reduce(add, [F.when(F.grouping(c) == 0, 1).otherwise(0) for c in cols])
    sums = kept.rollup("lang", *cols).agg(F.sum("n").alias("f"), level.alias("k"), F.grouping("lang").alias("every"))
    # a prefix that holds padding or a rest is no phrase
    real = reduce(and_, [F.coalesce(F.col(c) != "", F.lit(True)) for c in cols])
    return written(sums.where((F.col("every") == 0) & ((F.col("k") == 0) | (F.col("f") >= least) & real))
                   .select("lang", "k", F.concat_ws(" ", *cols).alias("phrase"), "f"), "phrases")


def part(words: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def association(a: Column, left: Column, right: Column) -> Column:
    """floor(10**6 * a * a / (left * right)), exactly."""
    whole = lambda c: c.cast("decimal(18,0)")
    return F.call_function("div", whole(a) * whole(a) * F.lit(1_000_000).cast("decimal(7,0)"), whole(left) * whole(right))


def scored(phrases: DataFrame) -> DataFrame:
    """(lang, k, phrase, a, l, r, score) of the phrases of two words or more: the weakest cut."""
    f = phrases.where("k > 0").select("lang", "phrase", "f")
    words = F.split("phrase", " ")
    cuts = phrases.where("k > 1").select("lang", "k", "phrase", F.col("f").alias("a"), words.alias("words"),
                                         F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")) \
        .select("lang", "k", "phrase", "a", "cut", part(F.col("words"), F.lit(1), F.col("cut")).alias("first"),
                part(F.col("words"), F.col("cut") + 1, F.col("k") - F.col("cut")).alias("rest"))
    left = f.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = f.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    both = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]) \
        .withColumn("score", association(F.col("a"), F.col("l"), F.col("r")))
    weakest = F.min(F.struct("score", "cut", "l", "r")).alias("m")
    return both.groupBy("lang", "k", "phrase", "a").agg(weakest) \
        .select("lang", "k", "phrase", "a", "m.l", "m.r", "m.score")


def uncovered(phrases: DataFrame, found: DataFrame, longest: int, share: int) -> DataFrame:
    """``found`` without the phrases that stand inside a longer one with ``share`` percent of their
    frequency or more."""
    words = F.split("phrase", " ")
    inside = [(length, k, start) for k in range(3, longest + 1) for length in range(2, k) for start in range(1, k - length + 2)]
    if not inside:
        return found
    at = F.array(*[F.struct(F.lit(x).alias("length"), F.lit(k).alias("k"), F.lit(s).alias("start")) for x, k, s in inside])
    longer = phrases.where("k > 2").select("lang", "k", "f", words.alias("words"), F.explode(at).alias("at")) \
        .where("at.k = k").select("lang", part(F.col("words"), F.col("at.start"), F.col("at.length")).alias("phrase"), "f") \
        .groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    return found.join(longer, ["lang", "phrase"], "left") \
        .where(F.col("most").isNull() | (100 * F.col("most") < share * F.col("a"))).drop("most")


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, share: int = SHARE, top: int = TOP,
                 text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Query op13: per language the first ``top`` phrases: lang, rank, phrase, a, l, r, n, score.

    Null texts are empty, a null language is ``und``; repeated rows count again; an empty table
    gives no rows.  Order: score, then a, both falling, then the phrase by its bytes; phrases are
    distinct, so there are no ties.  Other columns are not read."""
    phrases = frequencies(docs, longest, least, text_col, lang_col)
    found = uncovered(phrases, scored(phrases), longest, share)
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = found.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(parts)))
    # a language's phrases are ranked in salted groups first: one task gets parts * top rows at most
    for keys in (["lang", "salt"], ["lang"]):
        salted = salted.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= top)
    words = phrases.where("k = 0").select("lang", F.col("f").alias("n"))
    return salted.join(words, "lang").select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")
