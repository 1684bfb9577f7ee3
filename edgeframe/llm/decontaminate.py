"""Benchmark decontamination with a distributed positional inverted index.

The training documents are packed into shards of a few MB; each shard is one row of a written
index table that holds, for every term of the shard, the sorted positions at which it occurs.
Benchmark phrases are probed block by block against all shards: a phrase starts from its rarest
term in the shard, and the offset-adjusted posting lists of its other terms are intersected in
order of length.  No document text is shuffled; a shard is the unit of work, so a hot source or
a passage that many documents share only lengthens posting lists.

Words: A-Z lower-cased, runs of ``0-9``, ``a-z`` and non-ASCII characters.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeframe.llm.textcol import column, slices, sums, texts, written

WINDOW = 10
#: benchmark words per query block: the bound of what is broadcast at once
BLOCK_WORDS = 200_000
SHARD_BYTES = 4 << 20

#: every byte of a separator becomes a blank, A-Z become a-z; bytes of non-ASCII characters stay
FOLD = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c > 0x7F
             else 0x20 for c in range(256))

INDEX = ("shard long, doc_ids array<long>, n_words array<int>, terms binary, lens binary, "
         "postings binary")


def words(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write the positional index of all documents; returns the table, one row per shard.

    Positions count the words of a shard end to end with one free position after every
    document, so no phrase crosses documents.  Postings are delta-coded per term.  A null text
    has no words; a null id is kept; other columns are not read."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = (TaskContext.get().partitionId() << 32) - 1
        for b in slices(batches, "text", shard_bytes):
            shard += 1
            tokens = [words(t) for t in texts(b)]
            n = np.fromiter(map(len, tokens), np.int64, len(tokens))
            coded = pa.array(list(itertools.chain.from_iterable(tokens)), pa.binary()).dictionary_encode()
            term = coded.indices.to_numpy()
            at = spans_with_gap(n)
            order = np.argsort(term, kind="stable")
            lens = np.bincount(term, minlength=len(coded.dictionary)).astype(np.uint32)
            posts = at[order]
            delta = np.diff(posts, prepend=0)
            first = np.cumsum(lens) - lens
            delta[first] = posts[first]
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([shard], pa.int64()),
                "doc_ids": pa.array([column(b, "doc_id").to_pylist()], pa.list_(pa.int64())),
                "n_words": pa.array([n.astype(np.int32)], pa.list_(pa.int32())),
                "terms": pa.array([b" ".join(coded.dictionary.to_pylist())], pa.binary()),
                "lens": pa.array([lens.tobytes()], pa.binary()),
                "postings": pa.array([delta.astype(np.uint32).tobytes()], pa.binary())})

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                         F.col(text_col).cast("string").alias("text"))
    return written(source.mapInArrow(index, INDEX), "postings")


def spans_with_gap(n: np.ndarray) -> np.ndarray:
    """Positions of documents of ``n`` words: each is followed by a position without a word."""
    return np.arange(int(n.sum())) + np.repeat(np.arange(len(n)), n)


def query_blocks(items: DataFrame, item_col: str, text_col: str, window: int,
                 block_words: int) -> Iterator[dict]:
    """The phrases of the query items in blocks of at most about ``block_words`` words: an
    item's runs of ``window`` words, or the whole item where it has fewer.  Equal phrases are
    probed once and carry all their items."""
    rows = items.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    phrases: dict[tuple, set] = {}
    held = blocks = 0
    for r in rows.toLocalIterator():
        w = words(r["text"].encode())
        for i in range(0, len(w), 4096):        # a very long item is dealt over several blocks
            part = w[i:i + 4096 + window - 1]
            if i and len(part) < window:
                continue
            for p in [part] if len(part) < window else zip(*(part[k:] for k in range(window))):
                phrases.setdefault(tuple(p), set()).add(r["item"])
            held += len(part)
            if held >= block_words:
                yield coded_block(phrases)
                phrases, held, blocks = {}, 0, blocks + 1
    if phrases or not blocks:       # at least one block, even of no phrases: it reports every document
        yield coded_block(phrases)


def coded_block(phrases: dict[tuple, set]) -> dict:
    """Phrases as rows of vocabulary numbers (-1 beyond the end), with their items."""
    vocab: dict[bytes, int] = {}
    width = max(map(len, phrases), default=1)
    rows = np.full((len(phrases), width), -1, np.int32)
    for k, p in enumerate(phrases):
        rows[k, :len(p)] = [vocab.setdefault(t, len(vocab)) for t in p]
    return {"terms": rows, "vocab": list(vocab), "items": [sorted(s) for s in phrases.values()]}


def intersect(lists: list[np.ndarray], slop: int = 0, low: np.ndarray | None = None,
              high: np.ndarray | None = None) -> np.ndarray:
    """Starts of a phrase whose k-th term has the sorted positions ``lists[k]``.

    From the rarest term outwards, a start survives if every other term stands at its own
    offset from it, give or take ``slop`` positions.  ``low`` and ``high`` (needed where slop
    > 0) give the first position and the end of the document of each position."""
    order = np.argsort([len(x) for x in lists], kind="stable")
    start = lists[order[0]] - order[0]
    if slop:
        home = lists[order[0]]
        lo, hi = low[home], high[home]
    for k in order[1:]:
        if not len(start):
            break
        want = start + k
        if slop:
            at = np.searchsorted(lists[k], np.maximum(want - slop, lo))
            found = lists[k][np.minimum(at, len(lists[k]) - 1)]
            ok = (at < len(lists[k])) & (found <= np.minimum(want + slop, hi - 1))
            start, lo, hi = start[ok], lo[ok], hi[ok]
        else:
            at = np.minimum(np.searchsorted(lists[k], want), len(lists[k]) - 1)
            start = start[lists[k][at] == want]
    return np.maximum(start, lo) if slop else start


def probe(index: DataFrame, block: dict, every_doc: bool, slop: int = 0) -> DataFrame:
    """Matches of one block: (shard, ord, doc_id, n_words, starts, ends, items) per document with
    a match, or of all documents; starts and ends are the merged hit word ranges."""
    shared = index.sparkSession.sparkContext.broadcast(block)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = shared.value
        vocab = pa.array([*q["vocab"], b""], pa.binary())       # the last stands for no term
        width = (q["terms"] >= 0).sum(1)
        for row in (r for b in batches for i in range(b.num_rows) for r in b.slice(i, 1).to_pylist()):
            n = np.array(row["n_words"], np.int64)
            first = np.cumsum(n + 1) - (n + 1)
            lens = np.frombuffer(row["lens"], np.uint32).astype(np.int64)
            ends = np.cumsum(lens)
            own = pc.index_in(vocab, pa.array(row["terms"].split(), pa.binary())).to_numpy(False)
            own = np.nan_to_num(own.astype(np.float64), nan=-1).astype(np.int64)
            have = np.where(own >= 0, lens[own] if len(lens) else 0, 0)
            live = np.flatnonzero(((have[q["terms"]] > 0) | (q["terms"] < 0)).all(1))
            deltas = np.frombuffer(row["postings"], np.uint32)
            cache: dict[int, np.ndarray] = {}

            def postings(t: int) -> np.ndarray:
                if t not in cache:
                    cache[t] = np.cumsum(deltas[ends[t] - lens[t]:ends[t]], dtype=np.int64)
                return cache[t]

            bound = (np.repeat(first, n + 1), np.repeat(first + n, n + 1)) if slop else (None, None)
            change = np.zeros(int((n + 1).sum()) + 1, np.int32)
            items: dict[int, set] = {}
            for k in live.tolist():
                w = int(width[k])
                starts = intersect([postings(t) for t in own[q["terms"][k, :w]].tolist()], slop, *bound)
                if not len(starts):
                    continue
                base = np.searchsorted(first, starts, "right") - 1
                np.add.at(change, starts, 1)
                np.add.at(change, np.minimum(starts + w, (first + n)[base]), -1)
                for d in np.unique(base).tolist():
                    items.setdefault(d, set()).update(q["items"][k])
            hit = np.concatenate([[0], (np.cumsum(change[:-1]) > 0).astype(np.int8), [0]])
            edge = np.diff(hit)
            s, e = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            out = list(range(len(n))) if every_doc else sorted(items)
            a = np.searchsorted(s, first[out], "left")
            z = np.searchsorted(s, (first + n + 1)[out], "left")
            ids = row["doc_ids"]
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([row["shard"]] * len(out), pa.int64()),
                "ord": pa.array(out, pa.int32()),
                "doc_id": pa.array([ids[d] for d in out], pa.int64()),
                "n_words": pa.array(n[out], pa.int64()),
                "starts": pa.array([s[i:j] - first[d] for d, i, j in zip(out, a, z)], pa.list_(pa.int64())),
                "ends": pa.array([np.minimum(e[i:j] - first[d], n[d]) for d, i, j in zip(out, a, z)],
                                 pa.list_(pa.int64())),
                "items": pa.array([sorted(items.get(d, ())) for d in out], pa.list_(pa.string()))})

    return index.mapInArrow(match, "shard long, ord int, doc_id long, n_words long, starts array<long>, "
                                   "ends array<long>, items array<string>")


def find_phrases(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                 slop: int = 0, block_words: int = BLOCK_WORDS, index: DataFrame | None = None) -> DataFrame:
    """Per document row: doc_id, n_words, ``spans`` (disjoint hit word ranges [start, end)) and
    ``items`` (ids of the items with a window in it, as strings, sorted).

    ``slop`` 0 finds exact phrases; above, each term may stand that many words off its place
    (proximity), and a span is the phrase's nominal range.  Null or empty texts give 0 words
    and no items; repeated rows each get their own row; equal items count once per id."""
    index = build_index(docs, id_col, text_col) if index is None else index
    blocks = query_blocks(items, item_col, item_text_col, window, block_words)
    found = [probe(index, next(blocks), every_doc=True, slop=slop)]
    for block in blocks:    # each block's matches are written, once, so the driver holds one block at a time
        if len(found) == 1:
            found[0] = written(found[0], "matches")
        found.append(written(probe(index, block, every_doc=False, slop=slop), "matches"))
    found = reduce(DataFrame.unionByName, found)
    merged = F.aggregate(
        F.array_sort("ranges"), F.array().cast("array<struct<s:long,e:long>>"),
        lambda acc, r: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["e"] >= r["s"]),
            F.concat(F.slice(acc, 1, F.size(acc) - 1),
                     F.array(F.struct(F.element_at(acc, -1)["s"].alias("s"),
                                      F.greatest(F.element_at(acc, -1)["e"], r["e"]).alias("e"))))
        ).otherwise(F.concat(acc, F.array(r))))
    pairs = F.transform(F.arrays_zip("starts", "ends"),
                        lambda r: F.struct(r["starts"].alias("s"), r["ends"].alias("e")))
    return (found.groupBy("shard", "ord")
            .agg(F.first("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"),
                 F.flatten(F.collect_list(pairs)).alias("ranges"),
                 F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
            .select("doc_id", "n_words", merged.alias("spans"), "items"))


def contamination(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The report of query op1: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = find_phrases(docs, items, **options)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, r: acc + r["e"] - r["s"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without a benchmark window, all columns kept.  Contaminated rows
    are named by id and text, so rows that share an id are judged one by one."""
    tag = F.xxhash64(F.col(id_col).cast("long"), F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    found = find_phrases(docs.select(tag.alias("doc_id"), F.col(text_col).alias("text")), items)
    bad = found.where(F.size("spans") > 0).select(F.col("doc_id").alias("tag")).distinct()
    return docs.select(tag.alias("tag"), F.struct("*").alias("row")).join(bad, "tag", "left_anti").select("row.*")
