"""Where strings of ``length`` units recur across a corpus, without sorting all of it.

Units are bytes or words.  The plan, shared by the suffix-array and the automaton operators:

1. *Anchors.*  Every window of ``length`` units has an anchor: of the ``gram``-unit grams in it,
   the leftmost with the least hash.  Equal windows have equal anchors at equal places, so a
   window can recur only if its anchor's hash does.  A document sends each hash once for each
   place, packed by hash bucket; a bucket answers with the hashes that recur,
   and says which of them are *hot*: in more places than one batch of groups may hold.
2. *Contexts.*  Documents meet their answers and cut, around each recurring anchor, the passage
   that holds all windows of this anchor.  A context that the task has already sent for an
   earlier document is not sent again: its windows are marked at once, so a passage in a third
   of all documents costs each task one row.  A new context of a hot anchor is cut into its
   windows, and each goes by its own hash: a phrase too short to be removed, with other
   neighbours in every document, makes many small groups and not one of all its contexts.
3. *Verdicts.*  Contexts meet by anchor hash, so all occurrences of a window are together.
   Equal contexts fold to the earliest; where an anchor has several contexts, ``find`` (suffix
   array or automaton) tells which windows are equal.  All but the earliest are marked.

Without ``fold`` every context of an anchor that is not hot is sent, and ``find`` gets all that
meet, copies included; only windows of hot anchors are combined before they are sent.

At last marks meet their documents.

It is one lazy plan: the documents are dealt by their tag once and that exchange is used twice.
Nothing is kept on the driver.  A task holds one batch of groups; a group has at most ``hot``
contexts, or is one window (of a hash) and as many rows as tasks sent it.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeframe.llm.textcol import column, doc_key, slices, sums, texts, utf8

#: text that a task gathers before it packs its anchors, and context bytes judged at a time: a
#: suffix array takes some 60 bytes for each, an automaton several hundred
PACK_BYTES = 32 << 20
BATCH_BYTES = 2 << 20
#: contexts, and windows of hot anchors, that a task remembers; the memory starts anew when it is full
SEEN = 200_000
SEEN_WINDOWS = 25_000
#: bytes of a batch for each context that an anchor may have before it is hot
HOT_BYTES = 256
#: marks a hot anchor's hash in an answer (hashes have 57 bits)
HOT = 1 << 60
#: rows that a task gathers before it sends them
ROWS = 5_000

BASE = np.uint64(0x9E3779B97F4A7C15)
MARK = "tag long, key long, lo long, n long"


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on every bit of ``h``."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


#: a random number for each byte value
BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * BASE)


@dataclass
class Units:
    """A slice of documents as numbers: equal units have equal numbers."""
    values: np.ndarray
    ends: np.ndarray                                # of each document
    passage: Callable[[int, int], bytes]            # the units [s, e) of the slice


def byte_units(b: pa.RecordBatch) -> Units:
    data, off = utf8(column(b, "text"))
    raw = data.tobytes()
    return Units(BYTE_VALUES[data], off[1:], lambda s, e: raw[s:e])


def word_units(b: pa.RecordBatch) -> Units:
    """Words: runs of anything but ASCII white space; a passage joins them by one blank."""
    cut = [t.split() for t in texts(b)]
    words = list(itertools.chain.from_iterable(cut))
    coded = pa.array(words, pa.binary()).dictionary_encode()
    own = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()),
                      np.uint64, len(coded.dictionary))
    return Units(own[coded.indices.to_numpy()], np.cumsum(np.fromiter(map(len, cut), np.int64, len(cut))),
                 lambda s, e: b" ".join(words[s:e]))


def gram_hashes(values: np.ndarray, gram: int) -> np.ndarray:
    """A hash of ``values[i:i + gram]`` for each i, by doubling (``gram``: a power of two)."""
    h, size, power = values, 1, BASE
    while size < gram:
        h = h[:-size] * power + h[size:]
        power, size = power * power, size * 2
    return mixed(h)


def anchors(u: Units, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with a common anchor: (document, first window's start in the slice, number
    of windows, anchor hash as a non-negative long)."""
    width, n = length - gram + 1, len(u.values)
    if n < length:
        return (np.zeros(0, np.int64),) * 4
    with np.errstate(over="ignore"):
        least = gram_hashes(u.values, gram) & ~np.uint64(127)      # the low bits hold the place
    size = 1
    while size * 2 <= width:
        least = np.minimum(least[:-size], least[size:] + np.uint64(size))
        size *= 2
    if size < width:
        least = np.minimum(least[:size - width], least[width - size:] + np.uint64(width - size))
    lens = np.diff(u.ends, prepend=0)
    windows = np.maximum(lens - length + 1, 0)
    doc = np.repeat(np.arange(len(lens)), windows)
    within = np.arange(len(doc)) - np.repeat(np.cumsum(windows) - windows, windows)
    start = within + np.repeat(u.ends - lens, windows)
    least = least[start]
    place = start + (least & np.uint64(127)).astype(np.int64)
    new = np.ones(len(start), bool)
    new[1:] = (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    return doc[at], start[at], np.diff(at, append=len(start)), (least[at] >> np.uint64(7)).astype(np.int64)


def tagged(docs: DataFrame, id_col: str, text_col: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """(tag, key, doc_id, text, rest).  The key orders documents (the id, null first), the tag breaks
    ties; rows that agree in id and text are one document.  ``rest`` holds the ``carry`` columns."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rest = [F.struct(*carry).alias("rest")] if carry else []
    return docs.select(F.xxhash64(doc_key(id_col), text).alias("tag"), doc_key(id_col).alias("key"),
                       F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), *rest)


def recurring_hashes(docs: DataFrame, units: Callable, length: int, gram: int, buckets: int,
                     hot: int = BATCH_BYTES // HOT_BYTES) -> DataFrame:
    """(tag, hashes): the anchor hashes of a document that stand elsewhere too, as blobs; those in
    more than ``hot`` places have the bit ``HOT``."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in itertools.chain(slices(batches), [None]):
            if b is not None:
                tags = column(b, "tag").to_numpy()
                doc, _, _, h = anchors(units(b), length, gram)
                held.append((h, tags[doc]))
                size += utf8(column(b, "text"))[1][-1]
            if held and (b is None or size >= PACK_BYTES):
                h, tag = (np.concatenate(x) for x in zip(*held))
                held, size = [], 0
                to = h % buckets
                order = np.argsort(to, kind="stable")
                h, tag = h[order], tag[order]
                which, first = np.unique(to[order], return_index=True)
                ends = np.append(first, len(h))
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array(which, pa.int64()),
                    "h": pa.array([h[i:j].tobytes() for i, j in zip(ends, ends[1:])], pa.binary()),
                    "tags": pa.array([tag[i:j].tobytes() for i, j in zip(ends, ends[1:])], pa.binary())})

    def answer(t: pa.Table) -> pa.Table:
        h = np.frombuffer(b"".join(t.column("h").to_pylist()), np.int64)
        tag = np.frombuffer(b"".join(t.column("tags").to_pylist()), np.int64)
        order = np.argsort(h)
        h, tag = h[order], tag[order]
        same = h[1:] == h[:-1]
        again = np.zeros(len(h), bool)
        again[1:] |= same
        again[:-1] |= same
        h, tag = h[again], tag[again]
        _, of, places = np.unique(h, return_inverse=True, return_counts=True)
        h = np.where(places[of] > hot, h | HOT, h)
        order = np.lexsort((h, tag))
        h, tag = h[order], tag[order]
        once = np.ones(len(h), bool)
        once[1:] = (h[1:] != h[:-1]) | (tag[1:] != tag[:-1])
        h, tag = h[once], tag[once]
        to, first = np.unique(tag, return_index=True)
        ends = np.append(first, len(h))
        return pa.table({"tag": pa.array(to, pa.int64()),
                         "h": pa.array([h[i:j].tobytes() for i, j in zip(ends, ends[1:])], pa.binary())})

    packed = docs.select("tag", "text").mapInArrow(pack, "bucket long, h binary, tags binary")
    return (packed.groupBy("bucket").applyInArrow(answer, "tag long, h binary")
            .groupBy("tag").agg(F.collect_list("h").alias("hashes")))


def contexts(joined: DataFrame, units: Callable, length: int, gram: int, fold: bool = True) -> DataFrame:
    """Rows (h, key, tag, lo, n, ctx) for the judges; ctx is null where the row is a mark.

    Which copy of a passage is sent and which is marked depends on the order of the rows, and the two
    go to different tasks: the rows are sorted, so that a task that runs again sends the same."""

    def packed(rows: list) -> pa.RecordBatch:
        cols = zip(("h", "key", "tag", "lo", "n", "ctx"), zip(*rows))
        return pa.RecordBatch.from_pydict(
            {k: pa.array(v, pa.binary() if k == "ctx" else pa.int64()) for k, v in cols})

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, tuple] = {}
        seen_windows: dict[bytes, tuple] = {}

        def new(memory: dict[bytes, tuple], most: int, passage: bytes, me: tuple) -> bool | None:
            """Whether to send a passage; None: it is the remembered one."""
            digest = xxhash.xxh3_128_digest(passage)
            first = memory.get(digest)
            if first is None or me < first:
                if len(memory) >= most:
                    memory.clear()
                memory[digest] = me
                return True
            return None if first == me else False

        for b in slices(batches):
            u = units(b)
            doc, start, n, h = anchors(u, length, gram)
            begin = (u.ends - np.diff(u.ends, prepend=0)).tolist()
            tags, keys = column(b, "tag").to_pylist(), column(b, "key").to_pylist()
            known = [np.frombuffer(b"".join(x), np.int64) for x in column(b, "hashes").to_pylist()]
            edge = np.searchsorted(doc, np.arange(len(known) + 1))
            keep, hot = np.zeros(len(doc), bool), np.zeros(len(doc), bool)
            for i, j, k in zip(edge, edge[1:], known):
                keep[i:j] = np.isin(h[i:j], k & ~HOT)
                if len(k) and k.max() >= HOT:
                    hot[i:j] = np.isin(h[i:j] | HOT, k)
            rows, mark = [], None
            for d, s, m, x, many in zip(doc[keep].tolist(), start[keep].tolist(), n[keep].tolist(),
                                        h[keep].tolist(), hot[keep].tolist()):
                ctx = u.passage(s, s + m - 1 + length)
                me = (keys[d], tags[d], s - begin[d])
                fresh = new(seen, SEEN, ctx, me) if fold or many else True
                if fresh and not many:
                    rows.append((x, *me, m, ctx))
                elif fresh is not None:
                    # each window of a hot anchor's new context, or the whole of a copied one
                    for at, w in ((at, 1) for at in range(s, s + m)) if fresh else ((s, m),):
                        me = (keys[d], tags[d], at - begin[d])
                        if fresh:
                            window = u.passage(at, at + length)
                            first = new(seen_windows, SEEN_WINDOWS, window, me)
                            if first:
                                rows.append((xxhash.xxh3_64_intdigest(window) >> 1, *me, 1, window))
                            if first is not False:
                                continue
                        # windows of consecutive anchors follow on: one mark for a copied passage; marks
                        # need no meeting, so they go by their document, not by a hash that may be hot
                        if mark and (mark[1], mark[2], mark[3] + mark[4]) == me:
                            mark[4] += w
                        else:
                            mark = [tags[d], *me, w, None]
                            rows.append(mark)
                if len(rows) >= ROWS:
                    yield packed(rows)
                    rows, mark = [], None
            if rows:
                yield packed(rows)

    return joined.sortWithinPartitions("key", "tag").mapInArrow(
        cut, "h long, key long, tag long, lo long, n long, ctx binary")


def verdicts(cut: DataFrame, length: int, partitions: int, find: Callable, batch_bytes: int,
             fold: bool = True) -> DataFrame:
    """Marks (tag, key, lo, n): windows lo .. lo + n - 1 of the document start earlier elsewhere.

    ``find(passages, n)`` gets passages (distinct ones with ``fold``) and their numbers of windows, and returns for
    each window, passage by passage, the number of its class of equal windows."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in itertools.chain(batches, [None]):
            if b is not None and b.num_rows:
                held.append(b)
                size += b.get_total_buffer_size()
            if held and (b is None or size >= batch_bytes):
                t = pa.Table.from_batches(held).combine_chunks()
                h = column(t.to_batches()[0], "h").to_numpy()
                # the last hash may go on in the next batch, unless it is all there is
                stop = len(h) if b is None else int(np.searchsorted(h, h[-1]))
                held, size = ([t.slice(stop).to_batches()[0]] if stop < len(h) else []), 0
                if stop:
                    yield from marks(t.slice(0, stop).combine_chunks().to_batches()[0])

    def marks(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        names = ("h", "key", "tag", "lo", "n")
        col = {k: column(b, k).to_numpy() for k in names}
        order = np.lexsort((col["lo"], col["tag"], col["key"]))
        col = {k: v[order] for k, v in col.items()}
        ctx = column(b, "ctx").take(pa.array(order))
        done = ctx.is_null().to_numpy(False)            # marked by their task
        me = np.stack([col["key"], col["tag"], col["lo"]])
        twice = np.zeros(len(done), bool)               # repeated rows are one document
        twice[1:] = (me[:, 1:] == me[:, :-1]).all(0)
        own = np.flatnonzero(~done & ~twice)
        if fold:
            coded = ctx.dictionary_encode()
            _, first, of = np.unique(coded.indices.fill_null(-1).to_numpy(), return_index=True, return_inverse=True)
            first = first[of]                           # the earliest row with this context
            own = np.flatnonzero(~done & (first == np.arange(len(done))))   # distinct contexts, by order
            done |= (me != me[:, first]).any(0)
        whole = np.flatnonzero(done)
        out = [[col[k][whole] for k in ("tag", "key", "lo", "n")]]
        _, anchor, many = np.unique(col["h"][own], return_inverse=True, return_counts=True)
        own = own[many[anchor] > 1]
        if len(own):
            n = col["n"][own]
            cls = find(ctx.take(pa.array(own)).to_pylist(), n)
            row = np.repeat(np.arange(len(own)), n)
            within = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            # rows stand in the order (key, tag, lo), but one document's contexts may interleave
            place = np.lexsort((col["lo"][own][row] + within, col["tag"][own][row], col["key"][own][row]))
            _, least = np.unique(cls[place], return_index=True)
            again = np.ones(len(row), bool)
            again[place[least]] = False
            at = np.flatnonzero(again)
            new = np.ones(len(at), bool)
            new[1:] = (np.diff(at) != 1) | (np.diff(row[at]) != 0)
            run = np.flatnonzero(new)
            r = own[row[at[run]]]
            out.append([col["tag"][r], col["key"][r], col["lo"][r] + within[at[run]], np.diff(run, append=len(at))])
        tag, key, lo, n = (np.concatenate(x) for x in zip(*out))
        yield pa.RecordBatch.from_pydict({"tag": pa.array(tag), "key": pa.array(key), "lo": pa.array(lo),
                                          "n": pa.array(n, pa.int64())})

    return cut.repartition(partitions, "h").sortWithinPartitions("h").mapInArrow(judge, MARK)


def with_marks(docs: DataFrame, units: Callable, length: int, gram: int, find: Callable, id_col: str = "doc_id",
               text_col: str = "text", carry: tuple[str, ...] = (), batch_bytes: int = BATCH_BYTES,
               hot: int | None = None, fold: bool = True) -> DataFrame:
    """``tagged`` rows with ``marks``: structs (key, lo, n), null where none.  Anchors in more than
    ``hot`` places are split (as many as a batch may hold by default)."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    source = tagged(docs, id_col, text_col, carry)
    dealt = source.repartition(parts, "tag")
    answers = recurring_hashes(source, units, length, gram, 4 * parts, hot or batch_bytes // HOT_BYTES)
    cut = contexts(dealt.join(answers.hint("shuffle_hash"), "tag"), units, length, gram, fold)
    found = (verdicts(cut, length, parts, find, batch_bytes, fold).groupBy("tag")
             .agg(F.collect_list(F.struct("key", "lo", "n")).alias("marks")))
    return dealt.join(found.hint("shuffle_hash"), "tag", "left")


def covered(b: pa.RecordBatch, ends: np.ndarray, length: int) -> np.ndarray:
    """Which units of the slice its marks cover."""
    marks = column(b, "marks")
    off = marks.offsets.to_numpy().astype(np.int64)
    n = np.where(marks.is_null().to_numpy(False), 0, np.diff(off))
    doc = np.repeat(np.arange(len(marks)), n)
    flat = marks.flatten()          # of the slice, without what nulls may hide
    lo, many, key = (flat.field(k).to_numpy() for k in ("lo", "n", "key"))
    mine = key == column(b, "key").to_numpy()[doc]
    begin = ends - np.diff(ends, prepend=0)
    s = (begin[doc] + lo)[mine]
    change = np.zeros(int(ends[-1]) + 1 if len(ends) else 1, np.int64)
    np.add.at(change, s, 1)
    np.add.at(change, s + many[mine] - 1 + length, -1)
    return np.cumsum(change[:-1]) > 0


def rewritten(docs: DataFrame, cut: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The columns of ``docs`` from rows (rest, kept): the text is what was kept, ``n_chars`` (where
    there is one) its length, all others as they were."""
    new = {text_col: F.col("kept"), "n_chars": F.length("kept").cast(dict(docs.dtypes).get("n_chars", "long"))}
    return cut.select(*[new.get(c, F.col("rest").getField(c)).alias(c) for c in docs.columns])


def runs(hit: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Per document the number of maximal runs of hit units."""
    new = hit.copy()
    new[1:] &= ~hit[:-1]
    begin = (ends - np.diff(ends, prepend=0))
    begin = begin[begin < len(hit)]
    new[begin] = hit[begin]
    return sums(new.astype(np.int64), ends)
