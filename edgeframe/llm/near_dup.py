"""Near-duplicate documents by improved consistent weighted sampling.

A document is the weighted set of its five-word shingles (a text of one to four words is one
shingle).  The weight is tf * (1 + ``idf_share`` * idf), idf = ln(1 + N / df) / ln(1 + N / f).  df,
the documents with the shingle, is counted exactly over all documents where it is above f, and is
f elsewhere; f is 1 / ``FREQUENT`` of all (document, shingle) pairs, a fixed share of the documents
(0.3 % at 200 shingles each), so weights do not change as the corpus grows.  The share is small on
purpose: in a large group of near copies the shared shingles are the frequent ones, and a full idf
would weigh the few edits above all that is shared.

Each of ``BANDS * ROWS`` samplers picks a shingle and a level with the consistent law: two
documents get the same pick with a probability equal to their weighted Jaccard similarity.
Documents that agree in all picks of a band are candidates, and every candidate link that decides
a class is verified with the exact weighted similarity of the two texts (``THRESHOLD``).

Equal texts are one node from the start.  No pairs are listed within a band's bucket.  Round one
verifies each member against the bucket's hub (hub rows are salted by bucket size) and forms
connected components.  Buckets whose members are still in different components go on: each member
outside the bucket's largest component meets all members, in blocks of bounded size, where one
pass over the members' shingle postings gives its exact similarity with all of them; only links
that join components leave the task.  So every candidate pair is either verified or already
joined through verified links.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeframe.llm.recurrence import BASE, mixed, word_units
from edgeframe.llm.textcol import NO_ID, column, doc_key, slices, spans, texts, written
from edgeframe.operators.common import HOT_KEY_ROWS, hot_key_join

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 12, 4
IDF_SHARE = 0.25
#: shingles with a weight of their own, at most: they are broadcast, in 1 MB
FREQUENT = 1 << 16
#: hash classes, four for each of them, that say which shingles may be among them
DF_BITS = 18
#: members that meet one copy of a hub's text
SALTED = 256
#: members of a bucket that meet in one task, on either side
BLOCK = 512
#: members from which a bucket is hot: its rows are joined where they are, against a broadcast of
#: at most ``MOST_HOT`` hot buckets
HOT_BUCKET, MOST_HOT = 2048, 200_000
#: entries of the table of random numbers that samplers draw from
DRAWS = 1 << 16


def shingle_hashes(values: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """A hash of every shingle of a document's words, in the order of the text."""
    n = len(values)
    if not n:
        return np.zeros(0, np.uint64)
    size = min(n, size)
    with np.errstate(over="ignore"):
        h = np.zeros(n - size + 1, np.uint64)
        for k in range(size):
            h = h * BASE + values[k:n - size + 1 + k]
        return mixed(h + np.uint64(size))


def shingles(values: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of a document's words, and their counts."""
    return np.unique(shingle_hashes(values, size), return_counts=True)


def documents(b: pa.RecordBatch) -> Iterator[np.ndarray]:
    """The word values of each document."""
    u = word_units(b)
    begin = u.ends - np.diff(u.ends, prepend=0)
    for s, e in zip(begin.tolist(), u.ends.tolist()):
        yield u.values[s:e]


def each(b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    return map(shingles, documents(b))


@dataclass(frozen=True)
class Idf:
    """The weight of one occurrence of a shingle: ``own`` for ``hashes`` (ascending), else ``rare``."""

    hashes: np.ndarray
    own: np.ndarray
    rare: float

    def of(self, h: np.ndarray) -> np.ndarray:
        out = np.full(len(h), self.rare)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            known = self.hashes[at] == h
            out[known] = self.own[at[known]]
        return out


def class_counts(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Distinct shingles of all documents per hash class (a table of fixed size), and all documents."""
    parts, lane = 64, 256

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(1 << DF_BITS, np.int64), 0
        for b in slices(batches):
            found = [np.unique(shingle_hashes(v)) for v in documents(b)]
            at = (np.concatenate(found) >> np.uint64(64 - DF_BITS)).astype(np.int64)
            total += np.bincount(at, minlength=1 << DF_BITS)
            n += b.num_rows
        yield pa.RecordBatch.from_pydict({
            "part": pa.array(range(parts), pa.int32()), "n": pa.array([n] + [0] * (parts - 1), pa.int64()),
            "lane": pa.array([TaskContext.get().partitionId() // lane] * parts, pa.int32()),
            "total": pa.array([x.tobytes() for x in total.reshape(parts, -1)], pa.binary())})

    def add(t: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.int64) for x in t.column("total").to_pylist())
        return pa.table({"part": t.column("part")[:1], "n": pa.array([sum(t.column("n").to_pylist())], pa.int64()),
                         "total": pa.array([total.tobytes()], pa.binary())})

    # summed in two steps, so that a group holds the rows of ``lane`` tasks
    shape = "part int, n long, total binary"
    rows = (docs.select("text").mapInArrow(count, "part int, n long, lane int, total binary")
            .groupBy("part", "lane").applyInArrow(add, shape).groupBy("part").applyInArrow(add, shape).collect())
    total = np.zeros((parts, (1 << DF_BITS) // parts), np.int64)
    for r in rows:                                                                          # 64 rows
        total[r["part"]] = np.frombuffer(r["total"], np.int64)
    return total.ravel(), sum(r["n"] for r in rows)


def idf_table(docs: DataFrame, share: float, most: int = FREQUENT) -> Idf:
    """Weights by exact document frequencies.  A shingle in more than 1 / ``most`` of all (document,
    shingle) pairs, so one of fewer than ``most``, has its own; all others have that of this share.
    Only shingles of hash classes that hold more than the share can be of the first kind."""
    total, n = class_counts(docs)
    floor = max(1, int(total.sum()) // most)
    open_ = docs.sparkSession.sparkContext.broadcast(total > floor)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            found = []
            for v in documents(b):
                h = shingle_hashes(v)
                found.append(np.unique(h[open_.value[h >> np.uint64(64 - DF_BITS)]]))
            h, df = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_pydict({"h": pa.array(h.view(np.int64), pa.int64()), "df": pa.array(df, pa.int64())})

    rows = (docs.select("text").mapInArrow(count, "h long, df long").groupBy("h").agg(F.sum("df").alias("df"))
            .where(F.col("df") > floor).collect())      # fewer than ``most``
    h = np.array([r["h"] for r in rows], np.int64).view(np.uint64)
    df = np.array([r["df"] for r in rows], np.float64)
    order = np.argsort(h)
    idf = np.log1p(n / df[order]) / np.log1p(max(n, 1) / floor)
    return Idf(h[order], 1 + share * idf, 1 + share)


def weights(h: np.ndarray, tf: np.ndarray, idf: Idf) -> np.ndarray:
    return tf * idf.of(h)


class Sampler:
    """Consistent weighted samples: for a feature of weight S a sampler draws r, c ~ Gamma(2, 1)
    and beta ~ U(0, 1) by the feature's hash, takes the level t = floor(ln S / r + beta) and keeps
    the feature with the least c / (exp(r (t - beta)) exp(r))."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS, seed: int = 7):
        draw = np.random.default_rng(seed)
        r, c = draw.gamma(2, 1, DRAWS), draw.gamma(2, 1, DRAWS)
        self.r, self.inverse = r.astype(np.float32), (1 / r).astype(np.float32)
        self.beta, self.ln_c = draw.random(DRAWS, np.float32), np.log(c).astype(np.float32)
        self.spin = (draw.integers(0, 1 << 32, bands * rows, np.uint32) | 1)
        self.bands, self.rows = bands, rows

    def sketch(self, h: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """One number per band: a hash of its samplers' picks (feature and level)."""
        k = len(self.spin)
        best = np.full(k, np.inf, np.float32)
        pick, level = np.zeros(k, np.uint64), np.zeros(k, np.int64)
        low = (h & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        ln = np.log(weight).astype(np.float32)
        for i in range(0, len(h), 1024):
            at = ((low[i:i + 1024, None] * self.spin) >> np.uint32(16)).astype(np.intp)
            # sixteen bits are always a place in a table: "clip" only spares the test of it
            r, inverse, beta, ln_c = [x.take(at, mode="clip") for x in (self.r, self.inverse, self.beta, self.ln_c)]
            inverse *= ln[i:i + 1024, None]
            inverse += beta
            t = np.floor(inverse, inverse)
            a = np.subtract(t, beta, beta)
            a += 1
            a *= r
            a = np.subtract(ln_c, a, ln_c)
            j = a.argmin(0)
            low_a = a[j, np.arange(k)]
            better = low_a < best
            best[better] = low_a[better]
            pick[better] = h[i + j[better]]
            level[better] = t[j, np.arange(k)][better]
        with np.errstate(over="ignore"):
            one = mixed(pick + mixed(level.astype(np.uint64) + BASE)).reshape(self.bands, self.rows)
            out = np.arange(1, self.bands + 1).astype(np.uint64) * BASE
            for row in range(self.rows):
                out = mixed(out * BASE + one[:, row])
        return out.view(np.int64)


def signatures(docs: DataFrame, idf: Idf, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, key, node, bands): node is the MD5 of the text, bands is empty without words."""
    shared = docs.sparkSession.sparkContext.broadcast(idf)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(bands, rows)
        seen: dict[bytes, np.ndarray] = {}      # copies in the same task are sampled once
        for b in slices(batches):
            nodes, picks = [hashlib.md5(t).digest() for t in texts(b)], []
            for node, (h, tf) in zip(nodes, each(b)):
                if node not in seen:
                    if len(seen) > 20_000:
                        seen.clear()
                    seen[node] = sampler.sketch(h, weights(h, tf, shared.value)) if len(h) else np.zeros(0, np.int64)
                picks.append(seen[node])
            yield pa.RecordBatch.from_pydict({
                "doc_id": column(b, "doc_id"), "key": column(b, "key"), "node": pa.array(nodes, pa.binary()),
                "bands": pa.array(picks, pa.list_(pa.int64()))})

    return docs.select("doc_id", "key", "text").mapInArrow(
        sign, "doc_id long, key long, node binary, bands array<long>")


def similarity(a: tuple, b: tuple, idf: Idf) -> float:
    """Weighted Jaccard similarity of two (hashes, counts)."""
    both, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    least = float((np.minimum(a[1][i], b[1][j]) * idf.of(both)).sum())
    whole = float(weights(*a, idf).sum() + weights(*b, idf).sum())
    return least / (whole - least) if whole else 0.0


def verified(pairs: DataFrame, bodies: DataFrame, idf: Idf, threshold: float) -> DataFrame:
    """The pairs (a, b, salt) whose texts are similar, as (a, b).  Text b comes to the pair; text
    a is laid out once per salt, so the rows of a hub are spread."""
    shared = pairs.sparkSession.sparkContext.broadcast(idf)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, None
        for b in slices(batches, "text_b", 2 << 20):
            left, right = column(b, "a").to_pylist(), column(b, "b").to_pylist()
            ok = []
            text_a = column(b, "text_a")
            for k, (x, vector) in enumerate(zip(left, each(b.select(["text_b"]).rename_columns(["text"])))):
                if x != last:
                    last, own = x, next(each(pa.RecordBatch.from_arrays([text_a[k:k + 1]], ["text"])))
                ok.append(similarity(own, vector, shared.value) >= threshold)
            yield pa.RecordBatch.from_pydict({
                "a": pa.array(itertools.compress(left, ok), pa.binary()),
                "b": pa.array(itertools.compress(right, ok), pa.binary())})

    left = (pairs.select("a", "salt").distinct()
            .join(bodies.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a"))
    right = pairs.join(bodies.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    return right.join(left, ["a", "salt"]).select("a", "b", "text_a", "text_b").mapInArrow(judge, "a binary, b binary")


def cross_links(members: DataFrame, joined: DataFrame, bodies: DataFrame, idf: Idf,
                threshold: float) -> DataFrame:
    """Links (a, b) between members of a bucket that round one left in different components: each
    member outside the bucket's largest component against all members, in blocks of about
    ``BLOCK`` by ``BLOCK``; of the links of a block only those that join components are returned."""
    at = members.select("bucket", "node").join(joined, "node", "left").withColumn("class", F.coalesce("class", "node"))
    per = at.groupBy("bucket", "class").agg(F.count(F.lit(1)).alias("n"))
    parts = (per.groupBy("bucket").agg(F.max(F.struct("n", "class")).alias("top"), F.sum("n").alias("m"),
                                       F.count(F.lit(1)).alias("parts")).where("parts > 1"))
    rows = F.ceil((F.col("m") - F.col("top.n")) / BLOCK).cast("int")
    cols = F.ceil(F.col("m") / BLOCK).cast("int")
    parts = written(parts.select("bucket", "m", F.col("top.class").alias("top"), rows.alias("rows"), cols.alias("cols")), "parts")
    open_ = hot_key_join(at, parts, "bucket", "m", HOT_BUCKET, MOST_HOT)
    spot = F.xxhash64("node")
    row, col = F.pmod(spot, "rows").cast("int"), F.pmod(spot, "cols").cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    stray = open_.where(F.col("class") != F.col("top")).select("bucket", "node", "class", row.alias("i"), every("cols").alias("j"))
    other = open_.select("bucket", "node", "class", every("rows").alias("i"), col.alias("j"))
    dealt = stray.withColumn("stray", F.lit(True)).unionByName(other.withColumn("stray", F.lit(False)))
    shared = members.sparkSession.sparkContext.broadcast(idf)

    def match(t: pa.Table) -> pa.Table:
        b = t.combine_chunks().to_batches()[0]
        vectors = list(each(b.select(["text"])))
        is_stray = column(b, "stray").to_numpy(False)
        node, kind = column(b, "node").to_pylist(), column(b, "class").dictionary_encode().indices.to_numpy()
        others = np.flatnonzero(~is_stray)
        whole = np.array([weights(*vectors[k], shared.value).sum() for k in range(len(vectors))])
        h = np.concatenate([vectors[k][0] for k in others] or [np.zeros(0, np.uint64)])
        tf = np.concatenate([vectors[k][1] for k in others] or [np.zeros(0, np.int64)])
        who = np.repeat(np.arange(len(others)), [len(vectors[k][0]) for k in others])
        order = np.argsort(h, kind="stable")
        h, tf, who = h[order], tf[order], who[order]
        found, root = [], list(range(int(kind.max(initial=0)) + 1))

        def find(k: int) -> int:
            while root[k] != k:
                root[k] = k = root[root[k]]
            return k

        for x in np.flatnonzero(is_stray).tolist():
            own, count = vectors[x]
            first = np.searchsorted(h, own, "left")
            n = np.searchsorted(h, own, "right") - first
            at = np.repeat(first, n) + spans(n)
            weight = np.repeat(shared.value.of(own), n) * np.minimum(np.repeat(count, n), tf[at])
            both = np.bincount(who[at], weight, len(others))
            like = both / np.maximum(whole[x] + whole[others] - both, 1e-12)
            hit = others[(like >= threshold) & (kind[others] != kind[x])]
            _, one = np.unique(kind[hit], return_index=True)
            for y in hit[one].tolist():     # links that join components not yet joined in this block
                p, q = find(int(kind[x])), find(int(kind[y]))
                if p != q:
                    root[p] = q
                    found.append((node[x], node[y]))
        return pa.table({"a": pa.array([a for a, _ in found], pa.binary()), "b": pa.array([b for _, b in found], pa.binary())})

    return (dealt.join(bodies, "node").select("bucket", "i", "j", "node", "class", "text", "stray")
            .groupBy("bucket", "i", "j").applyInArrow(match, "a binary, b binary"))


def components(links: DataFrame, hot: int = HOT_KEY_ROWS) -> DataFrame:
    """(node, class) for every node that is not the least of its connected component: the least.
    Alternating large-star and small-star steps, until the links (by number and sum of hashes)
    no longer change: then every link goes from a node to the least of its component.  A node
    with more than ``hot`` links is not gathered: its links meet its least neighbour where they
    are.  ``links`` is a written table."""
    u, v = F.col("u"), F.col("v")
    edges = (links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
             .where(u != v).distinct())
    before, n = None, links.count()

    def with_least(pairs: DataFrame, least: DataFrame) -> DataFrame:
        # no node can be hot among so few links, each of which is laid out twice at most
        return pairs.join(least.drop("n"), "u") if 2 * n <= hot else hot_key_join(pairs, least, "u", "n", hot).drop("n")

    while True:
        both = edges.union(edges.select(v, u)).toDF("u", "v")
        size = F.count(F.lit(1)).alias("n")
        least = both.groupBy("u").agg(F.min("v").alias("m"), size).select("u", F.least("u", "m").alias("m"), "n")
        large = with_least(both, least).where(v > u).select(v.alias("u"), F.col("m").alias("v")).where(u != v)
        least = large.groupBy("u").agg(F.min("v").alias("m"), size)
        small = with_least(large, least)
        step = (small.select(v.alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
                .where(u != v).distinct())
        edges = written(step, "edges")
        seen = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if seen == before:
            return edges.select(u.alias("node"), v.alias("class"))
        before, n = seen, seen["n"]


def classes(docs: DataFrame, threshold: float = THRESHOLD, idf_share: float = IDF_SHARE, bands: int = BANDS,
            rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Query op9, one row per row of ``docs``: doc_id, class_id (the least doc_id of its class of
    near duplicates; null if that class holds a null id) and n_texts (different texts in it).

    Null and empty texts are copies of one another and similar to nothing else; repeated rows
    are copies; a text without a similar one is a class of its own and its copies."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), doc_key(id_col).alias("key"),
                         F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    idf = idf_table(source, idf_share)
    signed = written(signatures(source, idf, bands, rows), "signatures")
    nodes = written(signed.groupBy("node").agg(F.min("key").alias("key"), F.first("bands").alias("bands"),
                                               F.count(F.lit(1)).alias("copies")), "nodes")
    members = nodes.select("node", F.explode("bands").alias("bucket"))
    hubs = members.groupBy("bucket").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("size")).where("size > 1")
    members = written(hot_key_join(members, written(hubs, "hubs"), "bucket", "size", HOT_BUCKET, MOST_HOT), "members")
    wanted = members.select("node").distinct().join(nodes.select("node", "key"), "node")
    # one document per node brings the text: copies are dealt by id and text, not all to one task
    texts_of = source.select("key", F.unhex(F.md5("text")).alias("node"), "text")
    bodies = written(texts_of.join(wanted, ["key", "node"]).dropDuplicates(["key", "node"]).select("node", "text"),
                     "bodies")
    salt = F.pmod(F.xxhash64("node"), F.ceil(F.col("size") / SALTED)).cast("int")
    pairs = (members.where("node != hub").groupBy(F.col("hub").alias("a"), F.col("node").alias("b"))
             .agg(F.max(salt).alias("salt")))
    joined = components(written(verified(pairs, bodies, idf, threshold), "links"))
    rest = written(cross_links(members, joined, bodies, idf, threshold), "links")
    joined = components(joined.toDF("a", "b").union(rest))
    named = nodes.join(joined, "node", "left").select("node", "key", "copies", F.coalesce("class", "node").alias("class"))
    first = written(named.groupBy("class").agg(F.min("key").alias("least"), F.count(F.lit(1)).alias("n_texts")), "classes")
    of_node = written(hot_key_join(named, first, "class", "n_texts"), "named").select("node", "class", "least", "n_texts", "copies")
    least = F.when(F.col("least") != F.lit(NO_ID), F.col("least"))
    return (hot_key_join(signed, of_node, "node", "copies")
            .select("doc_id", least.alias("class_id"), "n_texts", "class", "key", "node"))


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    return classes(docs, **options).select("doc_id", "class_id", "n_texts")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each class stays: the one of the least id (of documents that share it, the
    least text by MD5; of repeated rows, one).  All columns are kept."""
    found = classes(docs, id_col=id_col, text_col=text_col, **options)
    first = found.groupBy("class").agg(F.min(F.struct("key", "node")).alias("who"))
    node = F.unhex(F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
    rows = docs.select(doc_key(id_col).alias("key"), node.alias("node"), F.struct("*").alias("row"))
    return (rows.join(first.select("who.key", "who.node"), ["key", "node"], "left_semi")
            .dropDuplicates(["key", "node"]).select("row.*"))
