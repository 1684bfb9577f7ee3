"""Shared plan utilities: size-checked broadcast, lineage cuts, bounded groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

import uuid

from edgeframe.plans.inspect import estimated_bytes
from edgeframe.session import checkpoint_dir, scratch_path

# Largest side (in rows) that an explicit broadcast strategy may replicate.
# Two bigint columns are ~16 B/row in a hash relation plus overhead, so two
# million rows stay well under the usual 64-128 MB broadcast budget.
DEFAULT_BROADCAST_ROWS = 2_000_000

# An exact row count is only taken for sides Catalyst estimates at or below
# this size, so proving "small" never costs a pass over a large input.
EXACT_CHECK_BYTES = 1 << 30

# A key with more rows than this is "hot": joined map-side against a broadcast
# of the (few) hot lookup rows instead of being shuffled to one task.
HOT_KEY_ROWS = 1_000_000

# Largest list that one output row (adjacency line, materialised group) may hold.
DEFAULT_MAX_GROUP = 1_000_000


def row_count_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (reads at most max_rows+1)."""
    return df.limit(max_rows + 1).count() <= max_rows


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """Mark ``df`` for broadcast only when its row count is proven small.

    Two steps: Catalyst's size estimate (no job) rules out large inputs; only
    a side estimated at most ``EXACT_CHECK_BYTES`` gets the exact bounded
    count.  Returns ``(frame, broadcast_applied)``.  Beyond the bound the
    frame is returned unhinted, so the planner uses a shuffle join (and AQE may
    still switch to a broadcast at run time from real shuffle sizes).
    """
    if estimated_bytes(df) > EXACT_CHECK_BYTES:
        return df, False
    if row_count_at_most(df, max_rows):
        return F.broadcast(df), True
    return df, False


def wide(c: Column) -> Column:
    """A bigint as decimal, so that products and sums over many rows cannot overflow 64 bits."""
    return c.cast("decimal(19,0)")


def big_sum(product: Column) -> Column:
    """``sum`` as decimal(38,0), 0 over no rows; ``product`` is built from :func:`wide` factors."""
    return F.coalesce(F.sum(product.cast("decimal(38,0)")), F.lit(0)).cast("decimal(38,0)")


def hot_keys(counts: DataFrame, key: str, count_col: str, threshold: int | None = None,
             max_hot: int = DEFAULT_BROADCAST_ROWS) -> tuple[DataFrame | None, int, int]:
    """``(keys, threshold, rows)``: the keys with more than ``threshold`` rows (None where
    there is none) and the number of all rows.

    The threshold is raised to ``total rows / max_hot`` where that is more, so
    there are never more than ``max_hot`` hot keys and the split never has to
    be given up.  One aggregate over the counts decides.
    """
    threshold = HOT_KEY_ROWS if threshold is None else threshold
    c = F.col(count_col)
    seen = counts.agg(F.sum(c.cast("decimal(38,0)")).alias("rows"), F.max(c).alias("top")).first()
    rows = int(seen["rows"] or 0)
    threshold = max(threshold, rows // max_hot)
    if (seen["top"] or 0) <= threshold:
        return None, threshold, rows
    return counts.where(c > threshold).select(key), threshold, rows


def hot_key_join(big: DataFrame, lookup: DataFrame, key: str, count_col: str,
                 threshold: int | None = None, max_hot: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Inner join of ``big`` with a one-row-per-key ``lookup`` on ``key``,
    with hot keys split out.

    ``lookup[count_col]`` bounds how many ``big`` rows carry each key (a degree
    or group size).  With no hot key (:func:`hot_keys`) the join is a single
    plain shuffle join.  Otherwise hot rows of ``big`` are joined map-side
    with a broadcast of the hot lookup rows, at most ``max_hot``; the other
    rows go through a shuffle join in which no key has more than the threshold
    of rows.  Both halves filter ``big`` map-side (broadcast semi / anti
    joins), so a hot key is never shuffled.
    """
    keys, threshold, _ = hot_keys(lookup, key, count_col, threshold, max_hot)
    if keys is None:
        return big.join(lookup, key)
    keys = F.broadcast(keys)
    hot = F.broadcast(lookup.where(F.col(count_col) > threshold))
    hot_part = big.join(keys, key, "left_semi").join(hot, key)
    cold_part = big.join(keys, key, "left_anti").join(
        lookup.where(F.col(count_col) <= threshold), key)
    return hot_part.unionByName(cold_part)


def spread(df: DataFrame) -> DataFrame:
    """Round-robin ``df`` over the session's shuffle partitions.

    Used on the streamed side of a broadcast join whose output is much larger
    than its input (wedge walks, 2-paths): a small materialised table may sit
    in one partition after adaptive coalescing, which would serialise the
    whole fan-out into one task.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` into the shared checkpoint folder and drop its lineage.

    Reliable checkpoint files survive executor loss (unlike a local checkpoint)
    and keep the output partitioning, so a co-partitioned join stays shuffle-free.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet in the shared folder and read it back (a lineage cut
    that later scans read column-pruned and with pushed filters)."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a written folder through the file system it is on."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


#: rows that one bucket of a written edge table should hold (some 24 bytes each)
BUCKET_ROWS = 10_000_000


class BucketedTable:
    """A table bucketed by ``key`` in the shared folder, registered while it is in use.

    The written table cuts lineage like a checkpoint and records its hash
    layout in the catalog, so later joins on ``key`` with another table of the
    same bucket count run without an exchange on either side, and a join with
    an unbucketed frame shuffles only that frame.  ``append`` adds rows round
    by round, so state that only gains rows is never rewritten.
    ``shuffle=False`` skips the repartition when the frame is already
    hash-partitioned by ``key`` into ``buckets`` partitions (default: the
    session's shuffle partitions).
    """

    def __init__(self, df: DataFrame, key: str, name: str, buckets: int | None = None,
                 shuffle: bool = True, metrics: tuple = ()):
        self.spark, self.key = df.sparkSession, key
        self.n = buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.path = scratch_path(self.spark, name)
        self.table = f"edgeframe_{name}_{uuid.uuid4().hex[:12]}"
        self.seen = self._write(df.repartition(self.n, key) if shuffle else df, "overwrite", metrics)
        self.rows: int | None = None     # known after the first count
        self.appends = 0

    def _write(self, df: DataFrame, mode: str, metrics: tuple) -> dict:
        obs = Observation(f"rows_{uuid.uuid4().hex[:12]}")
        src = df.observe(obs, *metrics) if metrics else df
        writer = src.write.bucketBy(self.n, self.key).mode(mode)
        (writer.option("path", self.path) if mode == "overwrite" else writer).saveAsTable(self.table)
        return obs.get if metrics else {}

    def read(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.table)
        return self.spark.table(self.table)

    def append(self, df: DataFrame) -> int:
        """Append ``df`` (ideally already hash-partitioned by ``key``); returns how many
        rows it had, from the files' footers.  (An observed metric never arrives if
        the adaptive planner finds the appended plan empty and drops the node.)"""
        before = self.count()
        self._write(df, "append", ())
        self.rows = self.spark.read.parquet(self.path).count()
        self.appends += 1
        return self.rows - before

    def count(self) -> int:
        """All rows, from the files' footers; read only after a write."""
        if self.rows is None:
            self.rows = self.spark.read.parquet(self.path).count()
        return self.rows

    def compacted(self, rows: DataFrame, name: str) -> "BucketedTable":
        """A table of ``rows`` (computed from this one and still laid out by its buckets) in place
        of this one, with one file per bucket."""
        new = BucketedTable(rows, self.key, name, self.n, shuffle=False)
        self.drop()
        return new

    def files(self) -> DataFrame:
        """The rows as plain files; the catalog entry goes, the files stay."""
        schema = self.read().schema
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
        return self.spark.read.schema(schema).parquet(self.path)

    def drop(self) -> None:
        """Remove the catalog entry and the files; nothing may read them any more."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
        delete_path(self.spark, self.path)


class HubSplitEdges:
    """Loop-invariant edges for joins on ``src``, hubs apart.

    Edges of ordinary sources are a table bucketed by ``src``.  Sources with
    more than ``HOT_KEY_ROWS`` edges would put all their edges into one
    bucket; their edges are a plain written table instead, spread over files,
    and meet the state rows of those sources - at most ``max_hot`` - by broadcast.
    """

    def __init__(self, edges: DataFrame, name: str, counts: DataFrame | None = None,
                 buckets: int | None = None):
        counts = counts if counts is not None else edges.groupBy("src").agg(F.count(F.lit(1)).alias("n"))
        count_col = next(c for c in counts.columns if c != "src")
        keys, _, rows = hot_keys(counts, "src", count_col)
        if buckets is None:
            least = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            buckets = max(least, rows // BUCKET_ROWS)
        self.keys = self.hot = None
        if keys is not None:
            self.keys = written_table(keys, f"{name}_hubs")
            self.hot = written_table(spread(edges.join(F.broadcast(self.keys), "src", "left_semi")), f"{name}_hot")
            edges = edges.join(F.broadcast(self.keys), "src", "left_anti")
        self.cold = BucketedTable(edges, "src", name, buckets)
        self.n = self.cold.n

    def join(self, state: DataFrame, key: str = "id") -> DataFrame:
        """Inner join of ``state`` (one row per ``key``) with the edges on ``src``.  The state is
        the hashed side, so the edges are neither moved nor sorted."""
        out = self.cold.read().join(state.hint("shuffle_hash"), F.col("src") == F.col(key))
        if self.hot is None:
            return out
        hubs = state.join(F.broadcast(self.keys), F.col(key) == self.keys["src"], "left_semi")
        return out.unionByName(self.hot.join(F.broadcast(hubs), F.col("src") == F.col(key)))

    def rows(self) -> DataFrame:
        """All edges."""
        return self.cold.read() if self.hot is None else self.cold.read().unionByName(self.hot)

    def drop(self) -> None:
        self.cold.drop()


class Small:
    """Frames of a loop kept in memory, each proven small when it is made.

    ``keep`` persists a frame (memory, else disk of the executors) and counts its rows, or those that
    fulfil a condition, which fills the cache.  A lost block is computed again from the frames
    before it; ``cut`` writes a frame to the shared folder instead, which bounds that chain (and the plan, which
    names all frames of the chain).  ``release`` gives up all kept frames but the given ones."""

    #: rounds between two written frames
    EVERY = 3

    def __init__(self):
        self.held: list[DataFrame] = []

    def keep(self, df: DataFrame, counted: Column | None = None) -> tuple[DataFrame, int]:
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
        self.held.append(df)
        return df, (df if counted is None else df.where(counted)).count()

    def cut(self, df: DataFrame, name: str) -> DataFrame:
        return written_table(df, name)

    def release(self, *but: DataFrame) -> None:
        for df in [h for h in self.held if not any(h is b for b in but)]:
            df.unpersist()
        self.held = [h for h in self.held if any(h is b for b in but)]


def global_rank(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """``df`` with its place in ``order`` as a bigint from 0.

    Rows are range-partitioned and sorted by ``order`` and written; a row's place is its number in its
    partition plus the sizes of the partitions before it, one row each, so no
    window runs over the table."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = written_table(df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                           .withColumn("_at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("_at", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_part", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_ahead"))
    within = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.withColumn("_part", part).join(F.broadcast(sizes), "_part") \
        .withColumn(name, F.col("_ahead") + within).drop("_part", "_at", "_ahead")


def chunked_lists(pairs: DataFrame, key: str, item: str, max_group: int = DEFAULT_MAX_GROUP
                  ) -> DataFrame:
    """Group ``item`` values by ``key`` into sorted lists of at most ``max_group`` items.

    Returns ``(key, chunk, items array<bigint>)``, duplicates kept: chunk ``c`` of a
    key holds its items ``c * max_group .. (c + 1) * max_group - 1`` in sorted
    order, so chunks are full but for the last, chunk 0 always exists, and
    the chunks in order are the key's sorted list.

    Duplicates are counted first (map-side).  The counts are range-partitioned
    by (key, item), which spreads a hub over partitions; an item's position is
    its place within its range partition plus what earlier partitions hold of
    its key.  Only keys that cross a partition border have such an offset, at
    most one per border, so the offsets are broadcast.
    """
    spark = pairs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counted = pairs.groupBy(key, item).agg(F.count(F.lit(1)).alias("_w"))
    # written: both readers below must see the same borders
    ranged = written_table(counted.repartitionByRange(parts, key, item)
                           .withColumn("_part", F.spark_partition_id()), "ranged")
    held = ranged.groupBy(key, "_part").agg(F.sum("_w").alias("_held"))
    ahead = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = held.withColumn("_ahead", F.sum("_held").over(ahead)).where(F.col("_ahead").isNotNull()) \
        .select(key, "_part", "_ahead")
    within = Window.partitionBy("_part", key).orderBy(item).rowsBetween(Window.unboundedPreceding, 0)
    placed = ranged.withColumn("_end", F.sum("_w").over(within)) \
        .join(F.broadcast(offsets), [key, "_part"], "left") \
        .withColumn("_end", F.col("_end") + F.coalesce("_ahead", F.lit(0)))
    g = F.lit(max_group)
    start = F.col("_end") - F.col("_w")
    cut = placed.select(key, item, start.alias("_start"), "_end", F.explode(F.sequence(
        F.call_function("div", start, g), F.call_function("div", F.col("_end") - 1, g))).alias("chunk"))
    n = F.least(F.col("_end"), (F.col("chunk") + 1) * g) - F.greatest(F.col("_start"), F.col("chunk") * g)
    grouped = cut.select(key, "chunk", item, n.alias("_n")).groupBy(key, "chunk").agg(
        F.sort_array(F.collect_list(F.struct(F.col(item).alias("v"), F.col("_n").alias("n"))))
        .alias("_vs"))
    items = F.flatten(F.transform("_vs", lambda s: F.array_repeat(s.getField("v"),
                                                                  s.getField("n").cast("int"))))
    return grouped.select(key, "chunk", items.alias("items"))
