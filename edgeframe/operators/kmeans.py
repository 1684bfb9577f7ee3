"""1-D k-means with integer means and equal-interval seeding.

Assignment is a narrow expression over a literal array of the K current
centroids (no join, no shuffle of points); the update is one partial
aggregate per round whose K-row result is materialised and read back, the
only driver round trip (bounded by K).  Rules kept from the reference:
integer (truncating) means, SSE measured against the pre-update centroid,
empty clusters disappear, ties go to the smallest centroid.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from edgeframe.functions.scalar import nearest_value
from edgeframe.operators.common import big_sum, cut_lineage, hot_key_join, wide, written_table


def value_range(points: DataFrame, col: str = "v") -> DataFrame:
    """``(mn, mx)`` with both extremes anchored at 0 (min <= 0 <= max)."""
    return points.agg(F.least(F.lit(0).cast("bigint"), F.min(col)).alias("mn"),
                      F.greatest(F.lit(0).cast("bigint"), F.max(col)).alias("mx"))


def equal_interval_seeds(points: DataFrame, k: int, col: str = "v") -> DataFrame:
    """``k + 1`` values ``mn + i * ((mn + mx) div k)``, i = 0..k (one column ``centroid``)."""
    r = value_range(points, col)
    step = F.call_function("div", F.col("mn") + F.col("mx"), F.lit(k))
    return r.select("mn", step.alias("step"), F.explode(F.sequence(F.lit(0), F.lit(k))).alias("i")) \
        .select((F.col("mn") + F.col("i") * F.col("step")).cast("bigint").alias("centroid"))


def _centroid_list(centroids) -> list[int]:
    if isinstance(centroids, DataFrame):
        centroids = [r[0] for r in centroids.select("centroid").distinct().collect()]
    return sorted({int(c) for c in centroids})


def assign(points: DataFrame, centroids, col: str = "v") -> DataFrame:
    """``(v, centroid)``: each point with its nearest centroid."""
    cs = _centroid_list(centroids)
    return points.select(F.col(col).alias("v"), nearest_value(F.col(col), cs).alias("centroid"))


def assign_many(points: DataFrame, centroids: DataFrame, col: str = "v") -> DataFrame:
    """``(v, centroid)`` as :func:`assign`, for any number of centroids in a table.

    The distinct values and the centroids are range-partitioned together and written; within a
    partition a value's neighbours are the last centroid at or before it and the first at or after
    it, and where a partition has none, the nearest of the partitions beside it (one row
    per partition, broadcast).  The values' answers meet the points again by a join that
    splits hot values.  Ties go to the smaller centroid; a null point, or any without
    centroids, gets none.
    """
    spark = points.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pts = points.select(F.col(col).cast("bigint").alias("v"))
    values = pts.where(F.col("v").isNotNull()).groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    cs = centroids.select(F.col("centroid").cast("bigint").alias("v")).where(F.col("v").isNotNull()).distinct()
    null = F.lit(None).cast("bigint")
    both = values.select("v", "n", null.alias("c")).unionByName(cs.select("v", null.alias("n"), F.col("v").alias("c")))
    ranged = written_table(both.repartitionByRange(parts, "v").withColumn("part", F.spark_partition_id()), "value_line")
    ends = ranged.groupBy("part").agg(F.max("c").alias("top"), F.min("c").alias("low"))
    line = Window.orderBy("part")
    ends = ends.select("part", F.last("top", True).over(line.rowsBetween(Window.unboundedPreceding, -1)).alias("before"),
                       F.first("low", True).over(line.rowsBetween(1, Window.unboundedFollowing)).alias("after"))
    own = Window.partitionBy("part").orderBy("v")
    down = F.last("c", True).over(own.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    # the first centroid after a value is the last one on the way down
    up = F.last("c", True).over(Window.partitionBy("part").orderBy(F.col("v").desc())
                                .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    near = ranged.withColumns({"down": down, "up": up}).where(F.col("n").isNotNull()).join(F.broadcast(ends), "part") \
        .select("v", "n", F.coalesce("down", "before").alias("down"), F.coalesce("up", "after").alias("up"))
    gap = lambda a, b: wide(F.col(a)) - wide(F.col(b))
    nearest = F.when(F.col("up").isNull() | (gap("v", "down") <= gap("up", "v")), F.col("down")).otherwise(F.col("up"))
    answers = near.select("v", "n", nearest.alias("centroid"))
    found = hot_key_join(pts.where(F.col("v").isNotNull()), answers, "v", "n").select("v", "centroid")
    return found.unionByName(pts.where(F.col("v").isNull()).select("v", null.alias("centroid")))


def cluster_update(points: DataFrame, centroids, col: str = "v") -> DataFrame:
    """One round: ``(old_centroid, centroid, n, sse)`` per non-empty cluster; sse is decimal(38,0)."""
    a = assign(points, centroids, col)
    c, v = F.col("centroid"), F.col("v")
    return a.groupBy(c.alias("old_centroid")).agg(
        F.call_function("div", big_sum(wide(v)), F.count(F.lit(1))).alias("centroid"),
        F.count(F.lit(1)).alias("n"),
        big_sum((wide(c) - wide(v)) * (wide(c) - wide(v))).alias("sse"))


def kmeans_1d(points: DataFrame, seeds, iters: int = 10, col: str = "v",
              materialize: bool = True, first_round: int = 1) -> tuple[DataFrame, DataFrame]:
    """Run rounds ``first_round`` to ``iters``.  Returns ``(clusters, trace)``.

    With the centroids that an earlier round wrote (``files.read_centroids``) as ``seeds`` and the
    number of the next round, the loop goes on where that round ended.

    ``materialize`` writes the point column once to the shared folder (use it
    when points are derived, e.g. follower counts); a plain column of a
    parquet table is re-scanned each round instead.

    ``clusters``: ``(centroid, n, sse)`` of the last round (updated centroid,
    size, SSE against the centroid the points were assigned to).
    ``trace``: ``(round, sse)`` total SSE per round.
    """
    if iters < first_round:
        raise ValueError("kmeans_1d needs at least one round")
    pts = points.select(F.col(col).alias("v")).where(F.col("v").isNotNull())
    if materialize:
        pts = written_table(pts, "kmeans_points")
    cs = _centroid_list(seeds)
    rounds, last = [], None
    for r in range(first_round, iters + 1):
        stats = cut_lineage(cluster_update(pts, cs))
        rounds.append(stats.agg(F.lit(r).cast("bigint").alias("round"),
                                big_sum(F.col("sse")).alias("sse")))
        cs = _centroid_list(stats)
        last = stats
    clusters = last.select("centroid", "n", "sse")
    return clusters, reduce(lambda a, b: a.unionByName(b), rounds)
