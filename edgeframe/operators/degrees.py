"""Follower counts (in-degree), degree pairs and 2-hop cardinality estimates.

All counts use built-in aggregates, which Spark runs as partial aggregation
before the shuffle (the combiner of the reference), so a hot vertex costs one
row per map task in the exchange, not one row per edge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeframe.operators.common import big_sum, wide


def _one():
    return F.lit(1).cast("bigint")


def in_degree(edges: DataFrame) -> DataFrame:
    """``groupBy(dst).count()`` -> ``(id, followers)``."""
    return edges.groupBy(F.col("dst").alias("id")).count().withColumnRenamed("count", "followers")


def in_degree_reduce(edges: DataFrame) -> DataFrame:
    """Sum of ones per target (``reduceByKey(_ + _)`` / ``aggregateByKey``)."""
    return edges.groupBy(F.col("dst").alias("id")).agg(F.sum(_one()).alias("followers"))


def in_degree_fold_zero(edges: DataFrame, vertices: DataFrame | None = None) -> DataFrame:
    """Fold with zero over the full vertex set: vertices without in-edges get 0."""
    if vertices is None:        # both endpoints from one tagged aggregate: two scans, one exchange
        ends = edges.select(F.col("dst").alias("id"), _one().alias("n")).union(
            edges.select(F.col("src").alias("id"), F.lit(0).cast("bigint").alias("n")))
        return ends.groupBy("id").agg(F.sum("n").alias("followers"))
    counts = in_degree_reduce(edges)
    return vertices.join(counts, "id", "left").select(
        "id", F.coalesce(F.col("followers"), F.lit(0).cast("bigint")).alias("followers"))


def in_degree_group_collect(edges: DataFrame) -> DataFrame:
    """Materialise each target's group, fold it, and sum the pieces.

    The twin of ``groupByKey(...).map(sum)``: groups are real lists, but a
    target's group is built per input partition, so no list is longer than a
    partition and a hot target is spread over as many lists as partitions.
    """
    tagged = edges.select(F.col("dst").alias("id"), _one().alias("one")) \
        .withColumn("part", F.spark_partition_id())
    groups = tagged.groupBy("id", "part").agg(F.collect_list("one").alias("ones"))
    folded = groups.select("id", F.aggregate("ones", F.lit(0).cast("bigint"),
                                             lambda acc, x: acc + x).alias("n"))
    return folded.groupBy("id").agg(F.sum("n").alias("followers"))


def group_avg(df: DataFrame, key: str, value: str, out: str = "avg_v", digits: int = 9) -> DataFrame:
    return df.groupBy(F.col(key).alias("id")).agg(F.round(F.avg(value), digits).alias(out))


def degree_pairs(edges: DataFrame) -> DataFrame:
    """``(id, out_deg, in_deg)`` from one tagged union and one aggregate.

    A single shuffle replaces the full-outer join of two degree maps; an
    absent side is 0.
    """
    tagged = edges.select(F.col("src").alias("id"), _one().alias("o"), F.lit(0).cast("bigint").alias("i")) \
        .union(edges.select(F.col("dst").alias("id"), F.lit(0).cast("bigint").alias("o"), _one().alias("i")))
    return tagged.groupBy("id").agg(F.sum("o").alias("out_deg"), F.sum("i").alias("in_deg"))


def path2_cardinality(edges: DataFrame) -> DataFrame:
    """Per-vertex 2-hop estimate: ``out*in``, but ``in`` if out = 0 and ``out`` if in = 0
    (decimal(38,0), so hubs cannot overflow)."""
    d = degree_pairs(edges)
    o, i = F.col("out_deg"), F.col("in_deg")
    card = F.when(o == 0, wide(i)).when(i == 0, wide(o)).otherwise(wide(o) * wide(i))
    return d.select("id", card.cast("decimal(38,0)").alias("cardinality"))


def path2_cardinality_total(edges: DataFrame) -> DataFrame:
    return path2_cardinality(edges).agg(big_sum(F.col("cardinality")).alias("total"))


def path2_exact_total(edges: DataFrame) -> DataFrame:
    """Exact number of 2-paths, ``sum(out*in)``, without executing the join."""
    d = degree_pairs(edges)
    return d.agg(big_sum(wide(F.col("out_deg")) * wide(F.col("in_deg"))).alias("total"))
