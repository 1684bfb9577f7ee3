"""Single-operator edge queries: filter, projection, reversal, sets, ordering."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def filter_max_id(edges: DataFrame, max_id: int) -> DataFrame:
    """Keep edges whose two ids are both ``<= max_id`` (map-only, pushed to the scan)."""
    return edges.where((F.col("src") <= max_id) & (F.col("dst") <= max_id))


def reverse_edges(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))


def distinct_vertices(edges: DataFrame) -> DataFrame:
    """``src`` union ``dst`` as a set."""
    return edges.select(F.col("src").alias("id")).union(
        edges.select(F.col("dst").alias("id"))).distinct()


def union_with_zeros(edges: DataFrame) -> DataFrame:
    """Bag union of in-messages ``(dst, src)`` and one zero row per source.

    The pattern keeps vertices without in-messages in a later aggregate.
    """
    msgs = edges.select(F.col("dst").alias("id"), F.col("src").alias("v"))
    zeros = edges.select(F.col("src").alias("id")).distinct().select(
        "id", F.lit(0).cast("bigint").alias("v"))
    return msgs.unionByName(zeros)


def union_three_min(edges: DataFrame) -> DataFrame:
    """Three message sets unioned, then the minimum per id.

    Forward messages ``(dst, src)``, backward ``(src, dst)`` and a self row
    ``(src, src)``.  Partial aggregation runs before the shuffle.
    """
    fwd = edges.select(F.col("dst").alias("id"), F.col("src").alias("v"))
    bwd = edges.select(F.col("src").alias("id"), F.col("dst").alias("v"))
    own = edges.select(F.col("src").alias("id"), F.col("src").alias("v"))
    return fwd.unionByName(bwd).unionByName(own).groupBy("id").agg(F.min("v").alias("v"))


def min_per_key(edges: DataFrame) -> DataFrame:
    """Smallest source per target."""
    return edges.groupBy(F.col("dst").alias("id")).agg(F.min("src").alias("v"))


def sort_by_key(df: DataFrame, key: str = "id") -> DataFrame:
    return df.orderBy(key)


def top_rows(df: DataFrame, order, n: int) -> DataFrame:
    """First ``n`` rows of a total order (TakeOrderedAndProject: top-n per task)."""
    return df.orderBy(*order).limit(n)
