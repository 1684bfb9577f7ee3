"""Deterministic vertex sample and the edges leaving it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeframe.operators.common import bounded_broadcast, global_rank, written_table


def sample_vertices(vertices: DataFrame, k: int, seed: int = 42, forced: int | None = 1) -> DataFrame:
    """``k`` vertices by the order of ``md5('<seed>-<id>')`` (ties by id), plus ``forced``.

    ``orderBy(...).limit(k)`` plans as a per-task top-k and a k-row merge,
    so only O(tasks * k) rows move.  The forced vertex is added only if it
    exists in ``vertices``.
    """
    ids = vertices.select("id").distinct()
    key = F.md5(F.concat(F.lit(f"{seed}-"), F.col("id").cast("string")))
    top = ids.orderBy(key, "id").limit(k)
    if forced is None:
        return top
    return top.union(ids.where(F.col("id") == forced)).distinct()


def draw_vertices(vertices: DataFrame, k: int, seed: int = 42, forced: int | None = 1) -> DataFrame:
    """``k`` draws with replacement: ``(id, draws)``, how often each drawn vertex was drawn.

    Draw ``i`` is the vertex at place ``md5('<seed>-<i>') mod n`` of the n vertices in the order of
    their ids (60 bits of the digest); places come from :func:`global_rank`, draws are made where they are needed
    and counted before they move.  ``forced`` is one draw more of that vertex, if it exists.
    No draw comes of an empty vertex set.
    """
    spark = vertices.sparkSession
    placed = global_rank(vertices.select("id").where(F.col("id").isNotNull()).distinct(), [F.col("id")], "place")
    n = placed.count()
    digest = F.md5(F.concat(F.lit(f"{seed}-"), F.col("id").cast("string")))
    draws = spark.range(k).select((F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint") % F.lit(max(n, 1))).alias("place"))
    counted, _ = bounded_broadcast(draws.groupBy("place").agg(F.count(F.lit(1)).alias("draws")))
    drawn = placed.join(counted, "place").select("id", "draws")
    if forced is None:
        return drawn
    more = placed.where(F.col("id") == forced).select("id", F.lit(1).cast("bigint").alias("draws"))
    return drawn.unionByName(more).groupBy("id").agg(F.sum("draws").alias("draws"))


def sample_edges(edges: DataFrame, sample: DataFrame) -> DataFrame:
    """Edges whose source is in ``sample`` (a left-semi join).

    The sample has k+1 rows with k the caller's: it is written once and
    broadcast only if its size is proven small, else the join shuffles.
    """
    side, _ = bounded_broadcast(written_table(sample.select(F.col("id").alias("src")), "sample"))
    return edges.join(side, "src", "left_semi")
