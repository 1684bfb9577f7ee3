"""Edge list <-> adjacency list, and the per-row list functions used with it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeframe.functions.scalar import append_value, contains_value, joined
from edgeframe.operators.common import DEFAULT_MAX_GROUP, chunked_lists


def adjacency_list(edges: DataFrame, max_group: int = DEFAULT_MAX_GROUP) -> DataFrame:
    """``(id, chunk, nbrs array<bigint>)``: neighbours sorted, duplicates kept.

    One row per source vertex unless it has more than ``max_group`` out-edges;
    such a hub's sorted list is cut into chunks 0, 1, ... of ``max_group`` items
    (the last may have fewer), so no single task holds its whole list.
    """
    lists = chunked_lists(edges.select(F.col("src").alias("id"), "dst"), "id", "dst", max_group)
    return lists.select("id", "chunk", F.col("items").alias("nbrs"))


def adjacency_text(adj: DataFrame) -> DataFrame:
    """``(id, chunk, adj)`` with the neighbour list as a ``n1,n2,...`` string."""
    return adj.select("id", "chunk", joined(F.col("nbrs")).alias("adj"))


def edges_from_adjacency(adj: DataFrame) -> DataFrame:
    """Inverse of :func:`adjacency_list`: one ``(src, dst)`` row per list element."""
    return adj.select(F.col("id").alias("src"), F.explode("nbrs").alias("dst"))


def explode_messages(adj: DataFrame) -> DataFrame:
    """One message ``(neighbour, sender)`` per list element plus one self row per vertex.

    The ``flatMap`` of the reference's search step, without distances.
    """
    to_nbrs = adj.select(F.explode("nbrs").alias("id"), F.col("id").alias("msg"))
    own = adj.select("id").distinct()
    return to_nbrs.unionByName(own.select("id", F.col("id").alias("msg")))


def append_marker(adj: DataFrame, value: int) -> DataFrame:
    """``(id, chunk, adj)``: the sorted list with ``value`` appended, joined by ``,``; of a list in
    chunks the last one gets it."""
    last = adj.groupBy("id").agg(F.max("chunk").alias("chunk")).withColumn("last", F.lit(True))
    nbrs = F.when(F.col("last"), append_value(F.col("nbrs"), value)).otherwise(F.col("nbrs"))
    return adj.join(last, ["id", "chunk"], "left").select("id", "chunk", joined(nbrs).alias("adj"))


def vertices_listing(adj: DataFrame, value: int) -> DataFrame:
    """Vertices whose neighbour list contains ``value``."""
    return adj.where(contains_value(F.col("nbrs"), value)).select("id").distinct()
