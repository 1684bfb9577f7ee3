"""Edge and point views over the driver's parquet tables.

Each view is a lazy projection of one table, so Catalyst prunes the scan to the
two key columns and pushes any later filter into the parquet reader.  Ids are
``bigint``; rows with a null id are dropped on read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _edges(df: DataFrame, src: Column, dst: Column) -> DataFrame:
    out = df.select(src.cast("bigint").alias("src"), dst.cast("bigint").alias("dst"))
    return out.where(F.col("src").isNotNull() & F.col("dst").isNotNull())


def edges_ps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``E_ps``: part -> supplier, one edge per lineitem (a multigraph)."""
    li = load_table(spark, sf_dir, "lineitem")
    return _edges(li, F.col("l_partkey"), F.col("l_suppkey"))


def edges_sp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``E_sp``: supplier -> part, the reverse of ``E_ps``.

    Only supplier ids have out-edges, so most part vertices are dangling: the
    natural input for PageRank's dangling-mass redistribution.
    """
    li = load_table(spark, sf_dir, "lineitem")
    return _edges(li, F.col("l_suppkey"), F.col("l_partkey"))


def edges_co(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``E_co``: customer -> (order key mod customer count), one edge per order.

    The modulus is a scalar subquery over ``customer``, so the vertex space
    follows the table size at every scale factor.
    """
    orders = load_table(spark, sf_dir, "orders")
    n_cust = load_table(spark, sf_dir, "customer").select(F.count(F.lit(1))).scalar()
    return _edges(orders, F.col("o_custkey"), F.col("o_orderkey") % n_cust)


def points_chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``V_chars``: one 1-D point per document, ``(id, v)`` = (doc_id, n_chars)."""
    docs = load_table(spark, sf_dir, "documents")
    return (docs.select(F.col("doc_id").cast("bigint").alias("id"),
                        F.col("n_chars").cast("bigint").alias("v"))
            .where(F.col("v").isNotNull()))


def vertices_of(edges: DataFrame) -> DataFrame:
    """All endpoint ids, once each (``src`` union ``dst``)."""
    return (edges.select(F.col("src").alias("id"))
            .union(edges.select(F.col("dst").alias("id")))
            .distinct())


def chain_graph(ids: DataFrame, k: int) -> DataFrame:
    """Chains of ``k`` consecutive ids; the last id of a chain points to dummy 0.

    ``ids`` is a one-column frame ``id`` of positive integers.  Vertex ``i``
    links to ``i + 1`` unless ``i`` closes a chain (``i % k == 0``) or is the
    largest id; those link to 0, which is not a vertex, so PageRank treats
    them as dangling.  With ``ids = 1..k*k`` this is the k-chain test graph.
    """
    top = ids.select(F.max("id")).scalar()
    i = F.col("id")
    nxt = F.when((i % k != 0) & (i < top), i + 1).otherwise(F.lit(0).cast("bigint"))
    return ids.select(i.cast("bigint").alias("src"), nxt.cast("bigint").alias("dst"))


def chain_over_keys(spark: SparkSession, sf_dir: str, k: int = 100) -> DataFrame:
    """The chain graph laid over the customer key space (``c_custkey + 1``)."""
    cust = load_table(spark, sf_dir, "customer")
    ids = cust.select((F.col("c_custkey") + 1).cast("bigint").alias("id")).where(
        F.col("id").isNotNull())
    return chain_graph(ids, k)
