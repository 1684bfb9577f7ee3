"""PageRank with dangling-mass redistribution (damping defaults to 1.0).

Per round: each vertex sends ``pr * m(u,v) / out(u)`` along its out-edges; a
vertex's new rank is the sum it receives plus an equal share of the mass held
by dangling vertices (no out-edge).  With damping d the result is
``(1-d)/n + d * (received + dangling/n)``.

Plan: the weighted edges and the vertices are written once as tables bucketed
by vertex id in the shared folder; the edges of hub sources are a separate
table that meets a broadcast of the hubs' ranks, so no bucket holds a hub's
edges.  Each round's ranks are written with the same buckets, which cuts
lineage and keeps the layout: the rank/edge join (ranks hashed, edges neither
moved nor sorted) and the vertex/contribution join need no exchange, and a
round shuffles only the per-target partial sums.  Rank total and dangling mass
of a round are observed by the job that writes it; a round's table is dropped
as soon as the next one is written.

A dangling vertex sends nothing on, so between two rounds only the mass of all of them counts.
Where most vertices dangle, all rounds but the last run over the other vertices and the edges
between them (:class:`Inner`); a vertex knows what share of its rank goes to dangling ones.  The
last round runs over all edges and gives every vertex its rank.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeframe.operators.common import BucketedTable, HubSplitEdges, bounded_broadcast, hot_key_join, written_table
from edgeframe.sources.tables import vertices_of


class Inner:
    """The vertices that have out-edges, with the share of their rank that goes to those without
    (``lost``), and the edges between them."""

    def __init__(self, adj: HubSplitEdges, live: DataFrame, od: DataFrame):
        ids, _ = bounded_broadcast(written_table(live.select(F.col("id").alias("dst")), "pr_live"))
        rows = adj.rows().where(F.col("dst").isNotNull())
        self.adj = HubSplitEdges(rows.join(ids, "dst", "left_semi").select("src", "dst", "share"), "pr_inner", od, adj.n)
        lost = rows.join(ids, "dst", "left_anti").groupBy(F.col("src").alias("id")).agg(F.sum("share").alias("lost"))
        self.vt = BucketedTable(live.join(lost, "id", "left").select("id", "dangling", F.coalesce("lost", F.lit(0.0)).alias("lost")),
                                "id", "pr_inner_vertices", adj.n)

    def drop(self) -> None:
        self.adj.drop()
        self.vt.drop()


def pagerank(edges: DataFrame, vertices: DataFrame | None = None, iters: int = 10,
             damping: float = 1.0, partitions: int | None = None
             ) -> tuple[DataFrame, DataFrame]:
    """Returns ``(ranks(id, pr), trace(round, metric, value))``.

    ``trace`` has, per round i, ``total`` = sum of ranks after round i and
    ``delta`` = dangling mass redistributed in round i.  Edges whose target is
    not in ``vertices`` carry no rank (their source is treated as dangling).
    """
    spark = edges.sparkSession
    if vertices is None:
        # every target is a vertex: no filtering join over the edge table
        verts, inside = vertices_of(edges), edges.select("src", "dst")
    else:
        verts = vertices.select("id").distinct()
        inside = edges.join(verts.select(F.col("id").alias("dst")), "dst", "left_semi")
    od = written_table(inside.groupBy("src").agg(F.count(F.lit(1)).alias("od")), "pr_out_degrees")
    weighted = hot_key_join(inside.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("w")), od, "src", "od") \
        .select("src", "dst", (F.col("w") / F.col("od")).alias("share"))
    adj = HubSplitEdges(weighted, "pr_edges", od, partitions)
    sums = (F.count(F.lit(1)).alias("n"), F.sum("pr").alias("total"),
            F.sum(F.when(F.col("dangling"), F.col("pr"))).alias("dmass"))
    vt = BucketedTable(
        verts.join(od.select(F.col("src").alias("id"), F.lit(False).alias("dangling")), "id", "left")
        .select("id", F.coalesce("dangling", F.lit(True)).alias("dangling")), "id", "pr_vertices", adj.n)
    n = vt.read().count()
    live = vt.read().where(~F.col("dangling"))
    n_live = live.count()
    n_dangling = n - n_live
    inner = Inner(adj, live, od) if iters > 1 and 0 < 2 * n_live <= n else None
    inner_sums = (F.sum("pr").alias("total"), F.sum(F.col("pr") * F.col("lost")).alias("lost"))
    start = inner.vt if inner else vt
    pr = BucketedTable(start.read().withColumn("pr", F.lit(1.0 / n if n else 0.0)), "id", "pr_round0", adj.n,
                       shuffle=False, metrics=(inner_sums if inner else sums) if n else ())
    dmass = n_dangling / n if n else 0.0
    rows = []
    for i in range(1, iters + 1) if n else ():
        within = inner is not None and i < iters
        of, at = (inner.adj, inner.vt) if within else (adj, vt)
        nxt = BucketedTable(pagerank_round(pr.read(), of, at.read(), n, damping, dmass), "id",
                            f"pr_round{i}", adj.n, shuffle=False, metrics=inner_sums if within else sums)
        rows.append((i, "delta", float(dmass)))
        if within:
            # every dangling vertex gets what the others send and its part of their own mass
            dmass = damping * (pr.seen["lost"] + n_dangling * dmass / n) + n_dangling * (1.0 - damping) / n
            rows.append((i, "total", nxt.seen["total"] + dmass))
        else:
            dmass = nxt.seen["dmass"] or 0.0
            rows.append((i, "total", nxt.seen["total"]))
        pr.drop()
        pr = nxt
    if inner:
        inner.drop()
    ranks = pr.files().select("id", "pr")
    vt.drop()
    adj.drop()
    return ranks, spark.createDataFrame(rows, "round bigint, metric string, value double")


def pagerank_round(pr: DataFrame, adj: HubSplitEdges, vt: DataFrame, n: int,
                   damping: float = 1.0, dmass: float | None = None) -> DataFrame:
    """One round: the columns of ``vt`` and ``pr`` from the previous ranks.

    ``pr`` and ``vt`` are bucketed by ``id`` and ``adj`` (:class:`HubSplitEdges`) by
    ``src`` with one bucket count, so the only exchange is the partial
    per-target sums.
    ``dmass`` is the dangling mass of ``pr`` when already known; otherwise it
    is a scalar subquery over ``pr``.
    """
    recv = adj.join(pr.select(F.col("id").alias("from"), "pr"), "from") \
        .groupBy(F.col("dst").alias("id")).agg(F.sum(F.col("pr") * F.col("share")).alias("c"))
    if dmass is None:
        dmass = pr.where("dangling").agg(F.coalesce(F.sum("pr"), F.lit(0.0))).scalar()
    else:
        dmass = F.lit(float(dmass))
    new_pr = F.lit(damping) * (F.coalesce(F.col("c"), F.lit(0.0)) + dmass / F.lit(float(n))) \
        + F.lit((1.0 - damping) / n)
    return vt.join(recv, "id", "left").select(*vt.columns, new_pr.alias("pr"))


def in_contributions(edges: DataFrame, vertices: DataFrame | None = None) -> DataFrame:
    """One propagation step from rank 1 everywhere: ``(id, contrib)``.

    ``contrib(v) = sum over u->v of 1/out(u)``; vertices with no in-edge keep 0
    (a left join to the vertex set, not a union with a zero list).
    """
    verts = (vertices if vertices is not None else vertices_of(edges)).select("id").distinct()
    od = edges.groupBy("src").agg(F.count(F.lit(1)).alias("od"))
    weighted = edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("w"))
    recv = hot_key_join(weighted, od, "src", "od").groupBy(F.col("dst").alias("id")) \
        .agg(F.sum(F.col("w") / F.col("od")).alias("c"))
    return verts.join(recv, "id", "left").select(
        "id", F.coalesce(F.col("c"), F.lit(0.0)).alias("contrib"))
