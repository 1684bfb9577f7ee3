"""Single-source shortest paths and eccentricity summaries.

Each round expands only the vertices that the round before reached (unit weights)
or improved (weights); after ``r`` rounds a distance is the shortest over paths of
at most ``r`` edges, as in the reference's fixed-round loops.  The loop stops early
when a round changes nothing (same result).

Where the edges are proven few (:data:`SMALL_ROWS` distinct ones) edges and state
stay in memory, released round by round, and the state is written every few
rounds.  Beyond that the edges are written once, bucketed by ``src``, hub sources
apart, and the state is a bucketed table that grows by appends (a frontier BFS
with an anti-join, or improvements): a round moves only the newly reached ids or
candidate distances.  Such a table is rewritten when superseded rows outnumber
the live ones or its files become many.

A loop can go on from a written round: ``state`` holds the distances after round
``first_round - 1`` (``files.read_search_state``).

Unreached vertices are NULL inside and the sentinel 2147483647 on output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeframe.operators.adjacency import adjacency_list
from edgeframe.operators.common import (DEFAULT_BROADCAST_ROWS, EXACT_CHECK_BYTES, BucketedTable, HubSplitEdges, Small)
from edgeframe.plans.inspect import estimated_bytes
from edgeframe.sources.tables import vertices_of

SENTINEL = 2147483647

#: distinct edges up to which a loop's data stays in memory
SMALL_ROWS = DEFAULT_BROADCAST_ROWS

#: appends after which a state table's files are merged
MOST_APPENDS = 8


def _seed(edges: DataFrame, source: int) -> DataFrame:
    spark = edges.sparkSession
    return spark.range(1).select(F.lit(source).cast("bigint").alias("id"),
                                 F.lit(0).cast("bigint").alias("dist"))


def _start(edges: DataFrame, source: int, state: DataFrame | None, first_round: int) -> DataFrame:
    """``(id, dist, round)`` before ``first_round``: the source alone, or the finite distances of a
    written round.  ``round`` is when a vertex last changed: the round before for those that are
    still to be expanded, else -1.  Marked (visited) vertices have been expanded; without marks
    every vertex may be expanded again, which changes no distance."""
    if state is None:
        return _seed(edges, source).withColumn("round", F.lit(first_round - 1).cast("bigint"))
    known = finite(state)
    done = F.col("visited") if "visited" in state.columns else F.lit(False)
    return known.groupBy("id").agg(F.min("dist").alias("dist"), F.min(
        F.when(done, -1).otherwise(first_round - 1).cast("bigint")).alias("round"))


def bfs(edges: DataFrame, source: int, rounds: int, state: DataFrame | None = None,
        first_round: int = 1) -> tuple[DataFrame, DataFrame]:
    """Hop distances of vertices reached within ``rounds`` hops.

    Returns ``(dist(id, dist), trace(round, n_updated))``.  With ``state`` the loop begins at
    ``first_round``; the trace then counts the earlier rounds from the state's distances.
    """
    pairs = edges.select("src", "dst").distinct()
    start = _start(edges, source, state, first_round)
    kept = _relax_in_memory(pairs.withColumn("w", F.lit(1).cast("bigint")), start, rounds, first_round)
    dist = kept[0] if kept else _bfs_bucketed(pairs, start.select("id", "dist"), rounds, first_round)
    trace = dist.where(F.col("dist") > 0).groupBy(F.col("dist").alias("round")) \
        .agg(F.count(F.lit(1)).alias("n_updated"))
    return dist, trace


def _reached(r: int) -> list:
    return ["id", F.lit(r).cast("bigint").alias("dist")]


def _bfs_bucketed(pairs: DataFrame, start: DataFrame, rounds: int, first: int) -> DataFrame:
    """The visited set is one table bucketed by id; the frontier is its ``dist = r - 1`` slice
    (older files are skipped by parquet statistics).  A round's only exchange carries the newly
    reached ids; the edge table and the visited set are read in place."""
    adj = HubSplitEdges(pairs, "bfs_edges")
    visited = BucketedTable(start, "id", "bfs_visited", adj.n)
    for r in range(first, rounds + 1):
        seen = visited.read()
        frontier = seen.where(F.col("dist") == r - 1)
        reached = adj.join(frontier.select("id")).select(F.col("dst").alias("id"))
        new = reached.distinct().join(seen.select("id"), "id", "left_anti")
        if visited.append(new.select(*_reached(r))) == 0:
            break
        if visited.appends >= MOST_APPENDS:
            visited = visited.compacted(visited.read(), "bfs_visited")
    dist = visited.files()
    adj.drop()
    return dist


def bellman_ford(edges: DataFrame, source: int, rounds: int, weight: str = "w", state: DataFrame | None = None,
                 first_round: int = 1) -> tuple[DataFrame, DataFrame]:
    """Hop-bounded weighted distances; ``edges`` carries a non-negative ``weight``.

    Returns ``(dist(id, dist), trace(round, n_updated))``; with ``state`` the loop begins at
    ``first_round`` and the trace has its own rounds only.
    """
    lightest = edges.groupBy("src", "dst").agg(F.min(weight).cast("bigint").alias("w"))
    start = _start(edges, source, state, first_round)
    dist, updates = _relax_in_memory(lightest, start, rounds, first_round) \
        or _relax_bucketed(lightest, start, rounds, first_round)
    trace = edges.sparkSession.createDataFrame(updates, "round bigint, n_updated bigint")
    return dist, trace


def _candidates(joined: DataFrame) -> DataFrame:
    return joined.groupBy(F.col("dst").alias("id")).agg(F.min(F.col("dist") + F.col("w")).alias("nd"))


def _relax_in_memory(lightest: DataFrame, start: DataFrame, rounds: int, first: int
                     ) -> tuple[DataFrame, list] | None:
    """Edges and state stay cached; None where the edges are too many for that.

    The state has one live row per vertex, replaced each round by one aggregate of it and the
    candidates; of equal distances the older round stays, so a vertex changed only if it got
    nearer.  The active rows, at most as many as the edges have targets, are broadcast to the edges."""
    if estimated_bytes(lightest) > EXACT_CHECK_BYTES:
        return None
    small, updates = Small(), []
    adj, n_edges = small.keep(lightest)
    if n_edges > SMALL_ROWS:
        small.release()
        return None
    live = start
    for r in range(first, rounds + 1):
        active = live.where(F.col("round") == r - 1).select(F.col("id").alias("src"), "dist")
        cand = _candidates(adj.join(F.broadcast(active), "src"))
        both = live.union(cand.select("id", F.col("nd").alias("dist"), F.lit(r).cast("bigint").alias("round")))
        nxt = both.groupBy("id").agg(F.min(F.struct("dist", "round")).alias("m")).select("id", "m.dist", "m.round")
        nxt, n = small.keep(nxt, F.col("round") == r)
        over = n == 0 or r == rounds
        if over or (r - first) % small.EVERY == small.EVERY - 1:
            nxt = small.cut(nxt, "search_state")
        small.release(adj, nxt)
        live = nxt
        updates += [(r, n)] * (n > 0)
        if over:
            break
    small.release()
    return live.select("id", "dist"), updates


def _relax_bucketed(lightest: DataFrame, start: DataFrame, rounds: int, first: int) -> tuple[DataFrame, list]:
    """Improvements are appended round by round to one table bucketed by id.  The current distance
    of a vertex is the minimum of its rows (grouped by the bucket key, so without an exchange) and
    the active set is the newest round's slice.  When the rows are more than twice those of
    the last compaction, or the files many, the table is rewritten with one row per vertex, so
    a round reads at most about twice the live rows."""
    adj = HubSplitEdges(lightest, "bf_edges")
    state = BucketedTable(start, "id", "bf_state", adj.n)
    live, updates = state.count(), []
    for r in range(first, rounds + 1):
        seen = state.read()
        best = seen.groupBy("id").agg(F.min("dist").alias("od"))
        active = seen.where(F.col("round") == r - 1)
        improved = _candidates(adj.join(active.select("id", "dist"))).join(best, "id", "left") \
            .where(F.col("od").isNull() | (F.col("nd") < F.col("od"))) \
            .select("id", F.col("nd").alias("dist"), F.lit(r).cast("bigint").alias("round"))
        n = state.append(improved)
        if n == 0:
            break
        updates.append((r, n))
        if state.count() > 2 * live or state.appends >= MOST_APPENDS:
            least = state.read().groupBy("id").agg(F.min(F.struct("dist", "round")).alias("m"))
            state = state.compacted(least.select("id", "m.dist", "m.round"), "bf_state")
            live = state.count()
    final = state.files()
    adj.drop()
    return final.groupBy("id").agg(F.min("dist").alias("dist")), updates


def sssp(edges: DataFrame, source: int, rounds: int = 10, weight: str | None = None,
         vertices: DataFrame | None = None, sentinel: bool = True, state: DataFrame | None = None,
         first_round: int = 1) -> DataFrame:
    """``(id, dist)`` for every vertex; unreached get 2147483647 (or NULL).

    ``state`` and ``first_round`` go on from the distances that ``first_round - 1`` rounds gave."""
    if weight is None:
        dist, _ = bfs(edges, source, rounds, state, first_round)
    else:
        dist, _ = bellman_ford(edges, source, rounds, weight, state, first_round)
    verts = vertices if vertices is not None else vertices_of(edges)
    out = verts.select("id").join(dist, "id", "left")
    d = F.coalesce(F.col("dist"), F.lit(SENTINEL).cast("bigint")) if sentinel else F.col("dist")
    return out.select("id", d.alias("dist"))


def search_state(edges: DataFrame, dist: DataFrame, last_round: int, weighted: bool = False) -> DataFrame:
    """``(id, nbrs, dist, visited)`` after ``last_round`` rounds of the unit-weight search, for
    ``files.write_search_state``: neighbours once each, hubs in several rows.  A vertex is visited
    once it has been expanded; in a weighted search any vertex may still be improved."""
    nbrs = adjacency_list(edges.select("src", "dst").distinct()).select("id", "nbrs")
    done = F.lit(False) if weighted else F.col("dist") < last_round
    return dist.join(nbrs, "id", "left").select(
        "id", F.coalesce("nbrs", F.array().cast("array<bigint>")).alias("nbrs"), "dist", done.alias("visited"))


def initial_distances(vertices: DataFrame, source: int) -> DataFrame:
    """Round-0 state: 0 at the source, unreached elsewhere (sentinel on output)."""
    d = F.when(F.col("id") == source, F.lit(0).cast("bigint")).otherwise(
        F.lit(SENTINEL).cast("bigint"))
    return vertices.select("id", d.alias("dist"))


def finite(dist: DataFrame) -> DataFrame:
    return dist.where(F.col("dist").isNotNull() & (F.col("dist") != SENTINEL))


def longest_distance(dist: DataFrame) -> DataFrame:
    """Largest finite distance, 0 when nothing is finite (one row ``longest``)."""
    return finite(dist).agg(F.coalesce(F.max("dist"), F.lit(0).cast("bigint")).alias("longest"))


def farthest_vertex(dist: DataFrame) -> DataFrame:
    """``(dist, id)`` of the farthest finite vertex; ties go to the smallest id."""
    best = F.max(F.struct(F.col("dist"), (-F.col("id")).alias("nid")))
    return finite(dist).agg(best.alias("b")).select(
        F.col("b.dist").alias("dist"), (-F.col("b.nid")).alias("id"))


def top1_by_distance(dist: DataFrame) -> DataFrame:
    return finite(dist).orderBy(F.col("dist").desc(), F.col("id")).limit(1).select("id", "dist")
