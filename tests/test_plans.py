"""Plan shape: pushdown, partial aggregation, chosen joins, no Python, no cartesian."""

from edgeframe.operators import degrees, paths, relational
from edgeframe.plans.inspect import plan_text
from edgeframe.sources.tables import edges_ps
from tests.conftest import SF001


def test_filter_is_pushed_and_map_only(spark):
    p = plan_text(relational.filter_max_id(edges_ps(spark, SF001), 100))
    assert "PushedFilters" in p and "LessThanOrEqual(l_partkey,100)" in p
    assert "Exchange" not in p
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint>" in p


def test_in_degree_partial_aggregation(spark):
    p = plan_text(degrees.in_degree(edges_ps(spark, SF001)))
    assert "partial_count" in p


def test_path2_strategies(spark):
    e = edges_ps(spark, SF001)
    assert "SortMergeJoin" in plan_text(paths.path2(e, "merge"))
    assert "BroadcastHashJoin" in plan_text(paths.path2(e, "broadcast"))
    implicit = plan_text(paths.path2(e, "implicit"))
    assert "CartesianProduct" not in implicit and "NestedLoop" not in implicit


def test_broadcast_falls_back_beyond_bound(spark):
    e = edges_ps(spark, SF001)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")      # leaves only the explicit hint
    try:
        assert "BroadcastHashJoin" in plan_text(paths.path2(e, "broadcast"))
        p = plan_text(paths.path2(e, "broadcast", max_broadcast_rows=10))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in p.split("Subqueries")[0]


def test_no_python_or_cartesian_anywhere(spark):
    from edgeframe.plans.registry import QUERIES
    skip = {"observed_metrics"}
    for name, fn in QUERIES.items():
        if name in skip or name.startswith(("sssp", "pagerank", "kmeans", "longest", "farthest",
                                            "top1", "filter_finite", "cluster", "nearest")):
            continue
        p = plan_text(fn(spark, SF001))
        assert "PythonUDF" not in p and "ArrowEvalPython" not in p, name
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_pagerank_round_does_not_move_edges(spark):
    from pyspark.sql import functions as F
    from edgeframe.operators.common import BucketedTable, HubSplitEdges
    from edgeframe.operators.pagerank import pagerank_round
    e = edges_ps(spark, SF001)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        adj = HubSplitEdges(e.groupBy("src", "dst").agg(F.lit(0.5).alias("share")), "t_adj")
        vt = BucketedTable(e.select(F.col("src").alias("id")).distinct()
                           .select("id", F.lit(False).alias("dangling")), "id", "t_vt", adj.n).read()
        pr = vt.select("id", "dangling", F.lit(0.1).alias("pr"))
        p = plan_text(pagerank_round(pr, adj, vt, 10))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    main = p.split("Subqueries")[0].split("\n\n")[0]
    # one exchange for the partial contribution sums; none over the edge table, which is not sorted either
    assert main.count("Exchange") == 1, main
    join = main[main.index("ShuffledHashJoin"):]
    assert "Sort (" not in join and "Scan parquet" in join, main


def test_size_estimate_gates_the_exact_count(spark, monkeypatch):
    from edgeframe.operators import common
    from edgeframe.plans.inspect import estimated_bytes
    e = edges_ps(spark, SF001)
    est = estimated_bytes(e)
    assert est is not None and 0 < est < 1 << 30
    calls = []
    monkeypatch.setattr(common, "row_count_at_most", lambda df, n: calls.append(n) or True)
    monkeypatch.setattr(common, "EXACT_CHECK_BYTES", 1)      # pretend the side is huge
    _, applied = common.bounded_broadcast(e)
    assert not applied and calls == []                        # no counting pass at all
    monkeypatch.setattr(common, "EXACT_CHECK_BYTES", 1 << 30)
    _, applied = common.bounded_broadcast(e)
    assert applied and calls


def test_bfs_round_reads_edges_and_visited_in_place(spark):
    from pyspark.sql import functions as F
    from edgeframe.operators.common import BucketedTable, HubSplitEdges
    e = edges_ps(spark, SF001)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        adj = HubSplitEdges(e.select("src", "dst").distinct(), "t_bfs_adj")
        visited = BucketedTable(e.select(F.col("src").alias("id")).distinct()
                                .select("id", F.lit(0).cast("bigint").alias("dist")), "id", "t_vis", adj.n)
        seen = visited.read()
        frontier = seen.where(F.col("dist") == 0)
        reached = adj.join(frontier.select("id")).select(F.col("dst").alias("id"))
        new = reached.distinct().join(seen.select("id"), "id", "left_anti")
        p = plan_text(new)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    main = p.split("\n\n")[0]
    assert main.count("Exchange") == 1, main      # only the newly reached ids move
