"""A hub vertex holding a third of all edges must not blow up the default plans."""

from pyspark.sql import functions as F

from edgeframe.operators import adjacency, degrees, paths
from tests.conftest import make_edges

N = 3000      # hub in-degree and out-degree: 9,000,000 2-paths run through it
CLOSED = 10   # directed 3-cycles i -> 0 -> N+i -> i


def hub_graph(spark):
    pairs = [(i, 0) for i in range(1, N + 1)] + [(0, N + j) for j in range(1, N + 1)]
    pairs += [(N + i, i) for i in range(1, CLOSED + 1)]
    pairs += [(2 * N + k, 2 * N + k + 1) for k in range(1, 3000)]   # a long tail, low degree
    return make_edges(spark, pairs)


def test_oriented_wedges_stay_linear_with_a_hub(spark):
    e = hub_graph(spark)
    assert paths.path2_count(e).first()[0] >= N * N          # the join the plan avoids
    loops, pairs, oriented, _ = paths._oriented_inputs(paths.multiplicity(e))
    top = oriented.groupBy("x").count().agg(F.max("count")).first()[0]
    assert top <= (2 * e.count()) ** 0.5                     # no wedge key is hot
    wedges = oriented.select("x", "y").join(oriented.select("x", F.col("y").alias("z")), "x").where("y < z").count()
    assert wedges <= 4 * e.count()                           # no quadratic expansion at the hub
    assert tuple(paths.triangle_count(e, "join").first()) == (3 * CLOSED, CLOSED)
    assert tuple(paths.triangle_count(e, "semi").first()) == (3 * CLOSED, CLOSED)
    assert tuple(paths.triangle_count(e, "distinct_pairs").first()) == (3 * CLOSED, CLOSED)


def test_hub_degrees_and_bounded_lists(spark):
    e = hub_graph(spark)
    d = {r["id"]: r["followers"] for r in degrees.in_degree(e).where("id = 0").collect()}
    assert d[0] == N
    adj = adjacency.adjacency_list(e, max_group=500)
    hub_rows = adj.where("id = 0").collect()
    assert sorted((r["chunk"], len(r["nbrs"])) for r in hub_rows) == [(c, 500) for c in range(N // 500)]
    assert [x for r in sorted(hub_rows, key=lambda r: r["chunk"]) for x in r["nbrs"]] == list(range(N + 1, 2 * N + 1))
    g = degrees.in_degree_group_collect(e).where("id = 0").first()
    assert g["followers"] == N


def test_split_lists_lose_and_double_nothing(spark):
    e = make_edges(spark, [(v, 1000 + v % 3) for v in range(40) for _ in range(15)])
    adj = adjacency.adjacency_list(e, max_group=10)
    assert {len(r["nbrs"]) for r in adj.collect()} == {10, 5}
    own = adjacency.explode_messages(adj).where("id = msg").count()
    assert own == 40
    marked = [r["adj"].split(",").count("-1") for r in adjacency.append_marker(adj, -1).collect()]
    assert sum(marked) == 40 and len(marked) == 80


def test_hub_edges_leave_the_buckets(spark, monkeypatch):
    from edgeframe.operators import common, pagerank, sssp
    hub = [(0, k) for k in range(1, 2001)]
    e = make_edges(spark, hub + [(k, k + 1) for k in range(1, 4001)])
    rank = lambda: sorted(map(tuple, pagerank.pagerank(e, iters=3)[0].collect()))
    dist = lambda w: sorted(map(tuple, sssp.sssp(e.withColumn("w", 1 + F.col("src") % 3), 0, 4, weight=w).collect()))
    before = rank(), dist(None), dist("w")
    monkeypatch.setattr(common, "HOT_KEY_ROWS", 100)
    adj = common.HubSplitEdges(e, "t_hub", buckets=4)
    assert adj.hot.count() == 2000 and [r[0] for r in adj.keys.collect()] == [0]
    for table in (adj.hot, adj.cold.read()):
        sizes = [r["count"] for r in table.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) <= 2 * sum(sizes) / len(sizes)
    after = rank(), dist(None), dist("w")
    assert after[1:] == before[1:]
    assert all(a[0] == b[0] and abs(a[1] - b[1]) < 1e-15 for a, b in zip(after[0], before[0]))


def test_hot_threshold_rises_instead_of_giving_up(spark):
    from edgeframe.operators import common
    counts = spark.range(100).selectExpr("id AS k", "cast(10 + id AS bigint) AS n")
    keys, threshold, rows = common.hot_keys(counts, "k", "n", threshold=1, max_hot=60)
    assert rows == sum(range(10, 110)) and threshold == rows // 60 and keys.count() <= 60


def test_auto_strategy_follows_the_data(spark):
    from edgeframe.sources.tables import edges_ps
    from tests.conftest import SF001
    assert paths.choose_strategy(paths.multiplicity(hub_graph(spark))) == "oriented"
    assert paths.choose_strategy(paths.multiplicity(edges_ps(spark, SF001))) == "broadcast"
    tail = spark.range(200_000).selectExpr("id + 10000 AS src", "id + 10001 AS dst")
    assert paths.choose_strategy(paths.multiplicity(hub_graph(spark).unionByName(tail))) == "oriented"
    e = hub_graph(spark)
    assert tuple(paths.triangle_count(e, "join", "auto").first()) == (3 * CLOSED, CLOSED)


def test_hot_key_split_changes_nothing_but_the_plan(spark, monkeypatch):
    from edgeframe.operators import common, pagerank
    from edgeframe.plans.inspect import plan_text
    e = hub_graph(spark)
    deg = e.groupBy("src").agg(F.count(F.lit(1)).alias("n"))
    plain = sorted(tuple(r) for r in e.join(deg, "src").collect())
    split = common.hot_key_join(e, deg, "src", "n", threshold=100)
    assert sorted(tuple(r) for r in split.select(*e.columns, "n").collect()) == plain
    assert "BroadcastHashJoin" in plan_text(split)
    before = (paths.triangle_count(e, "join", "oriented").first(),
              sorted(tuple(r) for r in pagerank.pagerank(e, iters=3)[0].collect()),
              sorted(tuple(r) for r in adjacency.adjacency_list(e, max_group=500).select("id", "nbrs")
                     .collect()))
    monkeypatch.setattr(common, "HOT_KEY_ROWS", 100)       # the hub (degree 3000+) is now hot
    after = (paths.triangle_count(e, "join", "oriented").first(),
             sorted(tuple(r) for r in pagerank.pagerank(e, iters=3)[0].collect()),
             sorted(tuple(r) for r in adjacency.adjacency_list(e, max_group=500).select("id", "nbrs")
                    .collect()))
    assert after[0] == before[0] and after[2] == before[2]
    assert [r[0] for r in after[1]] == [r[0] for r in before[1]]
    assert all(abs(a[1] - b[1]) < 1e-15 for a, b in zip(after[1], before[1]))
