"""PageRank and k-means goldens (FIXTURES.md sections 3 and 4)."""

import pytest
from pyspark.sql import functions as F

from edgeframe.operators import kmeans, pagerank
from edgeframe.sources.tables import chain_graph, edges_sp, points_chars
from tests.conftest import SF01


def test_chain_pagerank_golden(spark):
    ids = spark.range(1, 100 * 100 + 1).select(F.col("id").cast("bigint").alias("id"))
    edges = chain_graph(ids, 100)
    assert edges.count() == 10_000
    ranks, trace = pagerank.pagerank(edges, vertices=ids, iters=10)
    t = {(r["round"], r["metric"]): r["value"] for r in trace.collect()}
    for i in range(1, 11):
        assert t[(i, "total")] == pytest.approx(1.0, abs=1e-9)
    assert t[(1, "delta")] == pytest.approx(0.01, abs=1e-15)
    assert t[(2, "delta")] == pytest.approx(0.0101, abs=1e-15)
    assert t[(10, "delta")] == pytest.approx(0.010936852726843594, rel=1e-12)
    r = {row["id"]: row["pr"] for row in ranks.where("id in (1, 100)").collect()}
    assert r[1] == pytest.approx(1.0936852726843594e-06, rel=1e-12)
    assert r[100] == pytest.approx(0.00011046221254112045, rel=1e-12)


def test_pagerank_mass_conserved_with_dangling(spark):
    ranks, trace = pagerank.pagerank(edges_sp(spark, SF01), iters=4)
    totals = [r["value"] for r in trace.where("metric = 'total'").collect()]
    assert all(abs(x - 1.0) < 1e-9 for x in totals)
    assert ranks.count() == 2000


def test_pagerank_damping(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4)], "src BIGINT, dst BIGINT")
    ranks, trace = pagerank.pagerank(e, iters=20, damping=0.85)
    assert sum(r["pr"] for r in ranks.collect()) == pytest.approx(1.0, abs=1e-9)


def test_kmeans_golden_sf001(spark):
    pts = points_chars(spark, SF01)
    seeds = sorted(r[0] for r in kmeans.equal_interval_seeds(pts, 4).collect())
    assert seeds == [0, 8261, 16522, 24783, 33044]
    clusters, trace = kmeans.kmeans_1d(pts, seeds, 10)
    sse = dict((r["round"], r["sse"]) for r in trace.collect())
    assert sse[1] == 3_734_845_711 and sse[10] == 884_540_410
    got = sorted((r["centroid"], r["n"]) for r in clusters.collect())
    assert got == [(1305, 785), (4751, 170), (10652, 36), (20068, 8), (33047, 1)]


def test_kmeans_bad_seeds_sf001(spark):
    clusters, trace = kmeans.kmeans_1d(points_chars(spark, SF01), [0, 100, 200, 300], 10)
    sse = dict((r["round"], r["sse"]) for r in trace.collect())
    assert sse[1] == 13_103_339_406 and sse[10] == 1_820_146_030
    got = sorted((r["centroid"], r["n"]) for r in clusters.collect())
    assert got == [(594, 309), (1676, 439), (4410, 207), (12824, 45)]


def test_nearest_ties_go_low(spark):
    pts = spark.createDataFrame([(1, 5), (2, 15), (3, 10)], "id BIGINT, v BIGINT")
    got = sorted(tuple(r) for r in kmeans.assign(pts, [0, 10, 20]).collect())
    assert got == [(5, 0), (10, 10), (15, 10)]


def test_zero_rounds(spark):
    e = spark.createDataFrame([(1, 2), (2, 3)], "src BIGINT, dst BIGINT")
    ranks, trace = pagerank.pagerank(e, iters=0)
    assert trace.count() == 0
    assert sorted(r["pr"] for r in ranks.collect()) == pytest.approx([1 / 3] * 3)
    with pytest.raises(ValueError):
        kmeans.kmeans_1d(spark.createDataFrame([(1, 5)], "id BIGINT, v BIGINT"), [0], 0)


def test_sums_do_not_overflow(spark):
    from edgeframe.operators import degrees, kmeans, paths
    pts = spark.range(2000).selectExpr("cast(100000000 AS bigint) AS v")
    row = kmeans.cluster_update(pts, [0]).first()
    assert row["sse"] == 2000 * 10 ** 16
    wide = spark.range(4).selectExpr("cast(4000000000000000000 AS bigint) AS v")
    assert kmeans.cluster_update(wide, [0]).first()["sse"] == 4 * 16 * 10 ** 36
    assert kmeans.cluster_update(wide, [0]).first()["centroid"] == 4 * 10 ** 18
    m = spark.createDataFrame([(1, 1, 3_000_000_000)], "src BIGINT, dst BIGINT, w BIGINT")
    assert paths._count_oriented(m, "join").first()[0] == 27 * 10 ** 27
    assert paths._count_path_plan(m, "semi", "shuffle", 10).first()[0] == 9 * 10 ** 18
    assert degrees.path2_exact_total(spark.createDataFrame([(1, 1)], "src BIGINT, dst BIGINT")).first()[0] == 1


def test_catalog_and_scratch_are_left_clean(spark):
    from edgeframe.operators import pagerank, sssp
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4)], "src BIGINT, dst BIGINT")
    before = {t.name for t in spark.catalog.listTables()}
    ranks, trace = pagerank.pagerank(e, iters=3)
    dist = sssp.sssp(e, 1, 5)
    assert {t.name for t in spark.catalog.listTables()} == before
    assert ranks.count() == 4 and trace.count() == 6 and dist.count() == 4      # still readable


def test_a_failed_table_write_surfaces(spark):
    import pytest
    from pyspark.sql import functions as F
    from edgeframe.operators.common import BucketedTable
    bad = spark.range(3).select(F.col("id").alias("src"), F.raise_error(F.lit("disk gone")).alias("dst"))
    with pytest.raises(Exception, match="disk gone"):
        BucketedTable(bad, "src", "bad")


def test_nearest_value_matches_argmin(spark):
    from pyspark.sql import functions as F
    from edgeframe.functions.scalar import nearest_value
    cs = [-7, 0, 3, 4, 10]
    got = spark.range(-20, 20).select("id", nearest_value(F.col("id"), cs).alias("c")).collect()
    assert all(r["c"] == min(cs, key=lambda c: (abs(c - r["id"]), c)) for r in got)
    assert spark.sql("SELECT cast(null AS bigint) AS v").select(nearest_value(F.col("v"), cs)).first()[0] is None
