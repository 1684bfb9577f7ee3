"""Loops that go on from a written round, kept state, compaction, inputs with parsers of their own."""

import random

import pytest
from pyspark.sql import functions as F

from edgeframe.operators import common, kmeans, paths, sampling, sssp
from edgeframe.session import scratch_path
from edgeframe.sources import files
from edgeframe.sources.tables import edges_co, edges_ps, points_chars
from tests.conftest import SF001, make_edges


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture(params=["in memory", "bucketed"])
def mode(request, monkeypatch):
    if request.param == "bucketed":
        monkeypatch.setattr(sssp, "SMALL_ROWS", 0)
    return request.param


def ladder(spark):
    """Weighted edges where a vertex is improved again and again over many rounds."""
    pairs = [(i, i + 1, 1) for i in range(40)] + [(0, i, 3 * i) for i in range(2, 40)] + [(5, 5, 1), (3, 1, 2)]
    return spark.createDataFrame(pairs, "src BIGINT, dst BIGINT, w BIGINT")


def plain(edges, rounds):
    best = {0: 0}
    for _ in range(rounds):
        nxt = dict(best)
        for a, b, w in edges:
            if a in best and best[a] + w < nxt.get(b, 1 << 60):
                nxt[b] = best[a] + w
        best = nxt
    return best


@pytest.mark.parametrize("rounds", [0, 7])
def test_rounds_like_the_plain_loop(spark, mode, rounds):
    e = ladder(spark)
    dist, trace = sssp.bellman_ford(e, 0, rounds)
    edges = [tuple(r) for r in e.collect()]
    assert dict(rows(dist)) == plain(edges, rounds)
    changed = [sum(plain(edges, r).get(v) != plain(edges, r - 1).get(v) for v in range(41)) for r in range(1, rounds + 1)]
    assert rows(trace) == [(r, n) for r, n in enumerate(changed, 1) if n]
    dist, _ = sssp.bfs(e, 0, rounds)
    assert dict(rows(dist)) == plain([(a, b, 1) for a, b, _ in edges], rounds)


@pytest.mark.parametrize("stop", [4])
def test_a_resumed_search_is_one_unbroken_run(spark, mode, stop):
    e = ladder(spark)
    for weight, weighted in ((None, False), ("w", True)):
        whole = rows(sssp.sssp(e, 0, 8, weight=weight))
        path = scratch_path(spark, "state")
        files.write_search_state(sssp.search_state(e, sssp.sssp(e, 0, stop, weight=weight), stop, weighted), path)
        state = files.read_search_state(spark, path)
        assert rows(sssp.sssp(e, 0, 8, weight=weight, state=state, first_round=stop + 1)) == whole
    # without marks every vertex may be expanded again
    assert rows(sssp.sssp(e, 0, 8, weight="w", state=state.drop("visited"), first_round=stop + 1)) == whole


def test_resumed_search_on_the_tables(spark):
    e = edges_co(spark, SF001)
    state = sssp.search_state(e, sssp.sssp(e, 1, 2), 2)
    assert rows(sssp.sssp(e, 1, 10, state=state, first_round=3)) == rows(sssp.sssp(e, 1, 10))


def test_kmeans_goes_on_from_a_written_round(spark):
    pts = points_chars(spark, SF001)
    whole, trace = kmeans.kmeans_1d(pts, [0, 100, 200, 300], 8)
    early, _ = kmeans.kmeans_1d(pts, [0, 100, 200, 300], 3)
    path = scratch_path(spark, "centroids")
    files.write_pairs_tsv(early, path)
    late, late_trace = kmeans.kmeans_1d(pts, files.read_centroids(spark, path), 8, first_round=4)
    assert rows(late) == rows(whole) and rows(late_trace) == [r for r in rows(trace) if r[0] > 3]


def test_history_stays_within_twice_the_live_rows(spark, monkeypatch):
    monkeypatch.setattr(sssp, "SMALL_ROWS", 0)
    read = []
    append = common.BucketedTable.append

    def watched(self, df):
        n = append(self, df)
        live = self.read().select("id").distinct().count()
        files_per_bucket = len(self.read().inputFiles()) / self.n
        read.append((self.count(), n, live, files_per_bucket))
        return n

    monkeypatch.setattr(common.BucketedTable, "append", watched)
    sssp.bellman_ford(ladder(spark), 0, 11)
    assert len(read) == 11
    # after a round the table holds at most twice the live rows, beyond what that round added
    assert all(total - n <= 2 * live for total, n, live, _ in read)
    assert all(f <= sssp.MOST_APPENDS + 1 for *_, f in read)


def test_a_lost_cached_block_is_computed_again(spark, monkeypatch):
    e = ladder(spark)
    want = rows(sssp.sssp(e, 0, 5, weight="w"))
    keep = common.Small.keep

    def losing(self, df, counted=None):
        df, n = keep(self, df, counted)
        return df.unpersist(blocking=True), n

    monkeypatch.setattr(common.Small, "keep", losing)
    assert rows(sssp.sssp(e, 0, 5, weight="w")) == want


def test_nothing_stays_cached(spark):
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    sssp.sssp(ladder(spark), 0, 4, weight="w").collect()
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == before


def test_inputs_have_parsers_of_their_own(spark, tmp_path):
    (tmp_path / "e.csv").write_text("1,2\n2,3\n\nx,4\n5\n6,7,8\n 3 , 1 \n9\t9\n99999999999999999999,1\n")
    (tmp_path / "p.tsv").write_text("1\t3\n1,3\n2\t1\n3\t2\n\t\n")
    got, bad = files.read_inputs(spark, {"E": (str(tmp_path / "e.csv"), ","), "P": (str(tmp_path / "p.tsv"), "\t")})
    assert rows(got) == [("E", 1, 2), ("E", 2, 3), ("E", 3, 1), ("P", 1, 3), ("P", 2, 1), ("P", 3, 2)]
    assert rows(bad) == [("E", "5"), ("E", "6,7,8"), ("E", "9\t9"), ("E", "99999999999999999999,1"), ("E", "x,4"), ("P", "\t"), ("P", "1,3")]
    assert tuple(paths.closed_by_side(got).first()) == (3, 1)


def hub(spark, n=3000):
    return make_edges(spark, [(i, 0) for i in range(1, n + 1)] + [(0, n + j) for j in range(1, n + 1)]
                      + [(0, 0)] * 3 + [(2 * n + k, 2 * n + k + 1) for k in range(n)])


def test_hub_paths_are_spread_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(paths, "PATH_BLOCK", 64)
    e = hub(spark)
    spark.conf.set("spark.sql.adaptive.enabled", "false")       # the plan's own partitions
    try:
        p = paths.path2(e)
        sizes = sorted(r["count"] for r in p.groupBy(F.spark_partition_id().alias("p"), (F.col("src") > 6000).alias("light"))
                       .count().where("not light").collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sizes[-1] <= 2 * sizes[len(sizes) // 2] and sum(sizes) >= 9_000_000


def test_blocks_change_nothing_but_the_plan(spark, monkeypatch):
    rng = random.Random(3)
    pairs = [(rng.randrange(12), rng.randrange(12)) for _ in range(300)] + [(0, rng.randrange(40)) for _ in range(80)] + \
        [(rng.randrange(40), 0) for _ in range(80)]
    e = make_edges(spark, pairs)
    want = rows(paths.path2(e, "merge"))
    assert rows(paths.path2(e, "blocks")) == want
    monkeypatch.setattr(paths, "PATH_BLOCK", 5)
    assert rows(paths.path2(e, "blocks")) == want and rows(paths.path2(e.limit(0), "blocks")) == []


def test_closing_join_sorts_and_filters(spark, monkeypatch):
    from edgeframe.plans.inspect import plan_text
    e = edges_ps(spark, SF001)
    m = common.written_table(paths.multiplicity(e), "m")
    plan = plan_text(paths._count_path_plan(m, "join", "shuffle", 10))
    assert "ShuffledHashJoin" not in plan and plan.count("SortMergeJoin") >= 2
    words, bits = paths._closing_filter(m, m.count())
    two = e.alias("x").join(e.alias("y"), F.col("x.dst") == F.col("y.src")).select(F.col("x.src").alias("a"), F.col("y.dst").alias("c"))
    left = paths._may_close(two, words, bits)
    closing = e.select(F.col("dst").alias("a"), F.col("src").alias("c")).distinct()
    assert rows(left.join(closing, ["a", "c"])) == rows(two.join(closing, ["a", "c"]))
    assert left.count() < 0.2 * two.count()
    with_filter = paths.triangle_count(hub(spark, 50), "join", "shuffle").first()
    monkeypatch.setattr(paths, "FILTER_BITS", 2)                # too many edges for the bits: no filter
    assert paths.triangle_count(hub(spark, 50), "join", "shuffle").first() == with_filter


def test_draws_with_replacement(spark):
    import hashlib
    from collections import Counter
    ids = [3, 1, 40, 17, 5]
    v = spark.createDataFrame([(i,) for i in ids * 2 + [None]], "id BIGINT")
    want = Counter(sorted(ids)[int(hashlib.md5(f"42-{i}".encode()).hexdigest()[:15], 16) % 5] for i in range(30))
    assert dict(rows(sampling.draw_vertices(v, 30, forced=None))) == want
    assert dict(rows(sampling.draw_vertices(v, 30))) == want + Counter([1])
    assert dict(rows(sampling.draw_vertices(v, 30, forced=2))) == want
    assert rows(sampling.draw_vertices(v.limit(0), 30)) == []


def test_many_centroids(spark, monkeypatch):
    rng = random.Random(1)
    cs = [rng.randrange(-500, 500) for _ in range(120)] + [10 ** 18, -10 ** 18]
    vs = [rng.randrange(-900, 900) for _ in range(400)] + [7] * 300 + [None, None, 4 * 10 ** 18, -4 * 10 ** 18]
    pts = spark.createDataFrame([(v,) for v in vs], "v BIGINT")
    cents = spark.createDataFrame([(c,) for c in cs + cs[:20] + [None]], "centroid BIGINT")
    want = sorted(((v, min(cs, key=lambda c: (abs(c - v), c)) if v is not None else None) for v in vs), key=str)
    assert sorted(map(tuple, kmeans.assign_many(pts, cents).collect()), key=str) == want
    monkeypatch.setattr(common, "HOT_KEY_ROWS", 50)
    assert sorted(map(tuple, kmeans.assign_many(pts, cents).collect()), key=str) == want
    assert {r["centroid"] for r in kmeans.assign_many(pts, cents.limit(0)).collect()} == {None}
    big = spark.range(50_000).select((F.col("id") * 10).alias("centroid"))
    got = kmeans.assign_many(spark.range(0, 499_990, 7).select(F.col("id").alias("v")), big)
    assert got.where(F.abs(F.col("v") - F.col("centroid")) > 5).count() == 0
