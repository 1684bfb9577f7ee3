"""Golden micro-graphs (values from FIXTURES.md section 2)."""

import pytest

from edgeframe.operators import adjacency, degrees, paths, relational, sssp
from tests.conftest import make_edges


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_counts(graph):
    e = graph("two_triangles")
    assert e.count() == 7
    assert e.select("src").distinct().count() == 6
    assert e.select("dst").distinct().count() == 6
    e2 = graph("cycles_and_tail")
    assert (e2.count(), e2.select("src").distinct().count(), e2.select("dst").distinct().count()) == (11, 9, 10)


@pytest.mark.parametrize("fn", [degrees.in_degree, degrees.in_degree_reduce,
                                degrees.in_degree_group_collect])
def test_in_degree_variants(graph, fn):
    got = dict(rows(fn(graph("two_triangles"))))
    assert got == {1: 1, 2: 1, 3: 1, 4: 2, 5: 1, 6: 1}
    got2 = dict(rows(fn(graph("cycles_and_tail"))))
    assert got2[5] == 2 and all(v == 1 for k, v in got2.items() if k != 5)


def test_group_collect_splits_hot_key(spark):
    # one target with 50 followers over 7 partitions: several lists, same total
    e = make_edges(spark, [(i, 0) for i in range(50)] + [(1, 2)] * 9).repartition(7)
    got = dict(rows(degrees.in_degree_group_collect(e)))
    assert got == {0: 50, 2: 9}


def test_fold_zero_keeps_sources(graph):
    got = dict(rows(degrees.in_degree_fold_zero(graph("island"))))
    assert got == {1: 0, 2: 1, 3: 0, 4: 1}


def test_path2(graph):
    for strategy in ("merge", "broadcast", "implicit"):
        got = rows(paths.path2(graph("two_triangles"), strategy))
        assert got == [(1, 3), (2, 1), (2, 4), (3, 2), (3, 5), (4, 6), (5, 4), (6, 5)]
    got = rows(paths.path2(graph("cycles_and_tail"), "merge"))
    assert got == sorted([(1, 3), (1, 6), (2, 4), (3, 1), (4, 2), (4, 5), (5, 7), (5, 10), (6, 5),
                          (6, 8), (7, 9), (10, 6)])


@pytest.mark.parametrize("name,join,semi,pairs", [
    ("two_triangles", 6, 6, 6), ("cycles_and_tail", 3, 3, 3), ("diamond", 6, 6, 5),
    ("self_loop", 4, 4, 3), ("multi_edge", 6, 5, 3), ("island", 0, 0, 0)])
@pytest.mark.parametrize("strategy", ["oriented", "shuffle", "broadcast"])
def test_triangle_semantics(graph, name, join, semi, pairs, strategy):
    e = graph(name)
    assert rows(paths.triangle_count(e, "join", strategy)) == [(join, join // 3)]
    assert rows(paths.triangle_count(e, "semi", strategy)) == [(semi, semi // 3)]
    assert rows(paths.triangle_count(e, "distinct_pairs", strategy)) == [(pairs, pairs // 3)]


def test_implicit_join_triangles(graph):
    assert rows(paths.triangle_count(graph("multi_edge"), "join", "implicit")) == [(6, 2)]


def test_closed_pairs_agree(graph):
    for name in ("diamond", "self_loop", "multi_edge", "two_triangles"):
        e = graph(name)
        assert rows(paths.closed_pairs(e)) == rows(paths.closed_pairs_oriented(e))


def test_path2_cardinality(graph):
    got = dict(rows(degrees.path2_cardinality(graph("two_triangles"))))
    assert got == {1: 1, 2: 1, 3: 2, 4: 2, 5: 1, 6: 1}
    e = graph("cycles_and_tail")
    got = dict(rows(degrees.path2_cardinality(e)))
    assert got == {1: 2, 2: 1, 3: 1, 4: 1, 5: 2, 6: 2, 7: 1, 8: 1, 9: 1, 10: 1}
    assert rows(degrees.path2_cardinality_total(e)) == [(13,)]
    assert rows(degrees.path2_exact_total(e)) == [(12,)]
    assert rows(paths.path2_count(e)) == [(12,)]


def test_adjacency_round_trip(graph):
    e = graph("cycles_and_tail")
    adj = adjacency.adjacency_list(e)
    text = dict(rows(adjacency.adjacency_text(adj).select("id", "adj")))
    assert text == {1: "2,5", 2: "3", 3: "4", 4: "1", 5: "6", 6: "7,10", 7: "8", 8: "9", 10: "5"}
    assert rows(adjacency.edges_from_adjacency(adj)) == rows(e)


def test_adjacency_chunks_bound_lists(spark):
    e = make_edges(spark, [(0, i % 13) for i in range(100)] + [(1, 5)] * 30 + [(2, 3)])
    adj = adjacency.adjacency_list(e, max_group=8)
    sizes = [len(r["nbrs"]) for r in adj.collect()]
    assert max(sizes) == 8 and sorted(sizes) == sorted([8] * 12 + [4] + [8] * 3 + [6] + [1])
    assert rows(adjacency.edges_from_adjacency(adj)) == rows(e)


@pytest.mark.parametrize("name,expected,longest", [
    ("two_triangles", {1: 0, 2: 1, 3: 2, 4: 3, 5: 4, 6: 5}, 5),
    ("cycles_and_tail", {1: 0, 2: 1, 5: 1, 3: 2, 6: 2, 4: 3, 7: 3, 10: 3, 8: 4, 9: 5}, 5),
    ("island", {1: 0, 2: 1, 3: sssp.SENTINEL, 4: sssp.SENTINEL}, 1)])
def test_sssp(graph, name, expected, longest):
    d = sssp.sssp(graph(name), 1, 10)
    assert dict(rows(d)) == expected
    assert rows(sssp.longest_distance(d)) == [(longest,)]


def test_weighted_sssp_unit_weights_equal_bfs(graph):
    from pyspark.sql import functions as F
    e = graph("cycles_and_tail")
    a = sssp.sssp(e, 1, 10)
    b = sssp.sssp(e.withColumn("w", F.lit(1)), 1, 10, weight="w")
    assert rows(a) == rows(b)


def test_farthest_and_top1(graph):
    d = sssp.sssp(graph("cycles_and_tail"), 1, 10)
    assert rows(sssp.farthest_vertex(d)) == [(5, 9)]
    assert rows(sssp.top1_by_distance(d)) == [(9, 5)]


def test_reverse_and_filter(graph):
    e = graph("two_triangles")
    assert rows(relational.reverse_edges(e)) == sorted((b, a) for a, b in rows(e))
    assert rows(relational.filter_max_id(e, 3)) == [(1, 2), (2, 3), (3, 1)]


def test_search_state_text_format(spark, tmp_path):
    from pyspark.sql import functions as F
    from edgeframe.sources import files
    state = spark.createDataFrame(
        [(1, [2, 5], 0, True), (2, [], 2147483647, False)],
        "id BIGINT, nbrs ARRAY<BIGINT>, dist BIGINT, visited BOOLEAN")
    path = str(tmp_path / "state")
    files.write_search_state(state, path)
    lines = sorted(r["value"] for r in spark.read.text(path).collect())
    assert lines == ["1\t2,5 0 V", "2\tnull 2147483647"]
    back = files.read_search_state(spark, path).orderBy("id").collect()
    assert [tuple(r) for r in back] == [(1, [2, 5], 0, True), (2, [], 2147483647, False)]
