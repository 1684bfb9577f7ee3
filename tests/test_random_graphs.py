"""Triangle strategies and degree identities against brute force on random multigraphs."""

import random
from collections import Counter

import pytest

from edgeframe.operators import degrees, paths
from tests.conftest import make_edges


def brute(pairs):
    m = Counter(pairs)
    vs = sorted({v for p in pairs for v in p})
    join = semi = 0
    closed = set()
    for a in vs:
        for b in vs:
            if not m[(a, b)]:
                continue
            for c in vs:
                if not m[(b, c)] or not m[(c, a)]:
                    continue
                join += m[(a, b)] * m[(b, c)] * m[(c, a)]
                semi += m[(a, b)] * m[(b, c)]
                closed.add((a, c))
    return join, semi, len(closed)


def random_graph(seed, n, e, hub=False):
    rnd = random.Random(seed)
    out = []
    for _ in range(e):
        a = 0 if hub and rnd.random() < 0.35 else rnd.randrange(n)
        b = 0 if hub and rnd.random() < 0.35 else rnd.randrange(n)
        out.append((a, b))
    return out


@pytest.mark.parametrize("seed,n,e,hub", [(1, 6, 30, False), (2, 9, 60, True), (3, 12, 80, False),
                                          (4, 5, 40, True)])
def test_triangles_match_brute_force(spark, seed, n, e, hub):
    pairs = random_graph(seed, n, e, hub)
    want = brute(pairs)
    df = make_edges(spark, pairs)
    for strategy in ("oriented", "shuffle"):
        got = tuple(paths.triangle_count(df, s, strategy).first()[0]
                    for s in ("join", "semi", "distinct_pairs"))
        assert got == want, strategy
    assert paths.triangle_count(df, "join", "implicit").first()[0] == want[0]
    closed = {tuple(r) for r in paths.closed_pairs_oriented(df).collect()}
    assert closed == {tuple(r) for r in paths.closed_pairs(df).collect()}
    assert len(closed) == want[2]


def test_degree_identities(spark):
    pairs = random_graph(7, 20, 200, True)
    df = make_edges(spark, pairs)
    d = {r["id"]: (r["out_deg"], r["in_deg"]) for r in degrees.degree_pairs(df).collect()}
    assert sum(o for o, _ in d.values()) == len(pairs) == sum(i for _, i in d.values())
    exact = sum(o * i for o, i in d.values())
    assert paths.path2_count(df).first()[0] == exact == paths.path2(df).count()
    assert degrees.path2_exact_total(df).first()[0] == exact


@pytest.mark.parametrize("seed", [11, 12, 13])
def test_dense_loops_and_two_cycles_match_brute_force(spark, seed):
    rnd = random.Random(seed)
    pairs = [(rnd.randrange(4), rnd.randrange(4)) for _ in range(60)]   # many loops / 2-cycles
    want = brute(pairs)
    df = make_edges(spark, pairs)
    for strategy in ("oriented", "broadcast", "auto"):
        got = tuple(paths.triangle_count(df, s, strategy).first()[0]
                    for s in ("join", "semi", "distinct_pairs"))
        assert got == want, strategy
