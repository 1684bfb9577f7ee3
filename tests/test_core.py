"""Triangle plans work on the edges that may lie on a closed walk."""

import random

import pytest

from edgeframe.operators import paths
from tests.conftest import make_edges

CLOSED = [(1, 2), (2, 3), (3, 1), (3, 1), (4, 4), (3, 4), (4, 3)]
#: into, out of and between closed walks, and none of it on one
OPEN = [(900 + i, 1 + i % 3) for i in range(60)] + [(1 + i % 3, 700 + i) for i in range(60)] + [(700, 701), (899, 900)]


def test_edges_on_no_closed_walk_go(spark):
    m = paths._written_multiplicity(make_edges(spark, CLOSED + OPEN))
    assert sorted(map(tuple, m.collect())) == sorted({(*e, CLOSED.count(e)) for e in CLOSED})


@pytest.mark.parametrize("broadcast", [True, False])
def test_results_stay(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(paths, "bounded_broadcast", lambda df, *_: (df, False))
    rng = random.Random(3)
    e = [(rng.randrange(12), rng.randrange(30)) for _ in range(150)] + CLOSED + OPEN
    w = {x: e.count(x) for x in set(e)}
    walks = [(a, b, c) for a, b in w for b2, c in w if b == b2 and (c, a) in w]
    want = {"join": sum(w[a, b] * w[b, c] * w[c, a] for a, b, c in walks),
            "semi": sum(w[a, b] * w[b, c] for a, b, c in walks), "distinct_pairs": len({(a, c) for a, _, c in walks})}
    edges = make_edges(spark, e)
    for (semantics, hits), strategy in zip(want.items(), ("shuffle", "broadcast", "oriented")):
        assert tuple(paths.triangle_count(edges, semantics, strategy).first()) == (hits, hits // 3)
    assert {tuple(r) for r in paths.closed_pairs(edges).collect()} == {(a, c) for a, _, c in walks}


def test_rounds_end(spark):
    chain = [(i, i + 1) for i in range(200)]        # a round drops two of them
    assert paths.cyclic_core(make_edges(spark, chain)).count() == 198
    assert paths.cyclic_core(make_edges(spark, chain[::2])).count() == 0
    assert paths.cyclic_core(make_edges(spark, [])).count() == 0


@pytest.mark.parametrize("damping", [1.0, 0.85])
def test_dangling_vertices_meet_the_last_round_only(spark, monkeypatch, damping):
    from edgeframe.operators import pagerank as pr
    rng = random.Random(5)
    e = [(rng.randrange(8), rng.randrange(60)) for _ in range(120)] + [(1, 1), (2, 3), (2, 3)]
    seen, whole = [], pr.pagerank_round
    monkeypatch.setattr(pr, "pagerank_round", lambda r, adj, vt, *a: seen.append(adj.rows().count()) or whole(r, adj, vt, *a))
    ranks, trace = pr.pagerank(make_edges(spark, e), iters=4, damping=damping)
    ids, out = {v for x in e for v in x}, {a: sum(a == b for b, _ in e) for a, _ in e}
    inside = len({x for x in e if x[1] in out})
    assert seen == [inside] * 3 + [len(set(e))] and inside < 40
    want, deltas = dict.fromkeys(ids, 1 / len(ids)), []
    for _ in range(4):
        deltas.append(sum(want[v] for v in ids if v not in out))
        got = dict.fromkeys(ids, deltas[-1] / len(ids))
        for a, b in e:
            got[b] += want[a] / out[a]
        want = {v: damping * got[v] + (1 - damping) / len(ids) for v in ids}
    assert {r["id"]: r["pr"] for r in ranks.collect()} == pytest.approx(want, abs=1e-14)
    at = {(r["round"], r["metric"]): r["value"] for r in trace.collect()}
    assert [at[i, "delta"] for i in range(1, 5)] == pytest.approx(deltas, abs=1e-14)
    assert [at[i, "total"] for i in range(1, 5)] == pytest.approx([1.0] * 4, abs=1e-14)
