"""ANSI/DuckDB SQL for the oracle check: views, and builders for unrolled loops.

The driver registers each parquet table as a view (``lineitem``, ``orders``,
...).  The edge views below mirror ``edgeframe.sources.tables`` exactly.
"""

from __future__ import annotations

VIEWS = {
    "eps": "SELECT l_partkey AS src, l_suppkey AS dst FROM lineitem "
           "WHERE l_partkey IS NOT NULL AND l_suppkey IS NOT NULL",
    "esp": "SELECT l_suppkey AS src, l_partkey AS dst FROM lineitem "
           "WHERE l_partkey IS NOT NULL AND l_suppkey IS NOT NULL",
    "eco": "SELECT src, dst FROM (SELECT o_custkey AS src, "
           "o_orderkey % (SELECT count(*) FROM customer) AS dst FROM orders) "
           "WHERE src IS NOT NULL AND dst IS NOT NULL",
    "pts": "SELECT doc_id AS id, n_chars AS v FROM documents WHERE n_chars IS NOT NULL",
    "chain": "SELECT c_custkey + 1 AS src, CASE WHEN (c_custkey + 1) % 100 <> 0 "
             "AND c_custkey + 1 < (SELECT max(c_custkey) + 1 FROM customer) "
             "THEN c_custkey + 2 ELSE 0 END AS dst FROM customer WHERE c_custkey IS NOT NULL",
}


def sql(body: str, *ctes, recursive: bool = False) -> str:
    """Prefix ``body`` with a WITH clause.  ``ctes`` are view names from
    :data:`VIEWS` or ``(name, sql[, materialized])`` tuples, in dependency order."""
    parts = []
    for c in ctes:
        if isinstance(c, str):
            parts.append(f"{c} AS ({VIEWS[c]})")
        else:
            mat = "MATERIALIZED " if len(c) > 2 and c[2] else ""
            parts.append(f"{c[0]} AS {mat}({c[1]})")
    head = "WITH RECURSIVE " if recursive else "WITH "
    return (head + ",\n".join(parts) + "\n" + body) if parts else body


def in_degree_sql(view: str) -> str:
    return f"SELECT dst AS id, count(*) AS followers FROM {view} GROUP BY dst"


def degree_pairs_sql(view: str) -> str:
    return (f"SELECT id, sum(o)::BIGINT AS out_deg, sum(i)::BIGINT AS in_deg FROM ("
            f"SELECT src AS id, 1 AS o, 0 AS i FROM {view} UNION ALL "
            f"SELECT dst AS id, 0 AS o, 1 AS i FROM {view}) GROUP BY id")


def bfs_ctes(view: str, source: int, rounds: int) -> list:
    """``e`` (distinct edges), ``b`` (walk levels), ``m`` (min level), ``vv`` (vertices)."""
    return [
        ("e", f"SELECT DISTINCT src, dst FROM {view}"),
        ("b(v, d)", f"SELECT {source}::BIGINT, 0::BIGINT UNION "
                    f"SELECT e.dst, b.d + 1 FROM b JOIN e ON e.src = b.v WHERE b.d < {rounds}"),
        ("m", "SELECT v, min(d) AS d FROM b GROUP BY v"),
        ("vv", "SELECT src AS id FROM e UNION SELECT dst AS id FROM e"),
    ]


def weighted_ctes(view: str, source: int, rounds: int, weight_sql: str) -> list:
    return [
        ("e", f"SELECT src, dst, min({weight_sql}) AS w FROM {view} GROUP BY src, dst"),
        ("b(v, d, h)", f"SELECT {source}::BIGINT, 0::BIGINT, 0 UNION "
                       f"SELECT v, min(d), h FROM (SELECT e.dst AS v, b.d + e.w AS d, b.h + 1 AS h "
                       f"FROM b JOIN e ON e.src = b.v WHERE b.h < {rounds}) GROUP BY v, h"),
        ("m", "SELECT v, min(d) AS d FROM b GROUP BY v"),
        ("vv", "SELECT src AS id FROM e UNION SELECT dst AS id FROM e"),
    ]


SSSP_OUT = "SELECT vv.id, coalesce(m.d, 2147483647)::BIGINT AS dist FROM vv LEFT JOIN m ON m.v = vv.id"


def pagerank_ctes(edge_view: str, vertex_sql: str, iters: int) -> list:
    """Unrolled rounds ``r0 .. r{iters}`` plus ``v, e, od, nn``."""
    ctes = [
        ("v", vertex_sql),
        ("e", f"SELECT src, dst FROM {edge_view} WHERE dst IN (SELECT id FROM v)"),
        ("od", "SELECT src, count(*) AS od FROM e GROUP BY src"),
        ("nn", "SELECT count(*) AS n FROM v"),
        ("r0", "SELECT id, 1.0::DOUBLE / (SELECT n FROM nn) AS pr FROM v"),
    ]
    for i in range(1, iters + 1):
        p = f"r{i - 1}"
        ctes.append((f"r{i}", (
            f"SELECT v.id, coalesce(x.c, 0.0::DOUBLE) + "
            f"(SELECT coalesce(sum(pr), 0.0::DOUBLE) FROM {p} WHERE id NOT IN (SELECT src FROM od))"
            f" / (SELECT n FROM nn) AS pr FROM v LEFT JOIN ("
            f"SELECT e.dst AS id, sum(p.pr / od.od) AS c FROM e JOIN {p} p ON e.src = p.id "
            f"JOIN od ON od.src = e.src GROUP BY e.dst) x ON v.id = x.id"), True))
    return ctes


def kmeans_ctes(points_sql: str, seeds_sql: str, iters: int) -> list:
    """``p(pid, v)``, ``c0`` seeds, then per round ``a{i}`` assignment, ``g{i}`` update."""
    ctes = [("p", points_sql), ("c0", f"SELECT DISTINCT centroid AS c FROM ({seeds_sql})")]
    for i in range(1, iters + 1):
        c = f"c{i - 1}"
        ctes.append((f"a{i}", f"SELECT p.pid, p.v, arg_min({c}.c, (abs({c}.c - p.v), {c}.c)) AS c "
                              f"FROM p, {c} GROUP BY p.pid, p.v"))
        ctes.append((f"g{i}", f"SELECT c AS old_centroid, sum(v)::BIGINT // count(*) AS centroid, "
                              f"count(*) AS n, sum((c - v) * (c - v))::BIGINT AS sse "
                              f"FROM a{i} GROUP BY c", True))
        ctes.append((f"c{i}", f"SELECT DISTINCT centroid AS c FROM g{i}"))
    return ctes


def seeds_sql(points_view: str, k: int) -> str:
    return (f"SELECT (mn + i * ((mn + mx) // {k}))::BIGINT AS centroid FROM "
            f"(SELECT least(0, min(v)) AS mn, greatest(0, max(v)) AS mx FROM {points_view}) s, "
            f"range(0, {k + 1}) t(i)")
