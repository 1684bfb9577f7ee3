"""2-hop paths and closed 2-paths (triangles) under three semantics.

Semantics (all count directed closed walks a->b->c->a, vertices may repeat):

* ``join``  - one hit per (2-path, closing edge): sum of m(a,b) m(b,c) m(c,a)
* ``semi``  - one hit per 2-path that has a closing edge: sum m(a,b) m(b,c) [m(c,a) > 0]
* ``distinct_pairs`` - number of distinct endpoint pairs (a, c) with a 2-path
  a->b->c and an edge c->a

``m`` is the edge multiplicity.  ``triangles`` is always ``hits div 3``.

Strategies:

* ``shuffle``   - the reference's reduce-side plan: multiplicity-weighted
  2-paths by a sort-merge self-join, those that may close (a bit set of the
  reversed edges tells) joined with the closing edge by another.
* ``broadcast`` - the replicated plan: the edge table is broadcast to every
  task when its row count is proven small; beyond the bound it falls back to
  ``shuffle``.
* ``oriented``  - degree-ordered enumeration.  Each undirected
  triangle is found once, from its lowest-ranked vertex, by walking only
  towards higher-ranked vertices; a vertex has at most sqrt(2m) higher-ranked
  neighbours, so the wedge join is O(m^1.5) in total and a hub vertex never
  produces a quadratic group.  Self-loop walks are added by two keyed joins.
* ``auto`` (default) - ``broadcast`` (path plan) unless the exact 2-path
  count is well above a bound of the oriented plan's wedges; both come from one
  degree aggregate over the multiplicity table that the chosen plan then uses.

All but ``implicit`` work on the edges that may lie on a closed walk (:func:`cyclic_core`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeframe.operators.common import (DEFAULT_BROADCAST_ROWS, big_sum, bounded_broadcast, hot_key_join, hot_keys,
                                        spread, wide, written_table)
from edgeframe.operators.relational import filter_max_id

SEMANTICS = ("join", "semi", "distinct_pairs")


def _zero():
    return F.lit(0).cast("bigint")


def multiplicity(edges: DataFrame) -> DataFrame:
    """``(src, dst, w)``: distinct directed edges with their copy count."""
    return edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("w"))


# ---------------------------------------------------------------- 2-paths

#: rows of either side of a block, where a middle vertex's in-list times out-list is cut up
PATH_BLOCK = 1024


def _path2_blocks(edges: DataFrame) -> DataFrame:
    """2-paths with the lists of hubs cut into blocks.

    A middle vertex with ``in * out`` paths above ``PATH_BLOCK`` squared is a hub; its in-edges are dealt
    to I blocks and its out-edges to J, every in-block meets every out-block under a key of its
    own, and so no key makes more than about ``PATH_BLOCK`` squared paths.  Edges of a hub are
    copied once per block of the other side, a ``PATH_BLOCK``-th of its paths.  All other vertices join as
    they are; without a hub that is the whole plan.  The hubs are broadcast, at most ``DEFAULT_BROADCAST_ROWS``."""
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    ends = edges.select(F.col("src").alias("v"), one.alias("o"), none.alias("i")).union(
        edges.select(F.col("dst").alias("v"), none.alias("o"), one.alias("i")))
    deg = ends.groupBy("v").agg(F.sum("o").alias("o"), F.sum("i").alias("i"))
    # the square roots of the paths sum up to at most the edges, so the hubs are few
    root = F.ceil(F.sqrt(F.col("o").cast("double") * F.col("i")))
    deg = deg.withColumn("root", root.cast("bigint"))
    keys, threshold, _ = hot_keys(deg, "v", "root", PATH_BLOCK)
    a = edges.select(F.col("src").alias("a"), F.col("dst").alias("b"))
    b = edges.select(F.col("src").alias("b"), F.col("dst").alias("c"))
    if keys is None:
        return a.join(b.hint("merge"), "b").select(F.col("a").alias("src"), F.col("c").alias("dst"))
    blocks = lambda n: F.ceil(F.col(n) / PATH_BLOCK).cast("bigint")
    hubs = written_table(deg.where(F.col("root") > threshold).select(
        F.col("v").alias("b"), blocks("i").alias("ins"), blocks("o").alias("outs")), "path_hubs")
    light = lambda side: side.join(F.broadcast(hubs.select("b")), "b", "left_anti")

    def dealt(side: DataFrame, own: str, other: str) -> DataFrame:
        """Edges of hubs, written, numbered, and copied to every block of the other side."""
        rows = written_table(side.join(F.broadcast(hubs.select("b")), "b", "left_semi"), "hub_edges")
        numbered = spread(rows.withColumn("n", F.monotonically_increasing_id()))
        return numbered.join(F.broadcast(hubs), "b").withColumn(own, F.col("n") % F.col(own)) \
            .withColumn(other, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(other) - 1))).drop("n")

    heavy = dealt(a, "ins", "outs").join(dealt(b, "outs", "ins").hint("merge"), ["b", "ins", "outs"])
    return light(a).join(light(b).hint("merge"), "b").select("a", "c").union(heavy.select("a", "c")).toDF("src", "dst")


def path2(edges: DataFrame, strategy: str = "blocks", max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
          max_id: int | None = None) -> DataFrame:
    """All 2-hop paths ``(src, dst)`` as a bag (a->b->a walks included).

    ``blocks``: sort-merge self-join in which a hub's paths are spread over many keys
    (:func:`_path2_blocks`); ``merge``: the plain sort-merge self-join; ``broadcast``: replicate the edge side
    when proven small (else a shuffle join); ``auto``: ``broadcast``; ``implicit``: join
    without a condition plus an equality filter, which Catalyst turns into the
    same equi-join.  ``max_id`` keeps edges with both ids at most that.  Every
    2-path is a row: :func:`path2_count` tells how many before any is made.
    """
    if max_id is not None:
        edges = filter_max_id(edges, max_id)
    if strategy == "blocks":
        return _path2_blocks(edges)
    a = edges.select(F.col("src").alias("a"), F.col("dst").alias("b"))
    b = edges.select(F.col("src").alias("b2"), F.col("dst").alias("c"))
    if strategy == "merge":
        j = a.join(b.hint("merge"), F.col("b") == F.col("b2"))
    elif strategy in ("broadcast", "auto"):
        side, _ = bounded_broadcast(b, max_broadcast_rows)
        j = a.join(side, F.col("b") == F.col("b2"))
    elif strategy == "implicit":
        j = a.join(b).where(F.col("b") == F.col("b2"))
    else:
        raise ValueError(f"unknown path2 strategy {strategy!r}")
    return j.select(F.col("a").alias("src"), F.col("c").alias("dst"))


def path2_count(edges: DataFrame) -> DataFrame:
    """Number of 2-paths, ``sum over b of in(b) * out(b)``; no join is executed."""
    outs = edges.groupBy(F.col("src").alias("v")).agg(F.count(F.lit(1)).alias("o"))
    ins = edges.groupBy(F.col("dst").alias("v")).agg(F.count(F.lit(1)).alias("i"))
    return outs.join(ins, "v").agg(big_sum(wide(F.col("o")) * wide(F.col("i"))).alias("n_paths"))


def closed_pairs(edges: DataFrame, max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                 strategy: str = "auto") -> DataFrame:
    """Distinct 2-path endpoint pairs ``(a, c)`` whose reverse edge ``c->a`` exists.

    ``auto`` takes the oriented plan where a hub makes the 2-paths many
    (:func:`choose_strategy`), else ``paths``, the ``INTERSECT`` of the 2-path endpoint set and the reversed edge set.  The
    paths come from the distinct edges (the set is the same) and are not
    aggregated first: Catalyst turns ``intersect`` into a left-semi join
    followed by a distinct, so only the closed pairs are ever deduplicated.
    """
    d = _written_multiplicity(edges)
    if strategy == "auto" and choose_strategy(d) == "oriented":
        return _closed_pairs_of(d)
    d = d.select("src", "dst")
    a = d.select(F.col("src").alias("a"), F.col("dst").alias("b"))
    b = d.select(F.col("src").alias("b2"), F.col("dst").alias("c"))
    rev, _ = bounded_broadcast(d.select(F.col("dst").alias("src"), F.col("src").alias("dst")),
                               max_broadcast_rows)
    p = a.join(b, F.col("b") == F.col("b2")).select(F.col("a").alias("src"), F.col("c").alias("dst"))
    return p.intersect(rev)


#: :func:`cyclic_core` goes on while a round drops more than one in so many of its edges
CORE_SHARE = 8


def _with_end(edges: DataFrame, end: str, vertices: DataFrame) -> DataFrame:
    """The edges whose ``end`` is one of the written ``vertices(v)``."""
    vertices, _ = bounded_broadcast(vertices.select(F.col("v").alias(end)))
    return edges.join(vertices, end, "left_semi").select("src", "dst")


def cyclic_core(edges: DataFrame) -> DataFrame:
    """The written edges ``(src, dst)`` that may lie on a closed walk, with all their copies.

    On a closed walk every vertex has an edge in and an edge out, so an edge whose source has
    no in-edge or whose target has no out-edge is on none; without it, others are without
    one, and so on.  A round is two semi-joins with the ids of one side, which are
    broadcast where proven few.  Rounds end when one drops no more than a ``CORE_SHARE``-th of its
    edges: each round has at most 1 - 1 / ``CORE_SHARE`` times the edges of the one before,
    so all rounds cost at most ``CORE_SHARE`` times the first."""
    while True:
        counted = lambda side, rows: written_table(
            rows.groupBy(F.col(side).alias("v")).agg(F.count(F.lit(1)).alias("n")), f"core_{side}")
        targets = counted("dst", edges)
        before = targets.agg(F.sum("n")).first()[0] or 0
        left = written_table(_with_end(edges, "src", targets), "core_out")
        edges = written_table(_with_end(left, "dst", counted("src", left)), "core")
        after = edges.count()
        if CORE_SHARE * (before - after) <= before or not after:
            return edges


def _written_multiplicity(edges: DataFrame) -> DataFrame:
    """The multiplicity table of the edges that closed walks can have, written once: every plan
    reads it several times."""
    return written_table(multiplicity(cyclic_core(edges)), "multiplicity")


#: most bits of the filter before the closing join: 64 to a row, so the rows are at most
#: ``DEFAULT_BROADCAST_ROWS``
FILTER_BITS = 1 << 26


def _closing_filter(m: DataFrame, n_edges: int) -> tuple[DataFrame, int] | None:
    """A bit set of the hashed reversed edges as ``(word, bits)`` rows, and its number of bits.
    None where the edges would fill more than half of it."""
    bits = 1 << max(10, (16 * n_edges).bit_length())
    bits = min(bits, FILTER_BITS)
    if 2 * n_edges > bits:
        return None
    at = F.pmod(F.xxhash64(F.col("dst"), F.col("src")), F.lit(bits))
    one = F.lit(1).cast("bigint")
    words = m.select(F.shiftright(at, 6).alias("word"), F.call_function("shiftleft", one, (at % 64).cast("int")).alias("bit")) \
        .groupBy("word").agg(F.bit_or("bit").alias("bits"))
    return words, bits


def _may_close(paths: DataFrame, words: DataFrame, bits: int) -> DataFrame:
    """The 2-paths ``(a, c)`` whose closing edge's bit is set."""
    at = F.pmod(F.xxhash64(F.col("a"), F.col("c")), F.lit(bits))
    probed = paths.withColumn("at", at).join(F.broadcast(words), F.shiftright(F.col("at"), 6) == F.col("word"))
    own = F.call_function("shiftright", F.col("bits"), (F.col("at") % 64).cast("int"))
    return probed.where(own.bitwiseAND(F.lit(1).cast("bigint")) == 1).drop("at", "word", "bits")


def _count_path_plan(m: DataFrame, semantics: str, strategy: str, max_broadcast_rows: int) -> DataFrame:
    """2-paths of the written multiplicity table joined with the closing edge.

    ``shuffle``: both joins are sort-merge joins (the reduce-side plan), so either may spill.  A
    2-path is shuffled to the closing join only if the bit set of the reversed edges, a broadcast
    of bounded size, has its bit; beyond that bound all are.
    ``broadcast``: the edge table is replicated to both probes when proven small.
    """
    small = strategy == "broadcast" and bounded_broadcast(m, max_broadcast_rows)[1]
    a = m.select(F.col("src").alias("a"), F.col("dst").alias("b"), F.col("w").alias("w1"))
    b = m.select(F.col("src").alias("b2"), F.col("dst").alias("c"), F.col("w").alias("w2"))
    close = m.select(F.col("src").alias("cs"), F.col("dst").alias("cd"), F.col("w").alias("wc"))
    if small:
        b, close, a = F.broadcast(b), F.broadcast(close), spread(a)
    else:
        b, close = b.hint("merge"), close.hint("merge")
    p = a.join(b, F.col("b") == F.col("b2"))
    if not small and (bloom := _closing_filter(m, m.count())):
        p = _may_close(p, *bloom)
    j = p.join(close, (F.col("c") == F.col("cs")) & (F.col("a") == F.col("cd")))
    if semantics == "join":
        hits = wide(F.col("w1")) * wide(F.col("w2") * F.col("wc"))
    elif semantics == "semi":
        hits = wide(F.col("w1")) * wide(F.col("w2"))
    else:
        return j.select("a", "c").distinct().agg(F.count(F.lit(1)).alias("hits"))
    return j.agg(big_sum(hits).alias("hits"))


def closed_by_side(rows: DataFrame, path_side: str = "P", edge_side: str = "E") -> DataFrame:
    """Bag semantics over tagged rows ``(side, src, dst)`` of 2-paths and edges: both sides meet under the
    path's endpoint pair, counted per task before they are shuffled, and each pair adds paths times
    closing edges.  One row like :func:`triangle_count`."""
    is_path = F.col("side") == path_side
    keyed = rows.where(F.col("side").isin(path_side, edge_side)).select(
        F.when(is_path, F.col("src")).otherwise(F.col("dst")).alias("a"),
        F.when(is_path, F.col("dst")).otherwise(F.col("src")).alias("c"), is_path.cast("int").alias("p"))
    pairs = keyed.groupBy("a", "c").agg(F.sum("p").alias("p"), F.sum(1 - F.col("p")).alias("e"))
    return _hits_row(pairs.agg(big_sum(wide(F.col("p")) * wide(F.col("e"))).alias("hits")), "closed_paths")


def _hits_row(hits: DataFrame, name: str) -> DataFrame:
    whole = F.col("hits").cast("decimal(38,0)")
    return hits.select(whole.alias(name), ((whole - whole % 3) / 3).cast("decimal(38,0)").alias("triangles"))


def _implicit_join_count(edges: DataFrame) -> DataFrame:
    """Bag semantics: the implicit-join 2-paths that meet a closing edge."""
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    return path2(edges, "implicit").join(back, ["src", "dst"]).agg(F.count(F.lit(1)).alias("hits"))


# ------------------------------------------------------ degree-ordered plan

def _orient(pairs: DataFrame) -> DataFrame:
    """Orient undirected ``pairs(lo, hi, up, dn)`` from lower to higher rank.

    Returns ``(x, y, yd, f, r)`` with rank(x) < rank(y), f = m(x,y), r = m(y,x)
    and yd the degree of y; rank = (undirected degree, id).
    """
    deg = pairs.select(F.col("lo").alias("v")).union(pairs.select(F.col("hi").alias("v"))) \
        .groupBy("v").agg(F.count(F.lit(1)).alias("d"))
    # degree lookups for both endpoints; a hub's pairs are joined map-side
    dl = deg.select(F.col("v").alias("lo"), F.col("d").alias("ld"))
    dh = deg.select(F.col("v").alias("hi"), F.col("d").alias("hd"))
    ranked = hot_key_join(hot_key_join(pairs, dl, "lo", "ld"), dh, "hi", "hd")
    lo_first = F.col("ld") <= F.col("hd")   # equal degrees: the smaller id (lo) ranks first
    oriented = ranked.select(
        F.when(lo_first, F.col("lo")).otherwise(F.col("hi")).alias("x"),
        F.when(lo_first, F.col("hi")).otherwise(F.col("lo")).alias("y"),
        F.when(lo_first, F.col("hd")).otherwise(F.col("ld")).alias("yd"),
        F.when(lo_first, F.col("up")).otherwise(F.col("dn")).alias("f"),
        F.when(lo_first, F.col("dn")).otherwise(F.col("up")).alias("r"))
    return oriented


def _triangles(oriented: DataFrame, n_oriented: int | None = None,
               max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Each undirected triangle once: ``(x, y, z)`` in rank order with the six
    directed multiplicities: a1=m(x,y) b1=m(y,z) c1=m(z,x) (cycle x->y->z->x)
    and a2=m(x,z) b2=m(z,y) c2=m(y,x) (cycle x->z->y->x).

    When the oriented table is proven small it is broadcast to both probes, so
    the wedge walk and the closing lookup run in one map-side pipeline with no
    shuffle of wedges; otherwise both joins are shuffle joins.  A wedge joins two
    edges at its lowest vertex ``x``, of which no key has more than sqrt(2m) rows,
    so a hub is never a hot key; the closing lookup goes by the pair (y, z)."""
    o1 = oriented.select(F.col("x"), F.col("y"), F.col("yd"), F.col("f").alias("fxy"), F.col("r").alias("ryx"))
    o2 = oriented.select(F.col("x").alias("x2"), F.col("y").alias("z"), F.col("yd").alias("zd"),
                         F.col("f").alias("fxz"), F.col("r").alias("rzx"))
    o3 = oriented.select(F.col("x").alias("y3"), F.col("y").alias("z3"),
                         F.col("f").alias("fyz"), F.col("r").alias("rzy"))
    if n_oriented is None:
        o2, small = bounded_broadcast(o2, max_broadcast_rows)
    else:
        small = n_oriented <= max_broadcast_rows
        o2 = F.broadcast(o2) if small else o2
    if small:
        o3 = F.broadcast(o3)
        o1 = spread(o1)
    upward = (F.col("yd") < F.col("zd")) | ((F.col("yd") == F.col("zd")) & (F.col("y") < F.col("z")))
    wedges = o1.join(o2, (F.col("x") == F.col("x2")) & upward)
    tri = wedges.join(o3, (F.col("y") == F.col("y3")) & (F.col("z") == F.col("z3")))
    return tri.select("x", "y", "z",
                      F.col("fxy").alias("a1"), F.col("fyz").alias("b1"), F.col("rzx").alias("c1"),
                      F.col("fxz").alias("a2"), F.col("rzy").alias("b2"), F.col("ryx").alias("c2"))


def _loop_two_cycles(loops: DataFrame, pairs: DataFrame) -> DataFrame:
    """Self-loop at u joined with each 2-cycle u<->v: ``(u, v, s, a=m(u,v), b=m(v,u))``."""
    two = pairs.where((F.col("up") > 0) & (F.col("dn") > 0))
    at_lo = two.join(loops, F.col("lo") == F.col("v")).select(
        F.col("lo").alias("u"), F.col("hi").alias("w_"), "s",
        F.col("up").alias("a"), F.col("dn").alias("b"))
    at_hi = two.join(loops, F.col("hi") == F.col("v")).select(
        F.col("hi").alias("u"), F.col("lo").alias("w_"), "s",
        F.col("dn").alias("a"), F.col("up").alias("b"))
    return at_lo.unionByName(at_hi)


def _semi_terms(a: Column, b: Column, c: Column) -> Column:
    """Walk hits of one directed 3-cycle under semi semantics."""
    return F.when((a > 0) & (b > 0) & (c > 0), wide(a) * wide(b) + wide(b) * wide(c) + wide(c) * wide(a)) \
        .otherwise(_zero())


def _oriented_inputs(m: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """Materialised loops, pairs and oriented edges from the multiplicity table:
    one aggregation by unordered endpoint pair sums both directions (and
    self-loops, where lo = hi)."""
    lo, hi = F.least("src", "dst"), F.greatest("src", "dst")
    of = lambda cond: F.sum(F.when(cond, F.col("w")).otherwise(_zero()))
    und = written_table(m.groupBy(lo.alias("lo"), hi.alias("hi")).agg(
        of(F.col("src") < F.col("dst")).alias("up"), of(F.col("src") > F.col("dst")).alias("dn"),
        of(F.col("src") == F.col("dst")).alias("s")), "pairs")
    loops = und.where(F.col("lo") == F.col("hi")).select(F.col("lo").alias("v"), "s")
    pairs = und.where(F.col("lo") < F.col("hi")).select("lo", "hi", "up", "dn")
    oriented = written_table(_orient(pairs), "oriented")
    return loops, pairs, oriented, oriented.count()         # from the files' footers


def _count_oriented(m: DataFrame, semantics: str) -> DataFrame:
    loops, pairs, oriented, n_oriented = _oriented_inputs(m)
    tri = _triangles(oriented, n_oriented)
    lc = _loop_two_cycles(loops, pairs)
    w = lambda *cols: [wide(F.col(c)) for c in cols]
    if semantics == "join":
        a1, b1, c1, a2, b2, c2 = w("a1", "b1", "c1", "a2", "b2", "c2")
        t = tri.agg(big_sum(3 * (a1 * b1 * c1 + a2 * b2 * c2)).alias("h"))
        s, a, b = w("s", "a", "b")
        c = lc.agg(big_sum(3 * (s * a * b)).alias("h"))
        s = loops.agg(big_sum(s * s * s).alias("h"))
    elif semantics == "semi":
        t = tri.agg(big_sum(_semi_terms(F.col("a1"), F.col("b1"), F.col("c1"))
                            + _semi_terms(F.col("a2"), F.col("b2"), F.col("c2"))).alias("h"))
        s, a, b = w("s", "a", "b")
        c = lc.agg(big_sum(s * (a + b) + a * b).alias("h"))
        s = loops.agg(big_sum(s * s).alias("h"))
    else:
        return closed_pair_edges(tri, loops, lc).agg(F.count(F.lit(1)).alias("hits"))
    return t.unionByName(s).unionByName(c).agg(big_sum(F.col("h")).alias("hits"))


def closed_pair_edges(tri: DataFrame, loops: DataFrame, lc: DataFrame) -> DataFrame:
    """Distinct closing edges ``(src, dst)`` of all closed walks (oriented plan)."""
    def cyc(a, b, c, e1, e2, e3):
        ok = (F.col(a) > 0) & (F.col(b) > 0) & (F.col(c) > 0)
        arr = F.array(*[F.struct(F.col(p).alias("src"), F.col(q).alias("dst")) for p, q in (e1, e2, e3)])
        return tri.where(ok).select(F.explode(arr).alias("e"))
    c1 = cyc("a1", "b1", "c1", ("x", "y"), ("y", "z"), ("z", "x"))
    c2 = cyc("a2", "b2", "c2", ("x", "z"), ("z", "y"), ("y", "x"))
    own = loops.select(F.struct(F.col("v").alias("src"), F.col("v").alias("dst")).alias("e"))
    lce = lc.select(F.explode(F.array(
        F.struct(F.col("u").alias("src"), F.col("w_").alias("dst")),
        F.struct(F.col("w_").alias("src"), F.col("u").alias("dst")))).alias("e"))
    return c1.union(c2).union(own).union(lce).select("e.src", "e.dst").distinct()


def closed_pairs_oriented(edges: DataFrame) -> DataFrame:
    """Same set as :func:`closed_pairs`, reported as the 2-path endpoints ``(a, c)``."""
    return _closed_pairs_of(_written_multiplicity(edges))


def _closed_pairs_of(m: DataFrame) -> DataFrame:
    loops, pairs, oriented, n_oriented = _oriented_inputs(m)
    e = closed_pair_edges(_triangles(oriented, n_oriented), loops, _loop_two_cycles(loops, pairs))
    return e.select(F.col("dst").alias("src"), F.col("src").alias("dst"))


# ------------------------------------------------------------ public entry

def choose_strategy(m: DataFrame, factor: float = 4.0) -> str:
    """``broadcast`` (the path plan) unless its 2-paths outnumber ``factor`` times the wedges of
    the degree-ordered plan; then ``oriented``.

    One aggregate over the distinct edges ``m`` decides: the exact number of
    2-paths ``sum over b of in(b) * out(b)``, and a bound of the wedges, ``sum of
    min(d, sqrt(2m))^2 / 2`` over the degrees ``d``, since a vertex has at most
    d and at most sqrt(2m) higher-ranked neighbours.  ``factor`` is what an
    oriented wedge costs more than a 2-path.
    """
    one = F.lit(1).cast("bigint")
    tagged = m.select(F.col("src").alias("v"), one.alias("o"), _zero().alias("i")).union(
        m.select(F.col("dst").alias("v"), _zero().alias("o"), one.alias("i")))
    deg = tagged.groupBy("v").agg(F.sum("o").alias("o"), F.sum("i").alias("i"))
    deg = written_table(deg.groupBy((F.col("o") + F.col("i")).alias("d")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("o").alias("o"),
        big_sum(wide(F.col("o")) * wide(F.col("i"))).alias("paths")), "degrees")   # one row per degree
    m_edges = deg.agg(F.sum("o")).first()[0] or 0
    higher = F.least(F.col("d").cast("double"), F.lit((2.0 * m_edges) ** 0.5))
    row = deg.agg(F.sum("paths").alias("paths"), F.sum(F.col("n") * higher * higher / 2).alias("wedges")).first()
    return "broadcast" if float(row["paths"] or 0) <= factor * (row["wedges"] or 0.0) else "oriented"


def triangle_count(edges: DataFrame, semantics: str = "join", strategy: str = "auto",
                   max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """One row: raw hits and ``triangles = hits div 3``, as decimal(38,0).

    The hit column is ``closed_pairs`` for ``distinct_pairs`` and
    ``closed_paths`` otherwise.  ``strategy`` is ``auto`` (default, see
    :func:`choose_strategy`), ``oriented``, ``shuffle``, ``broadcast`` or
    ``implicit`` (join semantics only).
    """
    if semantics not in SEMANTICS:
        raise ValueError(f"unknown semantics {semantics!r}")
    if strategy == "implicit":
        if semantics != "join":
            raise ValueError("the implicit-join plan computes join semantics only")
        hits = _implicit_join_count(edges)
    elif strategy in ("auto", "oriented", "shuffle", "broadcast"):
        m = _written_multiplicity(edges)
        strategy = choose_strategy(m) if strategy == "auto" else strategy
        hits = _count_oriented(m, semantics) if strategy == "oriented" else \
            _count_path_plan(m, semantics, strategy, max_broadcast_rows)
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    return _hits_row(hits, "closed_pairs" if semantics == "distinct_pairs" else "closed_paths")
