"""Named queries: ``name -> (spark_fn(spark, sf_dir) -> DataFrame, oracle SQL or None)``.

Every query reads the driver's tables (or frames Spark derives from them) in
full.  Limits appear only where they are the operator (top-n report, sample).
Column names and types match the oracle SQL exactly.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from edgeframe.functions import scalar as fx
from edgeframe.operators import adjacency as adj_ops
from edgeframe.operators import degrees, kmeans, pagerank, paths, relational, sampling, sssp
from edgeframe.plans import oracle as o
from edgeframe.plans.oracle import sql
from edgeframe.session import scratch_path
from edgeframe.sources import files
from edgeframe.sources.tables import (chain_over_keys, edges_co, edges_ps, edges_sp, load_table,
                                      points_chars, vertices_of)

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}

# Fixed parameters of the registered queries.
MAX_ID = 100          # edge filter bound (the MaxFilter job's own parameter)
SOURCE = 1            # shortest-path source vertex
ROUNDS = 10           # shortest-path / PageRank / k-means rounds
K_SEEDS = 4           # equal-interval seeding: K intervals -> K + 1 seeds
BAD_SEEDS = [0, 100, 200, 300]
CHAIN_K = 100         # chain length of the synthetic chain graph
SAMPLE_K = 100        # vertex sample size
SAMPLE_SEED = 42
PR_DIGITS = 12        # rounding of ranks for the oracle compare


def register(name: str, oracle_sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = lambda spark, d: _as_bigint(fn(spark, d))
        if oracle_sql is not None:
            ORACLES[name] = oracle_sql
        return fn
    return deco


def _as_bigint(df: DataFrame) -> DataFrame:
    """Whole-number decimals (sums that cannot overflow) as bigint, the oracle's type; a value that
    does not fit fails the query."""
    whole = {c: F.col(c).cast("bigint") for c, t in df.dtypes if t == "decimal(38,0)"}
    return df.withColumns(whole) if whole else df


def _bigint(v) -> F.Column:
    return F.lit(v).cast("bigint")


# ================================================================ P0

@register("filter_max_id", sql(f"SELECT src, dst FROM eps WHERE src <= {MAX_ID} AND dst <= {MAX_ID}",
                               "eps"))
def q_filter_max_id(spark, d):
    return relational.filter_max_id(edges_ps(spark, d), MAX_ID)


@register("indegree_count", sql(o.in_degree_sql("eps"), "eps"))
def q_indegree_count(spark, d):
    return degrees.in_degree(edges_ps(spark, d))


# ================================================================ P1 sources / sinks

@register("src_edges_csv", sql("SELECT src, dst FROM eco", "eco"))
def q_src_edges_csv(spark, d):
    path = scratch_path(spark, "edges_csv")
    files.write_edges_csv(edges_co(spark, d), path)
    return files.read_edges_csv(spark, path)


@register("src_edges_csv_inferred", sql("SELECT src, dst FROM eco", "eco"))
def q_src_edges_csv_inferred(spark, d):
    path = scratch_path(spark, "edges_csv")
    files.write_edges_csv(edges_co(spark, d), path)
    return files.read_edges_csv_inferred(spark, path)


@register("src_text_lines", sql("SELECT CAST(src AS VARCHAR) || ',' || CAST(dst AS VARCHAR) AS value "
                                "FROM eco", "eco"))
def q_src_text_lines(spark, d):
    path = scratch_path(spark, "edges_csv")
    files.write_edges_csv(edges_co(spark, d), path)
    return files.read_text_lines(spark, path)


@register("src_adjacency_list", sql("SELECT DISTINCT src, dst FROM eco", "eco"))
def q_src_adjacency_list(spark, d):
    path = scratch_path(spark, "adjacency")
    files.write_adjacency_text(adj_ops.adjacency_list(edges_co(spark, d).distinct()), path)
    return adj_ops.edges_from_adjacency(files.read_adjacency_text(spark, path))


@register("src_whitespace_pairs", sql("SELECT dst AS id, count(*) AS v FROM eps GROUP BY dst", "eps"))
def q_src_whitespace_pairs(spark, d):
    path = scratch_path(spark, "followers_txt")
    files.write_key_value_text(degrees.in_degree(edges_ps(spark, d)), "id", "followers", path)
    return files.read_whitespace_tokens(spark, path, ["id", "v"])


@register("src_multi_input_union", sql(
    "SELECT 'E' AS side, src, dst FROM eco UNION ALL "
    "SELECT 'P' AS side, a.src, b.dst FROM eco a JOIN eco b ON a.dst = b.src", "eco"))
def q_src_multi_input_union(spark, d):
    """A TAB path file and a CSV edge file, read by one job with a parser for each."""
    return files.read_inputs(spark, _path_and_edge_files(spark, d))[0]


def _path_and_edge_files(spark, d) -> dict:
    e = edges_co(spark, d)
    at = {"E": (scratch_path(spark, "edges_csv"), ","), "P": (scratch_path(spark, "paths_tsv"), "\t")}
    files.write_edges_csv(e, at["E"][0])
    files.write_pairs_tsv(paths.path2(e), at["P"][0])
    return at


@register("closed_paths_two_inputs", sql(
    "SELECT count(*) AS closed_paths, count(*) // 3 AS triangles FROM eco a JOIN eco b ON a.dst = b.src "
    "JOIN eco c ON b.dst = c.src AND c.dst = a.src", "eco"))
def q_closed_paths_two_inputs(spark, d):
    """The second job of the reduce-side triangle chain: the stored 2-paths meet the edge file."""
    rows, _ = files.read_inputs(spark, _path_and_edge_files(spark, d))
    return paths.closed_by_side(rows)


@register("src_synthetic_chain_graph", sql("SELECT src, dst FROM chain", "chain"))
def q_src_synthetic_chain_graph(spark, d):
    return chain_over_keys(spark, d, CHAIN_K)


@register("chain_start_vertices", sql(f"SELECT src AS id FROM chain WHERE src % {CHAIN_K} = 1", "chain"))
def q_chain_start_vertices(spark, d):
    c = chain_over_keys(spark, d, CHAIN_K)
    return c.where(F.col("src") % CHAIN_K == 1).select(F.col("src").alias("id"))


@register("sink_roundtrip_csv", sql(o.in_degree_sql("eco"), "eco"))
def q_sink_roundtrip_csv(spark, d):
    path = scratch_path(spark, "followers_csv")
    degrees.in_degree(edges_co(spark, d)).write.mode("overwrite").csv(path)
    return spark.read.schema("id BIGINT, followers BIGINT").csv(path)


@register("sink_roundtrip_tsv", sql("SELECT src, dst FROM eco", "eco"))
def q_sink_roundtrip_tsv(spark, d):
    path = scratch_path(spark, "edges_tsv")
    files.write_pairs_tsv(edges_co(spark, d), path)
    return files.read_pairs_tsv(spark, path, files.EDGE_SCHEMA)


@register("observed_metrics", sql(
    f"SELECT count(*) AS n_edges, max(src) AS max_src, "
    f"count(*) FILTER (WHERE src <= {MAX_ID} AND dst <= {MAX_ID}) AS n_kept FROM eps", "eps"))
def q_observed_metrics(spark, d):
    """The max-id filter as a map-only job whose side counters are observed metrics."""
    obs = Observation(f"max_filter_{uuid.uuid4().hex[:12]}")
    e = edges_ps(spark, d)
    watched = e.observe(obs, F.count(F.lit(1)).alias("n_edges"), F.max("src").alias("max_src"),
                        F.count_if((F.col("src") <= MAX_ID) & (F.col("dst") <= MAX_ID)).alias("n_kept"))
    files.write_pairs_tsv(relational.filter_max_id(watched, MAX_ID), scratch_path(spark, "max_filter"))
    m = obs.get
    return spark.createDataFrame([(m["n_edges"], m["max_src"], m["n_kept"])],
                                 "n_edges BIGINT, max_src BIGINT, n_kept BIGINT")


@register("src_search_state", sql(
    f"SELECT v.id, (CASE WHEN v.id = {SOURCE} THEN 0 ELSE 2147483647 END)::BIGINT AS dist, "
    "coalesce(d.n, 0) AS out_deg, (v.id = " + str(SOURCE) + ")::INTEGER AS visited FROM "
    "(SELECT src AS id FROM eco UNION SELECT dst AS id FROM eco) v LEFT JOIN "
    "(SELECT src, count(*) AS n FROM eco GROUP BY src) d ON v.id = d.src", "eco"))
def q_src_search_state(spark, d):
    """Round-0 shortest-path state in the text format of the MapReduce search."""
    e = edges_co(spark, d)
    adj = adj_ops.adjacency_list(e).select("id", "nbrs")
    init = sssp.initial_distances(vertices_of(e), SOURCE)
    state = init.join(adj, "id", "left").select(
        "id", F.coalesce("nbrs", F.array().cast("array<bigint>")).alias("nbrs"), "dist",
        (F.col("id") == SOURCE).alias("visited"))
    path = scratch_path(spark, "search_state")
    files.write_search_state(state, path)
    back = files.read_search_state(spark, path)
    return back.groupBy("id").agg(F.min("dist").alias("dist"),
                                  F.sum(F.size("nbrs")).cast("bigint").alias("out_deg"),
                                  F.max(F.col("visited").cast("int")).alias("visited"))


# ================================================================ P1 projections / sets / sorts

@register("limit_rows", sql(o.in_degree_sql("eco") + " ORDER BY followers DESC, id LIMIT 5", "eco"))
def q_limit_rows(spark, d):
    return relational.top_rows(degrees.in_degree(edges_co(spark, d)),
                               [F.col("followers").desc(), F.col("id")], 5)


@register("point_lookup", sql(f"SELECT followers FROM ({o.in_degree_sql('eco')}) WHERE id = 0", "eco"))
def q_point_lookup(spark, d):
    return degrees.in_degree(edges_co(spark, d)).where("id = 0").select("followers")


@register("project_last_field", sql("SELECT dst FROM eco", "eco"))
def q_project_last_field(spark, d):
    path = scratch_path(spark, "edges_csv")
    files.write_edges_csv(edges_co(spark, d), path)
    lines = files.read_text_lines(spark, path)
    return lines.select(fx.last_field(F.col("value")).cast("bigint").alias("dst"))


@register("project_reverse_edges", sql("SELECT dst AS src, src AS dst FROM eco", "eco"))
def q_project_reverse_edges(spark, d):
    return relational.reverse_edges(edges_co(spark, d))


@register("explode_adjacency", sql(
    "SELECT dst AS id, src AS msg FROM eco UNION ALL SELECT DISTINCT src AS id, src AS msg FROM eco",
    "eco"))
def q_explode_adjacency(spark, d):
    return adj_ops.explode_messages(adj_ops.adjacency_list(edges_co(spark, d)))


@register("array_append", sql(
    "SELECT src AS id, 0::BIGINT AS chunk, string_agg(CAST(dst AS VARCHAR), ',' ORDER BY dst) || ',-1' AS adj "
    "FROM eco GROUP BY src", "eco"))
def q_array_append(spark, d):
    return adj_ops.append_marker(adj_ops.adjacency_list(edges_co(spark, d)), -1)


# lists cut into chunks of 8: the sorted list's items 8c .. 8c + 7 are chunk c
SPLIT = 8
_CHUNKS = ("SELECT id, chunk, string_agg(CAST(dst AS VARCHAR), ',' ORDER BY dst) AS adj FROM (SELECT src AS id, dst, "
           f"((row_number() OVER (PARTITION BY src ORDER BY dst) - 1) // {SPLIT})::BIGINT AS chunk FROM eco) "
           "GROUP BY id, chunk")


@register("adjacency_list_split", sql(_CHUNKS, "eco"))
def q_adjacency_list_split(spark, d):
    return adj_ops.adjacency_text(adj_ops.adjacency_list(edges_co(spark, d), SPLIT))


@register("explode_adjacency_split", sql(
    "SELECT dst AS id, src AS msg FROM eco UNION ALL SELECT DISTINCT src AS id, src AS msg FROM eco", "eco"))
def q_explode_adjacency_split(spark, d):
    return adj_ops.explode_messages(adj_ops.adjacency_list(edges_co(spark, d), SPLIT))


@register("array_append_split", sql(
    "SELECT id, chunk, adj || CASE WHEN chunk = max(chunk) OVER (PARTITION BY id) THEN ',-1' ELSE '' END AS adj "
    f"FROM ({_CHUNKS})", "eco"))
def q_array_append_split(spark, d):
    return adj_ops.append_marker(adj_ops.adjacency_list(edges_co(spark, d), SPLIT), -1)


@register("array_exists", sql("SELECT DISTINCT src AS id FROM eco WHERE dst = 1", "eco"))
def q_array_exists(spark, d):
    return adj_ops.vertices_listing(adj_ops.adjacency_list(edges_co(spark, d)), 1)


@register("scalar_functions_text", sql(
    "SELECT CAST(string_split(line, ',')[1] AS BIGINT) AS src, "
    "CAST(string_split(line, ',')[-1] AS BIGINT) AS dst, substring(line, 1, 1) AS tag, "
    "substring(line, 2) AS tail, "
    "string_split(line, ',')[-1] || ',' || string_split(line, ',')[1] AS pair, "
    "CASE WHEN line = '' THEN 1 ELSE 0 END AS is_empty FROM "
    "(SELECT CAST(src AS VARCHAR) || ',' || CAST(dst AS VARCHAR) AS line FROM eco)", "eco"))
def q_scalar_functions_text(spark, d):
    line = F.col("line")
    lines = edges_co(spark, d).select(fx.pair_key(F.col("src"), F.col("dst")).alias("line"))
    return lines.select(
        fx.field(line, 0).cast("bigint").alias("src"),
        fx.last_field(line).cast("bigint").alias("dst"),
        fx.first_char(line).alias("tag"),
        fx.tail(line).alias("tail"),
        F.concat_ws(",", fx.last_field(line), fx.field(line, 0)).alias("pair"),
        fx.is_empty_flag(line).alias("is_empty"))


@register("scalar_functions_math", sql(
    "SELECT abs(src - dst) AS diff, least(src, dst) AS mn, src // 3 AS q, src % 7 AS m, "
    "dst * dst AS sq, round(src / (dst + 1), 9) AS ratio, "
    "CASE WHEN src > dst THEN src ELSE dst END AS br FROM eco", "eco"))
def q_scalar_functions_math(spark, d):
    s, t = F.col("src"), F.col("dst")
    return edges_co(spark, d).select(
        fx.abs_diff(s, t).alias("diff"), F.least(s, t).alias("mn"), fx.idiv(s, F.lit(3)).alias("q"),
        (s % 7).alias("m"), (t * t).alias("sq"), F.round(fx.ratio(s, t + 1), 9).alias("ratio"),
        fx.pick_larger(s, t).alias("br"))


@register("sort_by_key", sql(o.in_degree_sql("eco") + " ORDER BY id", "eco"))
def q_sort_by_key(spark, d):
    return relational.sort_by_key(degrees.in_degree(edges_co(spark, d)))


@register("union_all", sql(
    "SELECT dst AS id, src AS v FROM eco UNION ALL SELECT DISTINCT src AS id, 0 AS v FROM eco", "eco"))
def q_union_all(spark, d):
    return relational.union_with_zeros(edges_co(spark, d))


@register("union_three_min", sql(
    "SELECT id, min(v) AS v FROM (SELECT dst AS id, src AS v FROM eco UNION ALL "
    "SELECT src AS id, dst AS v FROM eco UNION ALL SELECT src AS id, src AS v FROM eco) GROUP BY id",
    "eco"))
def q_union_three_min(spark, d):
    return relational.union_three_min(edges_co(spark, d))


@register("distinct_vertices", sql("SELECT src AS id FROM eco UNION SELECT dst AS id FROM eco", "eco"))
def q_distinct_vertices(spark, d):
    return relational.distinct_vertices(edges_co(spark, d))


# ================================================================ P2 aggregations

@register("indegree_group_collect", sql(o.in_degree_sql("eps"), "eps"))
def q_indegree_group_collect(spark, d):
    return degrees.in_degree_group_collect(edges_ps(spark, d))


@register("indegree_reduce", sql(o.in_degree_sql("eps"), "eps"))
def q_indegree_reduce(spark, d):
    return degrees.in_degree_reduce(edges_ps(spark, d))


@register("indegree_fold_zero", sql(
    "SELECT v.id, coalesce(c.n, 0) AS followers FROM "
    "(SELECT src AS id FROM eps UNION SELECT dst AS id FROM eps) v LEFT JOIN "
    "(SELECT dst AS id, count(*) AS n FROM eps GROUP BY dst) c ON v.id = c.id", "eps"))
def q_indegree_fold_zero(spark, d):
    return degrees.in_degree_fold_zero(edges_ps(spark, d))


@register("group_avg", "SELECT l_suppkey AS id, round(avg(l_quantity), 9) AS avg_qty FROM lineitem "
                       "WHERE l_suppkey IS NOT NULL GROUP BY l_suppkey")
def q_group_avg(spark, d):
    li = load_table(spark, d, "lineitem").where(F.col("l_suppkey").isNotNull())
    return degrees.group_avg(li, "l_suppkey", "l_quantity", "avg_qty")


@register("min_per_key", sql("SELECT dst AS id, min(src) AS v FROM eco GROUP BY dst", "eco"))
def q_min_per_key(spark, d):
    return relational.min_per_key(edges_co(spark, d))


@register("value_range", sql("SELECT least(0, min(v)) AS mn, greatest(0, max(v)) AS mx FROM pts", "pts"))
def q_value_range(spark, d):
    return kmeans.value_range(points_chars(spark, d))


@register("degree_pairs", sql(o.degree_pairs_sql("eps"), "eps"))
def q_degree_pairs(spark, d):
    return degrees.degree_pairs(edges_ps(spark, d))


_CARD = ("SELECT id, CASE WHEN out_deg = 0 THEN in_deg WHEN in_deg = 0 THEN out_deg "
         "ELSE out_deg * in_deg END AS cardinality FROM dp")


@register("path2_cardinality", sql(_CARD, "eps", ("dp", o.degree_pairs_sql("eps"))))
def q_path2_cardinality(spark, d):
    return degrees.path2_cardinality(edges_ps(spark, d))


@register("path2_cardinality_total", sql(f"SELECT sum(cardinality)::BIGINT AS total FROM ({_CARD})",
                                         "eps", ("dp", o.degree_pairs_sql("eps"))))
def q_path2_cardinality_total(spark, d):
    return degrees.path2_cardinality_total(edges_ps(spark, d))


@register("path2_cardinality_total_files", sql(
    f"SELECT sum(cardinality)::BIGINT AS total FROM ({_CARD})", "eps", ("dp", o.degree_pairs_sql("eps"))))
def q_path2_cardinality_total_files(spark, d):
    """The estimate's total from a CSV edge file."""
    path = scratch_path(spark, "edges_csv")
    files.write_edges_csv(edges_ps(spark, d), path)
    return degrees.path2_cardinality_total(files.read_edges_csv(spark, path))


@register("path2_exact_total", sql("SELECT coalesce(sum(out_deg * in_deg), 0)::BIGINT AS total FROM dp",
                                   "eps", ("dp", o.degree_pairs_sql("eps"))))
def q_path2_exact_total(spark, d):
    return degrees.path2_exact_total(edges_ps(spark, d))


# ================================================================ P3 paths / triangles

_P2 = "SELECT a.src, b.dst FROM {v} a JOIN {v} b ON a.dst = b.src"
_TRI_JOIN = ("SELECT count(*) AS closed_paths, count(*) // 3 AS triangles FROM {v} a "
             "JOIN {v} b ON a.dst = b.src JOIN {v} c ON b.dst = c.src AND c.dst = a.src")
_TRI_SEMI = ("SELECT count(*) AS closed_paths, count(*) // 3 AS triangles FROM {v} a "
             "JOIN {v} b ON a.dst = b.src "
             "WHERE EXISTS (SELECT 1 FROM {v} c WHERE c.src = b.dst AND c.dst = a.src)")
_CLOSED = _P2 + " INTERSECT SELECT dst AS src, src AS dst FROM {v}"
_TRI_PAIRS = "SELECT count(*) AS closed_pairs, count(*) // 3 AS triangles FROM (" + _CLOSED + ")"


@register("path2_join", sql(_P2.format(v="eps"), "eps"))
def q_path2_join(spark, d):
    return paths.path2(edges_ps(spark, d), "blocks")


@register("path2_merge_join", sql(_P2.format(v="eps"), "eps"))
def q_path2_merge_join(spark, d):
    return paths.path2(edges_ps(spark, d), "merge")


@register("path2_broadcast_join", sql(_P2.format(v="eps"), "eps"))
def q_path2_broadcast_join(spark, d):
    return paths.path2(edges_ps(spark, d), "broadcast")


@register("path2_implicit_join", sql(_P2.format(v="eco"), "eco"))
def q_path2_implicit_join(spark, d):
    return paths.path2(edges_co(spark, d), "implicit")


@register("path2_count", sql("SELECT count(*) AS n_paths FROM (" + _P2.format(v="eps") + ")", "eps"))
def q_path2_count(spark, d):
    return paths.path2_count(edges_ps(spark, d))


@register("triangle_count_join", sql(_TRI_JOIN.format(v="eps"), "eps"))
def q_triangle_count_join(spark, d):
    return paths.triangle_count(edges_ps(spark, d), "join", "auto")


@register("triangle_count_oriented", sql(_TRI_JOIN.format(v="eps"), "eps"))
def q_triangle_count_oriented(spark, d):
    return paths.triangle_count(edges_ps(spark, d), "join", "oriented")


@register("triangle_count_repartition", sql(_TRI_JOIN.format(v="eps"), "eps"))
def q_triangle_count_repartition(spark, d):
    return paths.triangle_count(edges_ps(spark, d), "join", "shuffle")


@register("triangle_count_implicit_join", sql(_TRI_JOIN.format(v="eco"), "eco"))
def q_triangle_count_implicit_join(spark, d):
    return paths.triangle_count(edges_co(spark, d), "join", "implicit")


@register("triangle_count_broadcast", sql(_TRI_SEMI.format(v="eps"), "eps"))
def q_triangle_count_broadcast(spark, d):
    return paths.triangle_count(edges_ps(spark, d), "semi", "broadcast")


@register("triangle_count_semi", sql(_TRI_SEMI.format(v="eps"), "eps"))
def q_triangle_count_semi(spark, d):
    return paths.triangle_count(edges_ps(spark, d), "semi", "auto")


@register("triangle_count_semi_oriented", sql(_TRI_SEMI.format(v="eps"), "eps"))
def q_triangle_count_semi_oriented(spark, d):
    return paths.triangle_count(edges_ps(spark, d), "semi", "oriented")


@register("triangle_count_distinct_pairs", sql(_TRI_PAIRS.format(v="eps"), "eps"))
def q_triangle_count_distinct_pairs(spark, d):
    return paths.triangle_count(edges_ps(spark, d), "distinct_pairs", "auto")


@register("triangle_count_distinct_pairs_shuffle", sql(_TRI_PAIRS.format(v="eps"), "eps"))
def q_triangle_count_distinct_pairs_shuffle(spark, d):
    return paths.triangle_count(edges_ps(spark, d), "distinct_pairs", "shuffle")


@register("triangle_count_distinct_pairs_files", sql(_TRI_PAIRS.format(v="eps"), "eps"))
def q_triangle_count_distinct_pairs_files(spark, d):
    """Closed endpoint pairs from a CSV edge file."""
    path = scratch_path(spark, "edges_csv")
    files.write_edges_csv(edges_ps(spark, d), path)
    return paths.triangle_count(files.read_edges_csv(spark, path), "distinct_pairs", "auto")


@register("closed_pairs_intersect", sql(_CLOSED.format(v="eps"), "eps"))
def q_closed_pairs_intersect(spark, d):
    return paths.closed_pairs(edges_ps(spark, d))


@register("closed_pairs_oriented", sql(_CLOSED.format(v="eps"), "eps"))
def q_closed_pairs_oriented(spark, d):
    return paths.closed_pairs_oriented(edges_ps(spark, d))


# ================================================================ P4 adjacency / sampling

@register("adjacency_list", sql(
    "SELECT src AS id, 0::BIGINT AS chunk, string_agg(CAST(dst AS VARCHAR), ',' ORDER BY dst) AS adj FROM eco GROUP BY src",
    "eco"))
def q_adjacency_list(spark, d):
    return adj_ops.adjacency_text(adj_ops.adjacency_list(edges_co(spark, d)))


_SAMPLE = (f"SELECT id FROM (SELECT id FROM srcs ORDER BY md5('{SAMPLE_SEED}-' || CAST(id AS VARCHAR)), id "
           f"LIMIT {SAMPLE_K}) UNION SELECT id FROM srcs WHERE id = {SOURCE}")


@register("sample_vertices_topk", sql(_SAMPLE, "eps", ("srcs", "SELECT DISTINCT src AS id FROM eps")))
def q_sample_vertices_topk(spark, d):
    e = edges_ps(spark, d)
    return sampling.sample_vertices(e.select(F.col("src").alias("id")), SAMPLE_K, SAMPLE_SEED, SOURCE)


@register("sample_vertices_edges", sql(f"SELECT src, dst FROM eps WHERE src IN ({_SAMPLE})",
                                       "eps", ("srcs", "SELECT DISTINCT src AS id FROM eps")))
def q_sample_vertices_edges(spark, d):
    e = edges_ps(spark, d)
    s = sampling.sample_vertices(e.select(F.col("src").alias("id")), SAMPLE_K, SAMPLE_SEED, SOURCE)
    return sampling.sample_edges(e, s)


_DRAWS = (f"SELECT ('0x' || substr(md5('{SAMPLE_SEED}-' || i), 1, 15))::BIGINT % (SELECT count(*) FROM srcs) AS place "
          f"FROM range({SAMPLE_K}) t(i)")


@register("sample_vertices_replacement", sql(
    f"SELECT id, (coalesce(n, 0) + (id = {SOURCE})::INT)::BIGINT AS draws FROM "
    f"(SELECT id, row_number() OVER (ORDER BY id) - 1 AS place FROM srcs) LEFT JOIN "
    f"(SELECT place, count(*) AS n FROM ({_DRAWS}) GROUP BY place) USING (place) WHERE n IS NOT NULL OR id = {SOURCE}",
    "eps", ("srcs", "SELECT DISTINCT src AS id FROM eps")))
def q_sample_vertices_replacement(spark, d):
    e = edges_ps(spark, d)
    return sampling.draw_vertices(e.select(F.col("src").alias("id")), SAMPLE_K, SAMPLE_SEED, SOURCE)


# ================================================================ P5 shortest paths

def _bfs_sql(view: str, rounds: int, body: str) -> str:
    return sql(body, view, *o.bfs_ctes(view, SOURCE, rounds), recursive=True)


@register("sssp_init_distances", sql(
    f"SELECT id, (CASE WHEN id = {SOURCE} THEN 0 ELSE 2147483647 END)::BIGINT AS dist FROM "
    "(SELECT src AS id FROM eco UNION SELECT dst AS id FROM eco)", "eco"))
def q_sssp_init_distances(spark, d):
    return sssp.initial_distances(vertices_of(edges_co(spark, d)), SOURCE)


@register("sssp_edges", _bfs_sql("eco", ROUNDS, o.SSSP_OUT))
def q_sssp_edges(spark, d):
    return sssp.sssp(edges_co(spark, d), SOURCE, ROUNDS)


@register("sssp_bounded_5", _bfs_sql("eco", 5, o.SSSP_OUT))
def q_sssp_bounded_5(spark, d):
    return sssp.sssp(edges_co(spark, d), SOURCE, 5)


@register("sssp_from_adjacency", _bfs_sql("eco", ROUNDS, o.SSSP_OUT))
def q_sssp_from_adjacency(spark, d):
    path = scratch_path(spark, "adjacency")
    files.write_adjacency_text(adj_ops.adjacency_list(edges_co(spark, d)), path)
    e = adj_ops.edges_from_adjacency(files.read_adjacency_text(spark, path))
    return sssp.sssp(e, SOURCE, ROUNDS)


BREAK = 3             # rounds before a written state, in the queries that go on from one


def _stored(spark, e, weighted: bool):
    """The search state after ``BREAK`` rounds, written as text and read again."""
    path = scratch_path(spark, "search_state")
    dist = sssp.sssp(e, SOURCE, BREAK, weight="w" if weighted else None)
    files.write_search_state(sssp.search_state(e, dist, BREAK, weighted), path)
    return files.read_search_state(spark, path)


@register("sssp_resumed", _bfs_sql("eco", ROUNDS, o.SSSP_OUT))
def q_sssp_resumed(spark, d):
    """The search broken off after a few rounds and carried on from its written state."""
    e = edges_co(spark, d)
    return sssp.sssp(e, SOURCE, ROUNDS, state=_stored(spark, e, False), first_round=BREAK + 1)


@register("sssp_weighted_resumed", sql(o.SSSP_OUT, "eco", *o.weighted_ctes("eco", SOURCE, ROUNDS, "1 + src % 3"),
                                       recursive=True))
def q_sssp_weighted_resumed(spark, d):
    e = edges_co(spark, d).withColumn("w", 1 + F.col("src") % 3)
    return sssp.sssp(e, SOURCE, ROUNDS, weight="w", state=_stored(spark, e, True), first_round=BREAK + 1)


@register("sssp_weighted", sql(o.SSSP_OUT, "eco", *o.weighted_ctes("eco", SOURCE, ROUNDS, "1 + src % 3"),
                               recursive=True))
def q_sssp_weighted(spark, d):
    e = edges_co(spark, d).withColumn("w", 1 + F.col("src") % 3)
    return sssp.sssp(e, SOURCE, ROUNDS, weight="w")


@register("sssp_unreachable", _bfs_sql("eps", ROUNDS, o.SSSP_OUT))
def q_sssp_unreachable(spark, d):
    return sssp.sssp(edges_ps(spark, d), SOURCE, ROUNDS)


@register("filter_finite_distance", _bfs_sql("eps", ROUNDS, f"SELECT * FROM ({o.SSSP_OUT}) "
                                             "WHERE dist <> 2147483647"))
def q_filter_finite_distance(spark, d):
    return sssp.finite(sssp.sssp(edges_ps(spark, d), SOURCE, ROUNDS))


@register("sssp_updates_per_round", _bfs_sql(
    "eco", ROUNDS, "SELECT d AS round, count(*) AS n_updated FROM m "
                   "WHERE d > 0 AND v IN (SELECT id FROM vv) GROUP BY d"))
def q_sssp_updates_per_round(spark, d):
    _, trace = sssp.bfs(edges_co(spark, d), SOURCE, ROUNDS)
    return trace


@register("longest_distance", _bfs_sql(
    "eps", ROUNDS, f"SELECT coalesce(max(dist), 0)::BIGINT AS longest FROM ({o.SSSP_OUT}) "
                   "WHERE dist <> 2147483647"))
def q_longest_distance(spark, d):
    return sssp.longest_distance(sssp.sssp(edges_ps(spark, d), SOURCE, ROUNDS))


@register("farthest_vertex", _bfs_sql(
    "eco", ROUNDS, f"SELECT dist, min(id) AS id FROM ({o.SSSP_OUT}) x WHERE dist = "
                   f"(SELECT max(dist) FROM ({o.SSSP_OUT}) y WHERE dist <> 2147483647) GROUP BY dist"))
def q_farthest_vertex(spark, d):
    return sssp.farthest_vertex(sssp.sssp(edges_co(spark, d), SOURCE, ROUNDS))


@register("top1_by_distance", _bfs_sql(
    "eco", ROUNDS, f"SELECT id, dist FROM ({o.SSSP_OUT}) WHERE dist <> 2147483647 "
                   "ORDER BY dist DESC, id LIMIT 1"))
def q_top1_by_distance(spark, d):
    return sssp.top1_by_distance(sssp.sssp(edges_co(spark, d), SOURCE, ROUNDS))


# ================================================================ P6 PageRank

_VERTS = "SELECT src AS id FROM {v} UNION SELECT dst AS id FROM {v}"


@register("keep_unmatched_vertices", sql(
    "SELECT v.id, round(coalesce(x.c, 0.0::DOUBLE), 9) AS contrib FROM vs v LEFT JOIN "
    "(SELECT e.dst AS id, sum(1.0::DOUBLE / od.od) AS c FROM eps e JOIN "
    "(SELECT src, count(*) AS od FROM eps GROUP BY src) od ON e.src = od.src GROUP BY e.dst) x "
    "ON v.id = x.id", "eps", ("vs", _VERTS.format(v="eps"))))
def q_keep_unmatched_vertices(spark, d):
    c = pagerank.in_contributions(edges_ps(spark, d))
    return c.select("id", F.round("contrib", 9).alias("contrib"))


def _pr_sql(view: str, vertex_sql: str, body: str) -> str:
    return sql(body, view, *o.pagerank_ctes(view, vertex_sql, ROUNDS))


def _chain_pagerank(spark, d):
    c = chain_over_keys(spark, d, CHAIN_K)
    return pagerank.pagerank(c, vertices=c.select(F.col("src").alias("id")), iters=ROUNDS)


def _trace_sql(metric: str, digits: int) -> str:
    rows = []
    for i in range(1, ROUNDS + 1):
        if metric == "total":
            v = f"(SELECT sum(pr) FROM r{i})"
        else:
            v = (f"(SELECT coalesce(sum(pr), 0.0::DOUBLE) FROM r{i - 1} "
                 f"WHERE id NOT IN (SELECT src FROM od))")
        rows.append(f"SELECT {i}::BIGINT AS round, round({v}, {digits}) AS {metric}")
    return " UNION ALL ".join(rows)


@register("pagerank_chain", _pr_sql("chain", "SELECT src AS id FROM chain",
                                    f"SELECT id, round(pr, {PR_DIGITS}) AS pr FROM r{ROUNDS}"))
def q_pagerank_chain(spark, d):
    ranks, _ = _chain_pagerank(spark, d)
    return ranks.select("id", F.round("pr", PR_DIGITS).alias("pr"))


@register("pagerank_dangling", _pr_sql("esp", _VERTS.format(v="esp"),
                                       f"SELECT id, round(pr, {PR_DIGITS}) AS pr FROM r{ROUNDS}"))
def q_pagerank_dangling(spark, d):
    ranks, _ = pagerank.pagerank(edges_sp(spark, d), iters=ROUNDS)
    return ranks.select("id", F.round("pr", PR_DIGITS).alias("pr"))


@register("pagerank_mass", _pr_sql("esp", _VERTS.format(v="esp"), _trace_sql("total", 9)))
def q_pagerank_mass(spark, d):
    _, trace = pagerank.pagerank(edges_sp(spark, d), iters=ROUNDS)
    return trace.where("metric = 'total'").select("round", F.round("value", 9).alias("total"))


@register("pagerank_dangling_mass", _pr_sql("chain", "SELECT src AS id FROM chain",
                                            _trace_sql("delta", PR_DIGITS)))
def q_pagerank_dangling_mass(spark, d):
    _, trace = _chain_pagerank(spark, d)
    return trace.where("metric = 'delta'").select("round", F.round("value", PR_DIGITS).alias("delta"))


# ================================================================ P7 k-means

_PTS = "SELECT id AS pid, v FROM pts"
_INDEG_PTS = ("SELECT v.id AS pid, coalesce(c.n, 0) AS v FROM "
              "(SELECT src AS id FROM eps UNION SELECT dst AS id FROM eps) v LEFT JOIN "
              "(SELECT dst AS id, count(*) AS n FROM eps GROUP BY dst) c ON v.id = c.id")
_BAD = " UNION ALL ".join(f"SELECT {c}::BIGINT AS centroid" for c in BAD_SEEDS)


def _km_sql(view: str, points_sql: str, seeds: str, body: str) -> str:
    return sql(body, view, *o.kmeans_ctes(points_sql, seeds, ROUNDS))


def _km_trace_sql() -> str:
    return " UNION ALL ".join(f"SELECT {i}::BIGINT AS round, (SELECT sum(sse) FROM g{i})::BIGINT AS sse"
                              for i in range(1, ROUNDS + 1))


@register("equal_interval_seeds", sql(o.seeds_sql("pts", K_SEEDS), "pts"))
def q_equal_interval_seeds(spark, d):
    return kmeans.equal_interval_seeds(points_chars(spark, d), K_SEEDS)


@register("nearest_centroid", sql(
    "SELECT p.v, arg_min(c.centroid, (abs(c.centroid - p.v), c.centroid)) AS centroid "
    f"FROM pts p, ({o.seeds_sql('pts', K_SEEDS)}) c GROUP BY p.id, p.v", "pts"))
def q_nearest_centroid(spark, d):
    pts = points_chars(spark, d)
    return kmeans.assign(pts, kmeans.equal_interval_seeds(pts, K_SEEDS))


# centroids by the order table, far too many for a list in a plan; points are item prices
_MANY = ("SELECT DISTINCT floor(o_totalprice)::BIGINT AS c FROM orders WHERE o_totalprice IS NOT NULL")
_PRICES = "SELECT row_number() OVER () AS i, floor(l_extendedprice)::BIGINT AS v FROM lineitem WHERE l_extendedprice IS NOT NULL"


@register("nearest_centroid_many", sql(
    "SELECT v, CASE WHEN up IS NULL OR v - down <= up - v THEN down ELSE up END AS centroid FROM "
    "(SELECT x.i, x.v, x.down, c.c AS up FROM (SELECT pr.i, pr.v, c.c AS down FROM pr ASOF LEFT JOIN cs c ON pr.v >= c.c) x "
    "ASOF LEFT JOIN cs c ON x.v <= c.c)", ("cs", _MANY), ("pr", _PRICES)))
def q_nearest_centroid_many(spark, d):
    c = load_table(spark, d, "orders").select(F.floor("o_totalprice").cast("bigint").alias("centroid"))
    pts = load_table(spark, d, "lineitem").where(F.col("l_extendedprice").isNotNull()) \
        .select(F.floor("l_extendedprice").cast("bigint").alias("v"))
    return kmeans.assign_many(pts, c)


@register("cluster_update", _km_sql("pts", _PTS, o.seeds_sql("pts", K_SEEDS),
                                     "SELECT old_centroid, centroid, n, sse FROM g1"))
def q_cluster_update(spark, d):
    pts = points_chars(spark, d)
    return kmeans.cluster_update(pts, kmeans.equal_interval_seeds(pts, K_SEEDS))


@register("kmeans_1d", _km_sql("pts", _PTS, o.seeds_sql("pts", K_SEEDS),
                               f"SELECT centroid, n, sse FROM g{ROUNDS}"))
def q_kmeans_1d(spark, d):
    pts = points_chars(spark, d)
    clusters, _ = kmeans.kmeans_1d(pts, kmeans.equal_interval_seeds(pts, K_SEEDS), ROUNDS,
                                   materialize=False)
    return clusters


@register("kmeans_1d_bad_seeds", _km_sql("pts", _PTS, _BAD, f"SELECT centroid, n, sse FROM g{ROUNDS}"))
def q_kmeans_1d_bad_seeds(spark, d):
    clusters, _ = kmeans.kmeans_1d(points_chars(spark, d), BAD_SEEDS, ROUNDS, materialize=False)
    return clusters


@register("kmeans_sse", _km_sql("pts", _PTS, o.seeds_sql("pts", K_SEEDS), _km_trace_sql()))
def q_kmeans_sse(spark, d):
    pts = points_chars(spark, d)
    _, trace = kmeans.kmeans_1d(pts, kmeans.equal_interval_seeds(pts, K_SEEDS), ROUNDS,
                                materialize=False)
    return trace


@register("kmeans_of_indegree", sql(
    f"SELECT centroid, n, sse FROM g{ROUNDS}", "eps",
    ("ipts", _INDEG_PTS.replace("v.id AS pid", "v.id AS id")),
    *o.kmeans_ctes("SELECT id AS pid, v FROM ipts", o.seeds_sql("ipts", K_SEEDS), ROUNDS)))
def q_kmeans_of_indegree(spark, d):
    follow = degrees.in_degree_fold_zero(edges_ps(spark, d)).select("id", F.col("followers").alias("v"))
    clusters, _ = kmeans.kmeans_1d(follow, kmeans.equal_interval_seeds(follow, K_SEEDS), ROUNDS)
    return clusters


@register("kmeans_centroid_file", _km_sql("pts", _PTS, o.seeds_sql("pts", K_SEEDS),
                                          f"SELECT centroid, n, sse FROM g{ROUNDS}"))
def q_kmeans_centroid_file(spark, d):
    """Start centroids from the text file that the seeding job writes."""
    pts = points_chars(spark, d)
    path = scratch_path(spark, "centroids")
    files.write_pairs_tsv(kmeans.equal_interval_seeds(pts, K_SEEDS), path)
    clusters, _ = kmeans.kmeans_1d(pts, files.read_centroids(spark, path), ROUNDS, materialize=False)
    return clusters


@register("kmeans_resumed", _km_sql("pts", _PTS, o.seeds_sql("pts", K_SEEDS),
                                    f"SELECT centroid, n, sse FROM g{ROUNDS}"))
def q_kmeans_resumed(spark, d):
    """k-means broken off after a few rounds and carried on from that round's output folder."""
    pts = points_chars(spark, d)
    early, _ = kmeans.kmeans_1d(pts, kmeans.equal_interval_seeds(pts, K_SEEDS), BREAK, materialize=False)
    path = scratch_path(spark, "centroids")
    files.write_pairs_tsv(early, path)
    clusters, _ = kmeans.kmeans_1d(pts, files.read_centroids(spark, path), ROUNDS, materialize=False, first_round=BREAK + 1)
    return clusters


@register("longest_distance_file", _bfs_sql(
    "eps", ROUNDS, f"SELECT coalesce(max(dist), 0)::BIGINT AS longest FROM ({o.SSSP_OUT}) "
                   "WHERE dist <> 2147483647"))
def q_longest_distance_file(spark, d):
    """The longest distance over stored search-state lines."""
    e = edges_ps(spark, d)
    state = sssp.sssp(e, SOURCE, ROUNDS).withColumn("nbrs", F.array().cast("array<bigint>"))
    path = scratch_path(spark, "search_state")
    files.write_search_state(state, path)
    return sssp.longest_distance(files.read_search_state(spark, path))
