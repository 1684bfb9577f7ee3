"""Command-line jobs over the reference's file formats.

    python -m edgeframe <job> --input PATH --output DIR [options]

Graph jobs read ``src,dst`` CSV edge files; ``seeds`` and ``kmeans`` read
``id <whitespace> value`` lines (the follower-count output).  Results are
written as TAB-separated text into ``--output`` (overwritten).  The session
comes from ``spark-submit`` (or a local one with ``--master``).

Jobs: maxfilter, indegree, path2, triangles, cardinality, adjacency, sample,
sssp, longest, pagerank, seeds, kmeans.  ``longest`` reads search-state lines.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgeframe.operators import adjacency, degrees, kmeans, pagerank, paths, relational, sampling, sssp
from edgeframe.sources import files
from edgeframe.sources.tables import vertices_of


def _edges(spark: SparkSession, args) -> DataFrame:
    e = files.read_edges_csv(spark, args.input)
    e = e.where(F.col("src").isNotNull() & F.col("dst").isNotNull())
    return relational.filter_max_id(e, args.max) if args.max is not None else e


def _points(spark: SparkSession, args) -> DataFrame:
    return files.read_whitespace_tokens(spark, args.input, ["id", "v"])


def _write(df: DataFrame, args) -> None:
    files.write_pairs_tsv(df, args.output)


def run(spark: SparkSession, args) -> None:
    job = args.job
    if job == "maxfilter":
        files.write_edges_csv(_edges(spark, args), args.output)
    elif job == "indegree":
        e = _edges(spark, args)
        fn = {"count": degrees.in_degree, "reduce": degrees.in_degree_reduce,
              "fold": degrees.in_degree_fold_zero, "group": degrees.in_degree_group_collect}
        _write(fn[args.variant](e), args)
    elif job == "path2":
        _write(paths.path2(_edges(spark, args), args.strategy), args)   # --max has filtered the edges
    elif job == "triangles":
        _write(paths.triangle_count(_edges(spark, args), args.semantics, args.strategy), args)
    elif job == "cardinality":
        e = _edges(spark, args)
        _write(degrees.path2_cardinality(e), args)
        files.write_pairs_tsv(degrees.path2_cardinality_total(e).unionByName(
            degrees.path2_exact_total(e)), args.output + "_total")
    elif job == "adjacency":
        files.write_adjacency_text(adjacency.adjacency_list(_edges(spark, args)), args.output)
    elif job == "sample":
        e = _edges(spark, args)
        s = sampling.sample_vertices(e.select(F.col("src").alias("id")), args.k, args.seed, args.source)
        _write(sampling.sample_edges(e, s), args)
    elif job == "sssp":
        e = adjacency.edges_from_adjacency(files.read_adjacency_text(spark, args.input)) \
            if args.format == "adjacency" else _edges(spark, args)
        if args.weight_mod:
            e = e.withColumn("w", 1 + F.col("src") % args.weight_mod)
        d = sssp.sssp(e, args.source, args.rounds, weight="w" if args.weight_mod else None)
        _write(d, args)
        files.write_pairs_tsv(sssp.farthest_vertex(d), args.output + "_longest")
    elif job == "pagerank":
        e, verts = _edges(spark, args), None
        if args.vertices:
            verts = files.read_vertices(spark, args.vertices)
        elif args.dummy is not None:
            verts = vertices_of(e).where(F.col("id") != args.dummy)
        ranks, trace = pagerank.pagerank(e, verts, iters=args.iters, damping=args.damping)
        _write(ranks, args)
        files.write_pairs_tsv(trace, args.output + "_trace")
    elif job == "longest":
        _write(sssp.longest_distance(files.read_search_state(spark, args.input)), args)
    elif job == "seeds":
        _write(kmeans.equal_interval_seeds(_points(spark, args), args.k), args)
    elif job == "kmeans":
        pts = _points(spark, args)
        if args.centroids:
            seeds = files.read_centroids(spark, args.centroids)
        elif args.seeds:
            seeds = [int(x) for x in args.seeds.split(",")]
        else:
            seeds = kmeans.equal_interval_seeds(pts, args.k)
        clusters, trace = kmeans.kmeans_1d(pts, seeds, args.iters)
        _write(clusters, args)
        files.write_pairs_tsv(trace, args.output + "_sse")
    else:
        raise SystemExit(f"unknown job {job!r}")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="edgeframe", description=__doc__.split("\n\n")[0])
    p.add_argument("job")
    p.add_argument("--input", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--master", default=None, help="only for runs outside spark-submit")
    p.add_argument("--max", type=int, default=None, help="keep edges with both ids <= MAX")
    p.add_argument("--variant", default="count", choices=["count", "reduce", "fold", "group"])
    p.add_argument("--strategy", default=None)
    p.add_argument("--semantics", default="join", choices=list(paths.SEMANTICS))
    p.add_argument("--k", type=int, default=4)
    p.add_argument("--seed", type=int, default=42)
    p.add_argument("--seeds", default=None, help="comma-separated initial centroids")
    p.add_argument("--centroids", default=None, help="file of initial centroids, as `seeds` writes it")
    p.add_argument("--format", default="csv", choices=["csv", "adjacency"], help="edge file of sssp")
    p.add_argument("--vertices", default=None, help="vertex file of pagerank, one id a line")
    p.add_argument("--dummy", type=int, default=None, help="edge target that is no vertex of pagerank")
    p.add_argument("--source", type=int, default=1)
    p.add_argument("--rounds", type=int, default=10)
    p.add_argument("--weight-mod", type=int, default=0, help="weight = 1 + src %% N (0: unweighted)")
    p.add_argument("--iters", type=int, default=10)
    p.add_argument("--damping", type=float, default=1.0)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    if args.strategy is None:
        args.strategy = "merge" if args.job == "path2" else "auto"
    if spark is None:
        builder = SparkSession.builder.appName(f"edgeframe-{args.job}")
        if args.master:
            builder = builder.master(args.master)
        spark = builder.getOrCreate()
    run(spark, args)


if __name__ == "__main__":
    main(sys.argv[1:])
