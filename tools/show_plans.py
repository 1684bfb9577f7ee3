"""Print the physical operator tree of key plans (``explain('formatted')`` heads).

Usage: python tools/show_plans.py [sf_dir]   (broadcast auto-threshold disabled,
so the trees show the shapes a large cluster would run).
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from edgeframe.operators import degrees, paths, relational  # noqa: E402
from edgeframe.operators.common import BucketedTable, HubSplitEdges  # noqa: E402
from edgeframe.operators.pagerank import pagerank_round  # noqa: E402
from edgeframe.plans.inspect import plan_text  # noqa: E402
from edgeframe.session import local_session  # noqa: E402
from edgeframe.sources.tables import edges_ps  # noqa: E402


def tree(df) -> str:
    text = plan_text(df)
    head = text.split("\n\n")[0]
    return "\n".join(l for l in head.splitlines() if l.strip())


def main(sf_dir: str) -> None:
    spark = local_session(8, 8, extra={"spark.sql.autoBroadcastJoinThreshold": "-1"})
    e = edges_ps(spark, sf_dir)
    shown = {
        "filter_max_id": relational.filter_max_id(e, 100),
        "in_degree": degrees.in_degree(e),
        "degree_pairs": degrees.degree_pairs(e),
        "path2_count": paths.path2_count(e),
    }
    adj = HubSplitEdges(e.groupBy("src", "dst").agg(F.lit(0.5).alias("share")), "plan_adj")
    vt = BucketedTable(e.select(F.col("src").alias("id")).distinct()
                       .select("id", F.lit(False).alias("dangling")), "id", "plan_vt", adj.n).read()
    shown["pagerank_round"] = pagerank_round(vt.select("id", "dangling", F.lit(0.1).alias("pr")),
                                             adj, vt, 10, 1.0, 0.0)
    bfs_adj = HubSplitEdges(e.select("src", "dst").distinct(), "plan_bfs_adj")
    visited = BucketedTable(vt.select("id", F.lit(0).cast("bigint").alias("dist")), "id", "plan_visited", bfs_adj.n)
    seen = visited.read()
    frontier = seen.where(F.col("dist") == 0)
    reached = bfs_adj.join(frontier.select("id")).select(F.col("dst").alias("id"))
    shown["bfs_round"] = reached.distinct().join(seen.select("id"), "id", "left_anti")
    loops, pairs, oriented, n = paths._oriented_inputs(paths.multiplicity(e))
    shown["triangle_wedges_large (shuffle joins)"] = paths._triangles(oriented, n, max_broadcast_rows=0) \
        .agg(F.count(F.lit(1)))
    shown["triangle_wedges_small (proven-small broadcast)"] = paths._triangles(oriented, n) \
        .agg(F.count(F.lit(1)))
    for name, df in shown.items():
        print(f"### {name}\n```\n{tree(df)}\n```\n")


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
