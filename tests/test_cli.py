"""The command-line jobs on the reference's sample graph files."""

from edgeframe.cli import main

SAMPLE = ["1,2", "2,3", "3,4", "4,1", "1,5", "5,6", "6,7", "7,8", "8,9", "6,10", "10,5"]


def _lines(spark, path):
    return sorted(r["value"] for r in spark.read.text(path).collect())


def test_cli_jobs(spark, tmp_path):
    edges = tmp_path / "edges.csv"
    edges.write_text("\n".join(SAMPLE) + "\n")
    out = str(tmp_path / "out")
    main(["indegree", "--input", str(edges), "--output", out + "_deg"], spark)
    assert "5\t2" in _lines(spark, out + "_deg")
    main(["triangles", "--input", str(edges), "--output", out + "_tri"], spark)
    assert _lines(spark, out + "_tri") == ["3\t1"]
    main(["triangles", "--semantics", "distinct_pairs", "--strategy", "shuffle",
          "--input", str(edges), "--output", out + "_tri2"], spark)
    assert _lines(spark, out + "_tri2") == ["3\t1"]
    main(["sssp", "--input", str(edges), "--output", out + "_sssp"], spark)
    assert "9\t5" in _lines(spark, out + "_sssp")
    assert _lines(spark, out + "_sssp_longest") == ["5\t9"]
    main(["adjacency", "--input", str(edges), "--output", out + "_adj"], spark)
    assert "6\t7,10" in _lines(spark, out + "_adj")
    main(["cardinality", "--input", str(edges), "--output", out + "_card"], spark)
    assert _lines(spark, out + "_card_total") == ["12", "13"]
    main(["indegree", "--input", str(edges), "--output", out + "_follow"], spark)
    pts = str(tmp_path / "follow.txt")
    (tmp_path / "follow.txt").write_text("\n".join(f"{i}\t{v}" for i, v in
                                                   [(1, 5), (2, 9), (3, 100), (4, 104)]) + "\n")
    main(["kmeans", "--seeds", "0,50", "--iters", "3", "--input", pts, "--output", out + "_km"], spark)
    assert _lines(spark, out + "_km") == ["102\t2\t8", "7\t2\t8"]


def test_cli_files(spark, tmp_path):
    out = str(tmp_path / "out")
    put = lambda name, lines: (tmp_path / name).write_text("\n".join(lines) + "\n") and str(tmp_path / name)
    pts = put("pts", ["1\t5", "2\t9", "3\t100", "4\t104"])
    main(["seeds", "--k", "2", "--input", pts, "--output", out + "_seeds"], spark)
    main(["kmeans", "--centroids", out + "_seeds", "--iters", "3", "--input", pts, "--output", out + "_km"], spark)
    assert _lines(spark, out + "_km") == ["102\t2\t8", "7\t2\t8"]
    chain = put("chain", [f"{a},{b}" for a, b in [(1, 2), (2, 3), (3, 0), (4, 5), (5, 6), (6, 0), (7, 8), (8, 9), (9, 0)]])
    main(["pagerank", "--dummy", "0", "--iters", "2", "--input", chain, "--output", out + "_pr"], spark)
    assert len(_lines(spark, out + "_pr")) == 9
    verts = put("verts", [str(k) for k in range(1, 10)])
    main(["pagerank", "--vertices", verts, "--iters", "2", "--input", chain, "--output", out + "_pr2"], spark)
    assert _lines(spark, out + "_pr2") == _lines(spark, out + "_pr")
    adj = put("adj", ["1\t2,5", "2\t3", "5\t6", "9\tnull"])
    main(["sssp", "--format", "adjacency", "--input", adj, "--output", out + "_sssp"], spark)
    assert "6\t2" in _lines(spark, out + "_sssp")
    state = put("state", ["1\t2,5 0 V", "2\tnull 1", "5\t6 7", "9\tnull 2147483647"])
    main(["longest", "--input", state, "--output", out + "_long"], spark)
    assert _lines(spark, out + "_long") == ["7"]
    main(["path2", "--strategy", "auto", "--max", "5", "--input", chain, "--output", out + "_p2"], spark)
    assert _lines(spark, out + "_p2") == ["1\t3", "2\t0"]
