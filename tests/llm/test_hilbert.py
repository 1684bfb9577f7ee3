"""The curve's continuity, the law of equal row counts, and pruning."""

import zlib

from pyspark.sql import functions as F

from edgeframe.llm import hilbert
from edgeframe.plans.inspect import plan_text


def test_curve_visits_neighbours(spark):
    for n, bits in ((2, 3), (3, 2), (4, 2)):
        side = 1 << bits
        grid = spark.range(side ** n).select(*[(F.expr(f"cast(id div {side ** i} % {side} as int)")).alias(f"x{i}") for i in range(n)])
        kept = grid.withColumns({f"c{i}": F.col(f"x{i}") for i in range(n)})
        order = sorted(hilbert.curve_index(kept, n, bits).collect(), key=lambda r: r.curve)
        assert [r.curve for r in order] == list(range(side ** n))
        for a, b in zip(order, order[1:]):
            assert sum(abs(a[f"c{i}"] - b[f"c{i}"]) for i in range(n)) == 1


def check(rows, got, shards):
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
        text = (rows[r.doc_id][1] or "").encode() if r.doc_id in rows else None
        if text is not None:
            assert r.size == len(text) + 16 and r.text_crc32 == zlib.crc32(text)
    counts = [len(by.get(s, [])) for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and set(by) <= set(range(shards))
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def test_rows_law(spark):
    rows = {k: (k, "x" * (k % 7) if k % 5 else None, ["en", "de", None][k % 3], f"s{k % 4}", k % 50) for k in range(333)}
    docs = spark.createDataFrame([(*r, 1, "c") for r in rows.values()],
                                 "doc_id long, text string, lang string, source string, n_chars long, shard int, curve string")
    got = hilbert.placed(docs).collect()
    check(rows, got, 40)
    assert {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}
    few = docs.limit(5)
    assert len(hilbert.placed(few).collect()) == 5 and hilbert.placed(docs.limit(0)).count() == 0


def test_one_cell_of_equal_rows(spark):
    docs = spark.createDataFrame([(7, "same", "en", "s", 4)] * 200 + [(None, None, None, None, None)] * 30,
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = hilbert.placed(docs, shards=7).collect()
    counts = {s: sum(r.shard == s for r in got) for s in range(7)}
    assert len(got) == 230 and max(counts.values()) - min(counts.values()) <= 1


def test_written_shards_prune(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    ranges = hilbert.write_shards(docs, str(tmp_path / "s"), shards=16, dims=("lang", "n_chars")).collect()
    assert sum(r["rows"] for r in ranges) == docs.count()
    mean = sum(r.max_n_chars - r.min_n_chars for r in ranges) / len(ranges)
    whole = docs.agg(F.max("n_chars") - F.min("n_chars")).collect()[0][0]
    assert mean < 0.6 * whole and sum(r.min_lang == r.max_lang for r in ranges) >= 8


def test_no_python_on_the_main_path(spark, sf):
    assert "Python" not in plan_text(hilbert.placed(spark.read.parquet(f"{sf}/documents.parquet")))


def test_strings_are_cut_by_their_whole_value(spark):
    rows = [(k, "t", f"https://one-long-prefix/{k % 160:04d}", 1) for k in range(1600)] + [(None, None, None, None)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    cut = docs.withColumns(hilbert.cells(docs, ("source",), 4)).where("source is not null")
    sizes = {r["x0"]: r["count"] for r in cut.groupBy("x0").count().collect()}
    assert set(sizes) == set(range(16)) and set(sizes.values()) == {100}
    assert hilbert.placed(docs, dims=("source", "size")).count() == len(rows)
    assert hilbert.placed(docs.limit(0), dims=("source",)).count() == 0
