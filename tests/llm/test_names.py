"""Columns of the caller that are called like an operator's own, and odd characters in keys."""

from pyspark.sql import functions as F

import corpus_pipeline
from edgeframe.llm import hilbert, queries
from tests.llm.conftest import folder

#: columns that the operators make for themselves
NAMES = ("_key _node _bad_tag _id _row _at _part _before _n _tie key node row tag size shard slot curve at part n all rank text_crc32 "
         "d0 d1 x0 x1 th words piece batch bucket class hub salt score weight kept reason spans items").split()


def with_names(df):
    return df.withColumns({n: F.lit(k) for k, n in enumerate(NAMES) if n not in df.columns})


def test_every_stage_keeps_all_columns(spark, sf):
    docs = with_names(spark.read.parquet(f"{sf}/documents.parquet").limit(60))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns, name
        for r in out.collect():
            assert [r[n] for n in NAMES] == list(range(len(NAMES))), name


def test_every_query_runs(spark, sf, tmp_path):
    small = {t: spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "pages", "benchmark", "labels")}
    small["documents"] = small["documents"].limit(40)
    at = folder(spark, tmp_path, **{t: with_names(df) for t, df in small.items()})
    for name in ("op1_decontaminate", "op3_url_templates", "op4_hilbert", "op11_secrets", "op12_importance", "op13_collocations"):
        assert queries.QUERIES[name](spark, at).count() >= 0, name


def test_shards_written_with_clashing_names(spark, sf, tmp_path):
    docs = with_names(spark.read.parquet(f"{sf}/documents.parquet"))
    ranges = hilbert.write_shards(docs, str(tmp_path / "s"), shards=4, dims=("lang", "n_chars")).collect()
    assert sorted(r.shard for r in ranges) == [0, 1, 2, 3]
    back = spark.read.parquet(str(tmp_path / "s"))
    assert set(back.columns) == {*docs.columns, "_shard"} and back.count() == docs.count()
