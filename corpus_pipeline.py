"""Corpus pipeline: quality rules, near-duplicate and substring removal, benchmark
decontamination, BPE encoding.  ``STAGES`` are applied in order, each to all that the one before
it kept; every stage's result but the last is written as Parquet and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame

from edgeframe.llm import bpe, decontaminate, fertility, near_dup, suffix_dedup
from edgeframe.llm.textcol import table, written


def quality_rules(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the fertility bands reject go."""
    return fertility.keep(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"),
                          public_tokenizers.path("piece_bpe_32k.model"))


def near_duplicates(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document of the least id stays."""
    return near_dup.keep_one(docs)


def suffix_array_dedup(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes in 100-byte strings that also start earlier go; every document stays."""
    return suffix_dedup.rewrite(docs)


def benchmark_decontamination(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def bpe_encoding(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per document: doc_id, n_tokens and digests of the ids and of the decoded text."""
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates),
          ("suffix_array_dedup", suffix_array_dedup),
          ("benchmark_decontamination", benchmark_decontamination), ("bpe_encoding", bpe_encoding)]

#: consistent weighted sampling and the fertility bands cannot be said in SQL: tests/llm compares
#: run() with a brute-force version
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
