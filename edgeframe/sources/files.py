"""Text formats of the reference: CSV edges, TAB pairs, adjacency lines, tokens.

Readers take an explicit schema (schema inference costs a full extra scan and
is offered only as the separate ``read_edges_csv_inferred``).  Writers always
``overwrite``; they never route rows through the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgeframe.functions.scalar import joined

EDGE_SCHEMA = "src BIGINT, dst BIGINT"


def write_edges_csv(edges: DataFrame, path: str) -> None:
    """``src,dst`` lines, no header (the reference's edge files)."""
    edges.select("src", "dst").write.mode("overwrite").csv(path)


def read_edges_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EDGE_SCHEMA).csv(path)


def read_edges_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """CSV with ``inferSchema`` (columns ``_c0,_c1``), renamed and widened."""
    raw = spark.read.option("inferSchema", "true").csv(path)
    return raw.toDF("src", "dst").select(F.col("src").cast("bigint").alias("src"),
                                         F.col("dst").cast("bigint").alias("dst"))


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Each line as one string column ``value``."""
    return spark.read.text(path)


def write_pairs_tsv(df: DataFrame, path: str) -> None:
    """Key TAB value lines (``textoutputformat.separator`` = TAB)."""
    df.write.mode("overwrite").option("sep", "\t").csv(path)


def read_pairs_tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("sep", "\t").csv(path)


def write_adjacency_text(adj: DataFrame, path: str) -> None:
    """``id TAB n1,n2,...`` lines from an ``(id, nbrs array<bigint>)`` frame, one per row: a hub whose
    list is in chunks has a line for each, and reading them back gives the same edges."""
    line = F.concat_ws("\t", F.col("id").cast("string"), joined(F.col("nbrs")))
    adj.select(line.alias("value")).write.mode("overwrite").text(path)


def read_adjacency_text(spark: SparkSession, path: str) -> DataFrame:
    """Parse ``id TAB n1,n2`` into ``(id bigint, nbrs array<bigint>)``.

    An empty or ``null`` neighbour field gives an empty array.
    """
    parts = F.split(F.col("value"), "\t")
    field = F.coalesce(F.get(parts, 1), F.lit(""))
    has = (field != "") & (field != "null")
    nbrs = F.when(has, F.transform(F.split(field, ","), lambda x: x.cast("bigint"))) \
        .otherwise(F.array().cast("array<bigint>"))
    return spark.read.text(path).select(F.get(parts, 0).cast("bigint").alias("id"),
                                        nbrs.alias("nbrs"))


def write_key_value_text(df: DataFrame, key: str, value: str, path: str) -> None:
    """``key TAB value`` lines, e.g. ``id TAB followers`` (the k-means input)."""
    line = F.concat_ws("\t", F.col(key).cast("string"), F.col(value).cast("string"))
    df.select(line.alias("value")).write.mode("overwrite").text(path)


def read_whitespace_tokens(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """Split each line on ``\\s+`` and keep the first ``len(names)`` tokens as bigint."""
    toks = F.split(F.trim(F.col("value")), r"\s+")
    return spark.read.text(path).select(
        *[F.get(toks, i).cast("bigint").alias(n) for i, n in enumerate(names)])


def read_centroids(spark: SparkSession, path: str) -> DataFrame:
    """``(centroid)``: the first token of each line, as the seeding job writes them."""
    return read_whitespace_tokens(spark, path, ["centroid"]).where(F.col("centroid").isNotNull())


def read_vertices(spark: SparkSession, path: str) -> DataFrame:
    """``(id)``: the first token of each line, once each."""
    return read_whitespace_tokens(spark, path, ["id"]).where(F.col("id").isNotNull()).distinct()


def write_search_state(state: DataFrame, path: str) -> None:
    """``id TAB n1,n2 dist [V]`` lines from ``(id, nbrs, dist[, visited])``.

    An empty neighbour list is written as ``null``; ``V`` marks a visited
    vertex when a boolean ``visited`` column is present.
    """
    adj = F.when(F.size("nbrs") > 0, joined(F.col("nbrs"))) \
        .otherwise(F.lit("null"))
    tail = [F.col("dist").cast("string")]
    if "visited" in state.columns:
        tail.append(F.when(F.col("visited"), F.lit("V")))
    line = F.concat(F.col("id").cast("string"), F.lit("\t"), F.concat_ws(" ", adj, *tail))
    state.select(line.alias("value")).write.mode("overwrite").text(path)


def read_search_state(spark: SparkSession, path: str) -> DataFrame:
    """Parse search-state lines into ``(id, nbrs array<bigint>, dist, visited)``."""
    toks = F.split(F.trim(F.col("value")), r"\s+")
    adj = F.get(toks, 1)
    nbrs = F.when(adj == "null", F.array().cast("array<bigint>")) \
        .otherwise(F.transform(F.split(adj, ","), lambda x: x.cast("bigint")))
    return spark.read.text(path).select(
        F.get(toks, 0).cast("bigint").alias("id"), nbrs.alias("nbrs"),
        F.get(toks, 2).cast("bigint").alias("dist"),
        F.coalesce(F.get(toks, 3) == "V", F.lit(False)).alias("visited"))


def parsed_pairs(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """``(src, dst, value)`` of every line ``src<sep>dst``; both ids are null where the line is not
    two whole numbers (blanks around them are allowed, further fields are not)."""
    fields = F.split(F.col("value"), f"[{sep}]")
    ids = [F.expr(f"try_cast(trim(fields[{i}]) AS BIGINT)") for i in (0, 1)]
    good = (F.size("fields") == 2) & ids[0].isNotNull() & ids[1].isNotNull()
    return spark.read.text(path).withColumn("fields", F.when(F.size(fields) == 2, fields)) \
        .select(*[F.when(good, c).alias(n) for c, n in zip(ids, ("src", "dst"))], "value")


def read_inputs(spark: SparkSession, inputs: dict[str, tuple[str, str]]) -> tuple[DataFrame, DataFrame]:
    """One job over several inputs, each with a parser of its own.

    ``inputs`` names each side's path and field separator.  Returns ``(rows, rejects)``: ``(side, src,
    dst)`` of the lines that parse and ``(side, value)`` of those that do not; an empty line is neither.
    """
    both = [parsed_pairs(spark, path, sep).select(F.lit(side).alias("side"), "src", "dst", "value")
            for side, (path, sep) in inputs.items()]
    lines = reduce(DataFrame.unionByName, both).where(F.trim("value") != "")
    return (lines.where(F.col("src").isNotNull()).select("side", "src", "dst"),
            lines.where(F.col("src").isNull()).select("side", "value"))
