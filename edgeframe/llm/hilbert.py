"""Hilbert-curve sharding with DataFrame operations only.

Metadata dimensions are cut into 2**bits cells at quantiles (approximate ones of numbers, exact
ones of whole strings), the cell becomes an index on the
Hilbert curve, and the rows, in curve order, are cut into runs whose lengths differ by at most
one.  A shard is then a compact box in every dimension, so files of a shard can be pruned by the
minima and maxima of any of them.

Order within a cell: checksum of the text, then the id, so equal texts of a cell are
neighbours and a cell that holds a third of all rows spreads over range partitions.  Ranks come
from each range partition's own numbering and the sizes of the partitions before it (one row per
partition); no row is collected and no window runs over the table.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from edgeframe.llm.textcol import written

SHARDS = 40
BITS = 4
DIMENSIONS = ("lang", "source", "n_chars", "doc_id")


def as_number(col: str) -> Column:
    """A number in the column's order; null is lowest."""
    return F.coalesce(F.col(col).cast("double"), F.lit(float("-inf")))


def string_cuts(df: DataFrame, col: str, shares: list[float]) -> list[str | None]:
    """For each share the least value up to which that share of the (non-null) rows lies, by whole
    strings: values are counted, range-partitioned, and summed from partition to partition."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    ranged = written(counted.repartitionByRange(parts, "v").withColumn("part", F.spark_partition_id()), "values")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    held = ranged.groupBy("part").agg(F.sum("n").alias("held"))     # one row per partition
    held = held.select("part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("before"),
                       F.sum("held").over(Window.partitionBy()).alias("all"))
    upto = F.col("before") + F.sum("n").over(Window.partitionBy("part").orderBy("v"))
    placed = ranged.join(F.broadcast(held), "part").select("v", "all", upto.alias("upto"))
    return list(placed.agg(*[F.min(F.when(F.col("upto") >= F.lit(x) * F.col("all"), F.col("v"))).alias(f"_{i}")
                             for i, x in enumerate(shares)]).first())


def cells(df: DataFrame, dims: tuple[str, ...], bits: int) -> dict[str, Column]:
    """The cell of each dimension, 0 .. 2**bits - 1, from quantiles over all rows."""
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    texts = [d for d in dims if isinstance(df.schema[d].dataType, StringType)]
    numbers = [d for d in dims if d not in texts]
    # a sketch per task is merged; 2**bits - 1 values per dimension come to the driver
    at = df.agg(F.count(F.lit(1)), *[F.percentile_approx(as_number(d), shares, 1000).alias(d) for d in numbers]).first()
    # an empty table has no quantiles; a constant would be copied into every step of the curve
    above = {d: [as_number(d) > F.lit(v) for v in at[d] or [float("inf")]] for d in numbers}
    above |= {d: [F.coalesce(F.col(d) > F.lit(v), F.lit(False)) for v in string_cuts(df, d, shares)] for d in texts}
    return {f"x{i}": reduce(add, [c.cast("int") for c in above[d]]) for i, d in enumerate(dims)}


def curve_index(df: DataFrame, n: int, bits: int) -> DataFrame:
    """Adds ``curve``: the Hilbert index of the cell (x0, .., x[n-1]).  Each step is a column of its
    own, so that no expression holds another one twice."""
    x = [f"x{i}" for i in range(n)]
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for i in range(n):
            up = F.col(x[i]).bitwiseAND(1 << b) != 0
            swap = F.col(x[0]).bitwiseXOR(F.col(x[i])).bitwiseAND(low)
            new = {x[0]: F.when(up, F.col(x[0]).bitwiseXOR(F.lit(low))).otherwise(F.col(x[0]).bitwiseXOR(swap))}
            if i:
                new[x[i]] = F.when(up, F.col(x[i])).otherwise(F.col(x[i]).bitwiseXOR(swap))
            df = df.withColumns(new)
    for i in range(1, n):
        df = df.withColumn(x[i], F.col(x[i]).bitwiseXOR(F.col(x[i - 1])))
    turn = F.lit(0)
    for b in range(bits - 1, 0, -1):
        turn = turn.bitwiseXOR(F.when(F.col(x[-1]).bitwiseAND(1 << b) != 0, (1 << b) - 1).otherwise(0))
    df = df.withColumn("_turn", turn)
    index = F.lit(0).cast("long")
    for b in range(bits - 1, -1, -1):
        for c in x:
            bit = F.shiftright(F.col(c).bitwiseXOR(F.col("_turn")), b).bitwiseAND(1)
            index = index + bit.cast("long") * (1 << (b * n + n - 1 - x.index(c)))
    return df.withColumn("curve", index).drop("_turn", *x)


def on_shards(docs: DataFrame, shards: int, dims: tuple[str, ...], bits: int, id_col: str, text_col: str,
              carry: tuple[Column, ...] = ()) -> DataFrame:
    """(_id, size, text_crc32, curve, shard, slot) and what is carried."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    base = docs.select(F.col(id_col).alias("_id"), *[F.col(d).alias(f"d{i}") for i, d in enumerate(dims)],
                       (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
                       F.xxhash64(text).alias("_tie"), *carry)
    names = tuple(f"d{i}" for i in range(len(dims)))
    on_curve = curve_index(base.withColumns(cells(base, names, bits)), len(dims), bits).drop(*names)
    order = ("curve", "text_crc32", "_id", "_tie")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranked = written(on_curve.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                     .withColumn("at", F.monotonically_increasing_id()), "curve")
    part = F.shiftright("at", 33)
    sizes = ranked.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition: at most ``parts`` rows
    sizes = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
                         F.sum("n").over(Window.partitionBy()).alias("all"))
    rank = F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    shard = F.expr(f"rank * {shards} div all")
    first = F.expr(f"(shard * all + {shards - 1}) div {shards}")
    return (ranked.withColumn("part", part).join(F.broadcast(sizes), "part").withColumn("rank", rank)
            .withColumn("shard", shard.cast("int")).withColumn("slot", F.col("rank") - first))


def placed(docs: DataFrame, shards: int = SHARDS, dims: tuple[str, ...] = DIMENSIONS, bits: int = BITS,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Query op4, one row per row of ``docs``: doc_id, size, text_crc32, law (``rows``), shard, slot,
    grown_shard (null: of law ``key`` only), curve.  A null text has size 16 and checksum 0; null
    dimensions are in the lowest cell; repeated rows are rows; with fewer rows than shards some
    shards are empty; columns of any other name are not read."""
    return on_shards(docs, shards, dims, bits, id_col, text_col).select(
        F.col("_id").cast("long").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, dims: tuple[str, ...] = DIMENSIONS, bits: int = BITS,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write all columns of ``docs`` as one folder per shard, rows in curve order, and return the
    pruning table: per shard the rows and each dimension's minimum and maximum.  The folders are
    named by ``shard``, with underscores before it if ``docs`` has such a column."""
    name = "shard"
    while name in docs.columns:
        name = f"_{name}"
    whole = F.struct("*").alias("row")
    rows = on_shards(docs, shards, dims, bits, id_col, text_col, (whole,)).repartition("shard").sortWithinPartitions("shard", "slot")
    rows.select(F.col("shard").alias(name), "row.*").write.partitionBy(name).parquet(path)
    return docs.sparkSession.read.parquet(path).groupBy(F.col(name).alias("shard")).agg(
        F.count(F.lit(1)).alias("rows"), *[f(d).alias(f"{k}_{d}") for d in dims for k, f in (("min", F.min), ("max", F.max))])
