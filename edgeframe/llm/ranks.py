"""Global ranks without a window over the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edgeframe.llm.textcol import written


def with_rank(df: DataFrame, order: list[Column], name: str, table: str) -> DataFrame:
    """``df`` with its place in ``order``, from 1, as the long column ``name``.

    Rows are dealt to range partitions, sorted there, numbered and written; the sizes of the
    partitions before it (one row per partition) make a row's number global.  ``order`` should end
    in a column that tells equal rows apart, so that no value fills a partition by itself."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = written(df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                     .withColumn("_at", F.monotonically_increasing_id()), table)
    part = F.shiftright("_at", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    # one row per partition
    return placed.withColumn("_part", part).join(F.broadcast(sizes), "_part") \
        .withColumn(name, F.col("_before") + own + 1).drop("_part", "_at", "_before")
