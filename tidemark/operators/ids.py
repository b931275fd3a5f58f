"""Dense numbers for rows in order, without gathering them in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 100_000


def dense_ids(df: DataFrame, order: str, name: str, start: Column | int = 0) -> DataFrame:
    """Add `name`: start + 1, start + 2, ... in the order of a bigint column of distinct values.

    Rows are numbered inside blocks of the order column; the blocks' running counts, one row each, are added.
    """
    rows = df.withColumn("_block", F.floor(F.col(order) / BLOCK))
    counts = rows.groupBy("_block").count()
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)  # one row per block
    offsets = counts.select("_block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    own = F.row_number().over(Window.partitionBy("_block").orderBy(order))
    start = start if isinstance(start, Column) else F.lit(start)
    return rows.join(offsets, "_block").withColumn(name, (start + F.col("_offset") + own).cast("bigint")).drop("_block", "_offset")
