"""Deduplication on a business key: exact copies, conflicts, and copies that differ by missing values only."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .rules import Rule, error


def flag_count(flags: Column) -> Column:
    return F.when(F.coalesce(flags, F.lit("")) == "", F.lit(0)).otherwise(F.size(F.split(flags, ";")))


def dedupe_errors(df: DataFrame, key: str, business: list[str], prefix: str, order: str = "_src_row", flags: str = "dq_flags", among: Column | None = None) -> DataFrame:
    """Add dup_error: null for the rows that stay.

    Of exact copies the first stays; if a key still has two different non-null values in a column, all its copies go,
    as no choice would be safe; of the others the copy with the fewest flags stays, the first among equals. Values
    compare as text, nulls equal. With `among`, only rows where it holds are looked at; each of the others is a
    group of its own. All windows are partitioned by the same group, so that one shuffle serves them all.
    """
    text = {c: F.col(c).cast("string") for c in business}
    among = F.lit(True) if among is None else among
    # Rows that are out stand alone by their position, so that their keys, often missing, fill no partition.
    rows = df.withColumns({"_key": F.when(among, F.col(key)), "_alone": F.when(~among, F.col(order))})
    group = ["_key", "_alone"]
    rows = rows.repartition(*map(F.col, group))
    same = Window.partitionBy(*group, *text.values()).orderBy(order)
    of_key = Window.partitionBy(*group)
    # Exact copies have no values of their own, so they may stay in while conflicts are looked for.
    differs = reduce(or_, [F.coalesce(F.min(c).over(of_key) != F.max(c).over(of_key), F.lit(False)) for c in text.values()])
    rows = rows.withColumns({"_copy": F.row_number().over(same) > 1, "_conflict": differs})
    best = Window.partitionBy(*group).orderBy(F.col("_copy"), flag_count(F.col(flags)), F.col(order))
    rows = rows.withColumn("_rank", F.row_number().over(best))
    steps = [
        Rule(f"{prefix}-DUP", "DUPLICATE_RECORD", "a copy of an earlier row", F.col("_copy")),
        Rule(f"{prefix}-CONFLICT", "CONFLICTING_DUPLICATE", "rows of one key disagree", F.col("_conflict")),
        Rule(f"{prefix}-DUP", "DUPLICATE_RECORD", "a poorer copy of another row", F.col("_rank") > 1),
    ]
    return rows.withColumn("dup_error", F.coalesce(*[F.when(r.fails, error(r)) for r in steps])).drop("_copy", "_conflict", "_rank", *group)
