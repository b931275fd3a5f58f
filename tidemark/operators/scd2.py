"""Slowly changing dimensions of type 2."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import row_hash
from .ids import dense_ids

BASELINE_FROM, OPEN_TO = datetime(1900, 1, 1), datetime(9999, 12, 31)


def _ts(t: datetime) -> Column:
    return F.lit(t.isoformat(" ")).cast("timestamp_ntz")


def with_hash(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumn("row_hash", row_hash([(F.col(c), df.schema[c].dataType) for c in columns]))


def _version(df: DataFrame, since: Column) -> DataFrame:
    return df.withColumns({"valid_from": since, "valid_to": _ts(OPEN_TO), "is_current": F.lit(True)})


def baseline(incoming: DataFrame, sk: str, order: str) -> DataFrame:
    """Version 1 of every row, valid from the beginning, numbered in source order."""
    return _version(dense_ids(incoming, order, sk), _ts(BASELINE_FROM)).drop(order)


def classify(dim: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """incoming with change: new, changed or unchanged against the current versions."""
    current = dim.filter("is_current").select(F.col(key).alias("_key"), F.col("row_hash").alias("_old"))
    rows = incoming.join(current, F.col(key) == F.col("_key"), "left")
    change = F.when(F.col("_key").isNull(), "new").when(F.col("_old") == F.col("row_hash"), "unchanged").otherwise("changed")
    return rows.withColumn("change", change).drop("_key", "_old")


def merge(dim: DataFrame, incoming: DataFrame, key: str, sk: str, order: str, cutoff: datetime) -> DataFrame:
    """The dimension after an incremental batch.

    New keys get a version from the cutoff on; changed ones too, and their current version ends there. Keys that do
    not come in again stay as they are. Numbers go on from the highest, in source order.
    """
    if cutoff is None:
        raise ValueError("an incremental batch needs a cutoff")
    moved = classify(dim, incoming, key).filter("change <> 'unchanged'")
    highest = dim.agg(F.coalesce(F.max(sk), F.lit(0)).alias("_highest"))
    numbered = dense_ids(moved.crossJoin(F.broadcast(highest)), order, sk, F.col("_highest"))  # one row
    fresh = _version(numbered, _ts(cutoff)).select(*dim.columns)
    changed = moved.filter("change = 'changed'").select(F.col(key).alias("_key"), F.lit(True).alias("_ends"))
    ends = F.coalesce("_ends", F.lit(False)) & F.col("is_current")
    kept = dim.join(changed, F.col(key) == F.col("_key"), "left").withColumns({"valid_to": F.when(ends, _ts(cutoff)).otherwise(F.col("valid_to")), "is_current": F.col("is_current") & ~ends})
    return kept.select(*dim.columns).unionByName(fresh)


def change_counts(dim: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    return classify(dim, incoming, key).groupBy("change").agg(F.count("*").alias("n"))
