"""Fact upsert: a row that comes again replaces the old one, so nothing counts twice."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(existing: DataFrame, incoming: DataFrame, key: str, batch_id: str) -> DataFrame:
    """All of existing that does not come again, and incoming with its batch; the batch of a key's first arrival stays."""
    first = existing.select(F.col(key), F.col("first_batch_id").alias("_first"))
    fresh = incoming.join(first, key, "left").withColumns({"loaded_batch_id": F.lit(batch_id), "first_batch_id": F.coalesce("_first", F.lit(batch_id))})
    kept = existing.join(incoming.select(key), key, "left_anti")
    return kept.unionByName(fresh.select(*existing.columns))


def summary(existing: DataFrame, incoming: DataFrame, key: str, values: list[str]) -> DataFrame:
    """One row: inserted; updated (some value differs, nulls equal); corrected (marked as a correction of a known key)."""
    old = existing.select(F.col(key), F.lit(True).alias("_known"), *[F.col(c).alias(f"_old_{c}") for c in values])
    rows = incoming.join(old, key, "left")
    known = F.coalesce("_known", F.lit(False))
    differs = reduce(or_, [~F.col(c).eqNullSafe(F.col(f"_old_{c}")) for c in values])
    return rows.agg(F.count_if(~known).alias("inserted"), F.count_if(known & differs).alias("updated"), F.count_if(known & F.coalesce("is_correction", F.lit(False))).alias("corrected"))
