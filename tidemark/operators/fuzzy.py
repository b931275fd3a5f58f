"""Canonical values for misspelt ones."""

from __future__ import annotations

import difflib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import canonical


def close(value: str, allowed: list[str], cutoff: float) -> str | None:
    """The allowed value most like the given one, by the share of matching blocks."""
    upper = {a.upper(): a for a in allowed}
    hit = difflib.get_close_matches(value.upper(), list(upper), n=1, cutoff=cutoff)
    return upper[hit[0]] if hit else None


#: Distinct misspelt values that are held as a local table; more of them are joined where they are.
LOCAL_VALUES = 10_000


def close_match(df: DataFrame, column: str, allowed: list[str], to: str, cutoff: float = 0.75) -> DataFrame:
    """df with `to`: the exact allowed value, else the closest one, else null.

    Similarity is computed once per distinct value that has no exact match, in Arrow batches on the executors; rows
    themselves never pass through Python. That is one job over this column, run at once: up to LOCAL_VALUES resolved
    values come back and are broadcast, so the rows are not shuffled; of more, the same table is joined by a shuffle.
    """

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(_close=[close(v, allowed, cutoff) for v in batch["_value"]])

    exact = canonical(F.col(column), allowed)
    odd = df.filter(F.col(column).isNotNull() & exact.isNull()).select(F.col(column).alias("_value")).distinct()
    found = odd.mapInPandas(best, "_value string, _close string")
    few = found.limit(LOCAL_VALUES + 1).collect()
    if not few:
        return df.withColumn(to, exact)
    if len(few) <= LOCAL_VALUES:
        found = F.broadcast(df.sparkSession.createDataFrame(few, "_value string, _close string"))
    return df.join(found, F.col(column) == F.col("_value"), "left").withColumn(to, F.coalesce(exact, "_close")).drop("_value", "_close")
