"""Point-in-time resolution of surrogate keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def resolve_sk(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, sk: str, ts: str) -> DataFrame:
    """facts with sk: of the version valid at ts, else the current one, else any; null for unknown keys.

    A key's versions are few; they are gathered per key before the join, so the facts are joined one to one and
    never multiplied, sorted or windowed. Among versions of equal rank the latest start wins.
    """
    versions = dim.groupBy(F.col(dim_key).alias("_key")).agg(F.collect_list(F.struct("valid_from", "valid_to", "is_current", F.col(sk).alias("sk"))).alias("_versions"))
    rows = facts.join(versions, F.col(fact_key) == F.col("_key"), "left")
    at = F.col(ts)
    rank = lambda v: ((v["valid_from"] <= at) & (at < v["valid_to"])).cast("int") * 2 + v["is_current"].cast("int")
    best = F.array_max(F.transform("_versions", lambda v: F.struct(F.coalesce(rank(v), F.lit(0)).alias("rank"), v["valid_from"].alias("since"), v["sk"].alias("sk"))))
    return rows.withColumn(sk, best["sk"]).drop("_key", "_versions")


def missing(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Facts whose key no version of the dimension has."""
    return facts.join(dim.select(F.col(dim_key).alias(fact_key)).distinct(), fact_key, "left_anti")


def known(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    return facts.join(dim.select(F.col(dim_key).alias(fact_key)).distinct(), fact_key, "left_semi")
