"""The rule engine: ordered checks over a table, each row claimed by the first that fails.

Rules and flags are data. One pass annotates every row with its first error and its flags; accepted and rejected
rows are two filters over that one plan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REJECT_COLUMNS = ("entity", "batch_id", "source_file", "source_row", "rule_id", "error_code", "error_detail", "raw_payload")
ERROR = "struct<rule_id:string,error_code:string,error_detail:string>"


@dataclass(frozen=True)
class Rule:
    """Rows for which `fails` is true are rejected."""

    rule_id: str
    code: str
    detail: str
    fails: Column


@dataclass(frozen=True)
class Flag:
    """Rows for which `when` is true are repaired, and say so."""

    code: str
    when: Column


def error(rule: Rule) -> Column:
    return F.struct(F.lit(rule.rule_id).alias("rule_id"), F.lit(rule.code).alias("error_code"), F.lit(rule.detail).alias("error_detail"))


def first_error(rules: list[Rule]) -> Column:
    """The error of the first rule that fails, else null."""
    return F.coalesce(*[F.when(r.fails, error(r)) for r in rules], F.lit(None).cast(ERROR))


def flags(items: list[Flag]) -> Column:
    """The codes of all flags that hold, joined by ; in order."""
    return F.concat_ws(";", *[F.when(f.when, F.lit(f.code)) for f in items])


def annotate(df: DataFrame, rules: list[Rule], items: list[Flag]) -> DataFrame:
    return df.withColumns({"first_error": first_error(rules), "dq_flags": flags(items)})


def accepted(df: DataFrame) -> DataFrame:
    return df.filter("first_error IS NULL").drop("first_error")


def rejected(df: DataFrame, entity: str, batch_id: str, source_file: str) -> DataFrame:
    """Rejected rows in quarantine form; df has _src_row and _raw."""
    return df.filter("first_error IS NOT NULL").select(
        F.lit(entity).alias("entity"), F.lit(batch_id).alias("batch_id"), F.lit(source_file).alias("source_file"),
        F.col("_src_row").cast("int").alias("source_row"), "first_error.rule_id", "first_error.error_code", "first_error.error_detail", F.col("_raw").alias("raw_payload"),
    )
