"""The star schema over the sample tables: facts from line items, dimensions from customers, suppliers and parts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.pit import resolve_sk

AS_OF, CUTOFF = "2001-12-01", "2001-01-01"
BASELINE, INCREMENTAL = "day1-baseline", "day2-incremental"
FROM, TO = "1900-01-01", "9999-12-31"


@dataclass(frozen=True)
class Star:
    """fact is what views of it show: columns renamed, remarks and flags left out."""

    fact: DataFrame
    customer: DataFrame
    branch: DataFrame
    product: DataFrame


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ts(text: str) -> F.Column:
    return F.lit(text).cast("timestamp_ntz")


def cents(c: str) -> F.Column:
    return F.round(F.col(c) * 100).cast("bigint")


def kyc(segment: F.Column) -> F.Column:
    return F.when(segment == "FURNITURE", "Pending").when(segment == "HOUSEHOLD", "Rejected").otherwise("Verified")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every thirteenth customer joins at the cutoff; every fifth of the others changes its status then."""
    c = read(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    late, moved = key % 13 == 0, (key % 5 == 0) & (key % 13 != 0)
    base = c.select(
        key, F.concat(F.lit("C"), key).alias("customer_id"), F.col("c_name").alias("customer_name"), F.concat(F.lit("A"), key).alias("account_id"),
        kyc(F.col("c_mktsegment")).alias("status"), moved.alias("moved"), late.alias("late"),
    )
    changed = F.when(F.col("status") == "Verified", "Pending").otherwise("Verified")
    one = F.struct((key * 2 + 1).alias("customer_sk"), F.col("status").alias("kyc_status"), F.when(F.col("late"), _ts(CUTOFF)).otherwise(_ts(FROM)).alias("valid_from"), F.when(F.col("moved"), _ts(CUTOFF)).otherwise(_ts(TO)).alias("valid_to"), (~F.col("moved")).alias("is_current"))
    two = F.struct((key * 2 + 2).alias("customer_sk"), changed.alias("kyc_status"), _ts(CUTOFF).alias("valid_from"), _ts(TO).alias("valid_to"), F.lit(True).alias("is_current"))
    versions = F.when(F.col("moved"), F.array(one, two)).otherwise(F.array(one))
    return base.withColumn("v", F.explode(versions)).select("customer_id", "customer_name", "account_id", "v.*")


def branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, n, r = (read(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    rows = s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.select(
        (F.col("s_suppkey") + 1).alias("branch_sk"), F.concat(F.lit("B"), "s_suppkey").alias("branch_id"), F.col("s_name").alias("branch_name"),
        F.col("r_name").alias("region"), _ts(FROM).alias("valid_from"), _ts(TO).alias("valid_to"), F.lit(True).alias("is_current"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part")
    kind = F.when(F.col("p_type") == "ECONOMY", "Loan").when(F.col("p_type") == "SMALL", "Credit Card").otherwise("Savings Account")
    return p.select(
        (F.col("p_partkey") + 1).alias("product_sk"), F.concat(F.lit("P"), "p_partkey").alias("product_id"), F.col("p_name").alias("product_name"), kind.alias("product_type"),
        F.col("p_brand").alias("category"), cents("p_retailprice").alias("price"), _ts(FROM).alias("valid_from"), _ts(TO).alias("valid_to"), F.lit(True).alias("is_current"),
    )


def raw_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their orders, before keys are resolved."""
    rows = read(spark, sf_dir, "lineitem").join(read(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    status = F.when(F.col("o_orderstatus") == "F", "SUCCESS").when(F.col("o_orderstatus") == "O", "PENDING").otherwise("FAILED")
    late = (F.col("o_orderdate") >= _ts(CUTOFF)) | (F.col("o_custkey") % 11 == 0)
    return rows.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("transaction_id"), F.concat(F.lit("A"), "o_custkey").alias("account_id"), F.concat(F.lit("P"), "l_partkey").alias("product_id"),
        F.concat(F.lit("B"), "l_suppkey").alias("branch_id"), F.to_date("l_shipdate").alias("transaction_date"), F.col("l_shipdate").alias("txn_ts"), cents("l_extendedprice").alias("amount"),
        status.alias("status"), F.when(F.col("l_orderkey") % 17 == 0, "USD").otherwise("INR").alias("currency"), (F.col("l_returnflag") == "R").alias("is_refund"),
        F.when(late, INCREMENTAL).otherwise(BASELINE).alias("first_batch_id"),
    )


def star(spark: SparkSession, sf_dir: str) -> Star:
    customer, branch, product = customers(spark, sf_dir), branches(spark, sf_dir), products(spark, sf_dir)
    fact = resolve_sk(raw_facts(spark, sf_dir), customer, "account_id", "account_id", "customer_sk", "txn_ts")
    fact = fact.withColumns({"branch_sk": F.substring("branch_id", 2, 20).cast("bigint") + 1, "product_sk": F.substring("product_id", 2, 20).cast("bigint") + 1})
    return Star(fact, customer, branch, product)
