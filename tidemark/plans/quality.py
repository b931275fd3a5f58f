"""What a batch says about its quality: counts, gates, scorecards and snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def reconcile(counts: DataFrame) -> DataFrame:
    """counts (entity, raw, clean, rejected) with balanced: raw = clean + rejected, and something came in."""
    return counts.withColumn("balanced", (F.col("raw") == F.col("clean") + F.col("rejected")) & (F.col("raw") > 0))


def quarantine_rate(rejects: DataFrame, received: DataFrame, limit: float = 0.25) -> DataFrame:
    """Per entity: received, dq_rejected (without unknown keys), rate, and over_limit (strictly above)."""
    bad = rejects.filter("error_code <> 'MISSING_DIM'").groupBy("entity").agg(F.count("*").alias("dq_rejected"))
    rows = received.join(bad, "entity", "left").withColumn("dq_rejected", F.coalesce("dq_rejected", F.lit(0)))
    rate = F.try_divide("dq_rejected", "received")
    return rows.select("entity", "received", "dq_rejected", rate.alias("rate"), F.coalesce(rate > limit, F.lit(False)).alias("over_limit"))


def top_reasons(rejects: DataFrame, keys: list[str], k: int = 3, rank: Column | None = None) -> DataFrame:
    """Per key: the k most frequent error codes as `code=n; code=n`; ties by rank (rule order), then code."""
    counts = rejects.groupBy(*keys, "error_code").agg(F.count("*").alias("n"), F.min(rank if rank is not None else F.lit(0)).alias("_rank"))
    order = Window.partitionBy(*keys).orderBy(F.desc("n"), "_rank", "error_code")
    best = counts.withColumn("_at", F.row_number().over(order)).filter(F.col("_at") <= k)
    shown = F.array_sort(F.collect_list(F.struct("_at", F.format_string("%s=%d", "error_code", "n").alias("s"))))
    return best.groupBy(*keys).agg(F.array_join(F.transform(shown, lambda x: x["s"]), "; ").alias("top_reasons"))


def scorecard(received: DataFrame, rejects: DataFrame) -> DataFrame:
    """received (batch_id, entity, source_file, received) with passed, rejected and top_reasons."""
    keys = ["batch_id", "entity"]
    n = rejects.groupBy(*keys).agg(F.count("*").alias("rejected"))
    rows = received.join(n, keys, "left").join(top_reasons(rejects, keys), keys, "left")
    rejected = F.coalesce("rejected", F.lit(0))
    return rows.select("batch_id", "source_file", "entity", "received", (F.col("received") - rejected).alias("passed"), rejected.alias("rejected"), F.coalesce("top_reasons", F.lit("")).alias("top_reasons"))


def replace_batch(snapshots: DataFrame, fresh: DataFrame, batch_id: str) -> DataFrame:
    return snapshots.filter(F.col("batch_id") != batch_id).unionByName(fresh)


def control_sum(facts: DataFrame) -> DataFrame:
    """The rows and the sum of amounts in the home currency."""
    return facts.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.when(F.col("currency") == "INR", F.col("amount"))), F.lit(0)).alias("home_amount"))
