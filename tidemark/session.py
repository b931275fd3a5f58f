"""The Spark session that the engine expects; on a cluster, masters and sizes come from spark-submit."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def session(master: str | None = None, shuffle_partitions: int | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName("tidemark")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.config(map=SETTINGS | settings).getOrCreate()
