"""What readers query after a batch: views over the published tables and the thirteen indicators, exports, a catalogue.

Views show the version that was published when `views` was called; calling it again moves them to the latest one, or to
another date and cutoff. Nothing is computed until a view is read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from ..sources import sinks
from ..sources.store import Store
from . import batches

# The names under which tables and indicators are queried.
TABLES = ("fact_transaction", "dim_customer", "dim_branch", "dim_product", "dq_scorecard", "batch_changes", "kpi_snapshot")
VIEWS = {
    "kpi01": "kpi_01_top5_customers",
    "kpi02": "kpi_02_monthly_branch_trend",
    "kpi03": "kpi_03_product_revenue",
    "kpi04": "kpi_04_dormant_accounts",
    "kpi05": "kpi_05_suspicious_txns",
    "kpi06": "kpi_06_rfm_segments",
    "kpi07": "kpi_07_branch_rank_region",
    "kpi08": "kpi_08_kyc_risk_exposure",
    "kpi09": "kpi_09_refund_rate",
    "kpi10": "kpi_10_dq_scorecard",
    "kpi11": "kpi_11_day2_reconciliation",
    "kpi12": "kpi_12_kyc_transitions",
    "kpi13": "kpi_13_day2_activation",
}


def views(spark: SparkSession, root: str, as_of: str, cutoff: str, before: str, now_batch: str) -> dict[str, DataFrame]:
    """Create or move the views of all published tables, of v_fact and of the indicators; gives the indicators by view name."""
    store = Store(spark, root)
    tables = {name: batches.gold(store, name) for name in TABLES}
    sinks.create_views(tables | {"v_fact": batches.v_fact(tables["fact_transaction"])})
    found = batches.indicators(spark, root, as_of, cutoff, before, now_batch)
    shown = {VIEWS[kpi]: rows for kpi, rows in found.items()}
    sinks.create_views(shown)
    return shown


def export(shown: dict[str, DataFrame], path: str) -> dict[str, int]:
    """Write each indicator as a folder of CSV files with headers, in order of their names, and count its rows on the way."""
    counts = {}
    for name, rows in shown.items():
        seen = Observation(name)
        sinks.write_csv(rows.observe(seen, F.count(F.lit(1)).alias("n")), f"{path}/{name}", single=False)
        counts[name] = seen.get["n"]
    return counts


def catalogue(spark: SparkSession, root: str, database: str) -> list[str]:
    """External tables over the published folders in a database of their own; queries may then name them alone after
    `spark.catalog.setCurrentDatabase`, or with the database before them."""
    store = Store(spark, root)
    pointer = store.latest(batches.POINTER)[1] or {}
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    names = [name for name in TABLES if name in pointer]
    for name in names:
        sinks.external_table(spark, f"{database}.{name}", store.path(pointer[name]))
    return names


def pages(rows: DataFrame, size: int = 1_000) -> Iterator[list[Row]]:
    """A result of any length, page by page; the driver holds one page and one partition of the result at a time."""
    found = rows.toLocalIterator()
    while page := list(islice(found, size)):
        yield page
