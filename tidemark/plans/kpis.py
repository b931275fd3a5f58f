"""The thirteen indicators, each a plan over a star.

Value indicators count successful transactions in the home currency. Windows without partition run over rows that are
already aggregated (one per account, month or status), or are replaced by bounded top-k plans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import exact_pct
from ..sources.star import Star

HOME = "INR"


def successes(fact: DataFrame) -> DataFrame:
    return fact.filter((F.col("status") == "SUCCESS") & (F.col("currency") == HOME))


def net() -> Column:
    """Refunds count against the volume."""
    return F.sum(F.when(F.col("is_refund"), -F.col("amount")).otherwise(F.col("amount")))


def month_of(name: str) -> Column:
    """The month's first instant."""
    return F.date_trunc("month", F.col(name)).cast("timestamp_ntz")


def _timestamp(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _current(dim: DataFrame) -> DataFrame:
    return dim.filter("is_current")


def top_customers(s: Star, k: int = 5) -> DataFrame:
    """KPI 1: the k accounts of largest net volume; the order and the limit are one top-k, numbered afterwards."""
    best = successes(s.fact).groupBy("account_id").agg(net().alias("net_volume"), F.count("*").alias("txn_count"))
    order = [F.desc("net_volume"), F.desc("txn_count"), F.asc("account_id")]
    best = best.orderBy(*order).limit(k)
    owner = _current(s.customer).select("account_id", "customer_id", "customer_name")
    ranked = best.join(owner, "account_id", "left").withColumn("rnk", F.row_number().over(Window.orderBy(*order)))
    return ranked.select("rnk", "customer_id", "customer_name", "account_id", "net_volume", "txn_count")


def _change(value: str, key: str) -> tuple[Column, Column]:
    """The value of the period before, and the change from it in percent."""
    before = F.lag(value).over(Window.partitionBy(key).orderBy("month"))
    return before, exact_pct(F.col(value) - before, before)


def branch_trend(s: Star) -> DataFrame:
    """KPI 2: volume per branch and month in the region of the time, and the change from the last month with any.

    Facts are summed per version of a branch before the few versions are joined.
    """
    branch = s.branch.select("branch_sk", "region")
    month = month_of("transaction_date").alias("month")
    rows = successes(s.fact).groupBy("branch_sk", "branch_id", month).agg(F.sum("amount").alias("volume"), F.count("*").alias("txn_count"))
    rows = rows.join(branch, "branch_sk").groupBy("region", "branch_id", "month").agg(F.sum("volume").alias("volume"), F.sum("txn_count").alias("txn_count"))
    before, change = _change("volume", "branch_id")
    return rows.withColumns({"prev_month_volume": before, "mom_pct": change})


def product_revenue(s: Star) -> DataFrame:
    """KPI 3: net revenue per product and month, its shares of category and total, and the change.

    Facts are read once and summed once. Shares come from windows over those sums: one row per product in a month, so
    that a task holds as many rows as there are products, however many facts there are.
    """
    product = s.product.select("product_sk", "category")
    month = month_of("transaction_date").alias("month")
    rows = successes(s.fact).groupBy("product_sk", "product_id", month).agg(net().alias("revenue"))
    rows = rows.join(product, "product_sk").groupBy("category", "product_id", "month").agg(F.sum("revenue").alias("revenue"))
    before, change = _change("revenue", "product_id")
    rows = rows.withColumns({"prev_period_revenue": before, "pop_pct": change})
    share = lambda *keys: exact_pct(F.col("revenue"), F.sum("revenue").over(Window.partitionBy(*keys)))
    rows = rows.withColumn("total_share_pct", share("month")).withColumn("category_share_pct", share("category", "month"))
    return rows.select("category", "product_id", "month", "revenue", "category_share_pct", "total_share_pct", "prev_period_revenue", "pop_pct")


def dormant_accounts(s: Star, as_of: str, days: int = 90) -> DataFrame:
    """KPI 4: current customers without success for `days`, or ever; of equal times the larger transaction id counts as the later."""
    last = successes(s.fact).groupBy("account_id").agg(F.max(F.struct("txn_ts", "transaction_id", "product_id")).alias("last"))
    kind = _current(s.product).select("product_id", "product_type")
    rows = _current(s.customer).join(last, "account_id", "left").select("customer_id", "account_id", F.col("last.txn_ts").alias("last_txn_ts"), F.col("last.product_id").alias("product_id"))
    since = _timestamp(as_of) - F.expr(f"INTERVAL '{days}' DAY")
    rows = rows.filter(F.col("last_txn_ts").isNull() | (F.col("last_txn_ts") < since)).join(kind, "product_id", "left")
    risky = F.coalesce(F.col("product_type").isin("Credit Card", "Loan"), F.lit(False))
    return rows.select("customer_id", "account_id", "last_txn_ts", "product_type", F.when(risky, "High-Risk Dormant").otherwise("Dormant").alias("dormant_flag"))


def with_recent_count(rows: DataFrame, key: str, ts: str, name: str, minutes: int = 10) -> DataFrame:
    """Rows with how many rows of their key lie within the minutes up to each, both ends included, to the microsecond.

    Keys are cut into slots of that length, and each row is shown to its own slot and to the next one, which looks back
    into it; so a task holds two slots of a key, however many rows the key has. Rows without time count each other.
    """
    width = minutes * 60_000_000
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    slot = micros - F.pmod(micros, F.lit(width))
    shown = lambda at, own: F.struct(at.alias("slot"), F.lit(own).alias("own"))
    slots = F.when(slot.isNull(), F.array(shown(slot, True))).otherwise(F.array(shown(slot, True), shown(slot + width, False)))
    near = Window.partitionBy(key, "_at.slot").orderBy("_micros").rangeBetween(-width, 0)
    rows = rows.withColumn("_micros", micros).withColumn("_at", F.explode(slots)).withColumn(name, F.count("*").over(near))
    return rows.filter("_at.own").drop("_micros", "_at")


def suspicious(fact: DataFrame, high: int = 100_000, burst: int = 3) -> DataFrame:
    """KPI 5: high values, bursts within ten minutes, and nights; all statuses."""
    rows = fact.filter(F.col("currency") == HOME).select("transaction_id", "account_id", "branch_id", "txn_ts", "amount", "status")
    rows = with_recent_count(rows, "account_id", "txn_ts", "txns_last_10m")
    tests = {"HIGH_VALUE": F.col("amount") > high, f"VELOCITY_{burst}_IN_10M": F.col("txns_last_10m") >= burst, "NIGHT_00_05": F.hour("txn_ts") < 5}
    reason = F.concat_ws("; ", *[F.when(test, F.lit(code)) for code, test in tests.items()])
    rows = rows.withColumn("risk_reason", reason).filter("risk_reason <> ''")
    return rows.select("transaction_id", "account_id", "branch_id", "txn_ts", "amount", "status", "txns_last_10m", "risk_reason")


def value_block(value: Column) -> Column:
    """A number that never falls as the value rises, and takes at most some 130,000 values over all bigints."""
    return (F.signum(value.cast("double")) * F.floor(F.log2(F.abs(value.cast("double")) + 1) * 1024)).cast("bigint")


def tertiles(values: DataFrame, keys: list[str]) -> DataFrame:
    """values (keys, value bigint, any others) as (keys, value, tertile): 1, 2 or 3 by percent rank within the keys; ties share it.

    No task holds all rows: rows are counted per distinct value, running counts are taken over blocks of values (one row
    per block), and inside each block.
    """
    counts = values.groupBy(*keys, "value").agg(F.count("*").alias("n")).withColumn("block", value_block(F.col("value")))
    blocks = counts.groupBy(*keys, "block").agg(F.sum("n").alias("n"))
    before = Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(*keys, "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("prior"), F.sum("n").over(Window.partitionBy(*keys)).alias("total"))
    inside = Window.partitionBy(*keys, "block").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    less = F.col("prior") + F.coalesce(F.sum("n").over(inside), F.lit(0))
    p = F.coalesce(less / F.nullif(F.col("total") - 1, F.lit(0)), F.lit(0.0))
    ranks = counts.join(blocks, [*keys, "block"])
    return ranks.select(*keys, "value", F.when(p < F.lit(1.0) / 3, 1).when(p < F.lit(2.0) / 3, 2).otherwise(3).alias("tertile"))


def rfm_segments(s: Star, as_of: str) -> DataFrame:
    """KPI 6: recency, frequency and monetary scores of accounts with successes, and their segment."""
    rows = successes(s.fact).groupBy("account_id").agg(F.datediff(_timestamp(as_of), F.max("txn_ts")).cast("bigint").alias("recency_days"), F.count("*").alias("frequency"), net().alias("monetary"))
    # One row per account and score, so that one plan ranks all three; fewer days are better.
    value = lambda kind, c: F.struct(F.lit(kind).alias("kind"), c.alias("value"))
    long = rows.select("account_id", F.inline(F.array(value("recency", -F.col("recency_days")), value("frequency", F.col("frequency")), value("monetary", F.col("monetary")))))
    scored = long.join(tertiles(long, ["kind"]), ["kind", "value"])
    of = lambda kind: F.max(F.when(F.col("kind") == kind, F.col("value")))
    scored = scored.groupBy("account_id").agg((-of("recency")).alias("recency_days"), of("frequency").alias("frequency"), of("monetary").alias("monetary"), F.sum("tertile").cast("int").alias("rfm_score"))
    segment = F.when(F.col("rfm_score") >= 8, "Platinum").when(F.col("rfm_score") >= 6, "Gold").when(F.col("rfm_score") == 5, "Silver").otherwise("Bronze")
    owner = _current(s.customer).select("account_id", "customer_id")
    return scored.join(owner, "account_id", "left").select("customer_id", "account_id", "recency_days", "frequency", "monetary", "rfm_score", segment.alias("segment"))


def branch_rank(s: Star) -> DataFrame:
    """KPI 7: branches ranked by net volume within their present region; the first is TOP, the last BOTTOM."""
    branch = _current(s.branch).select("branch_id", "region", "branch_name")
    rows = successes(s.fact).groupBy("branch_id").agg(net().alias("net_volume"), F.count("*").alias("txn_count")).join(branch, "branch_id")
    down, up = (Window.partitionBy("region").orderBy(o) for o in (F.desc("net_volume"), F.asc("net_volume")))
    rows = rows.withColumns({"rnk": F.rank().over(down), "dense_rnk": F.dense_rank().over(down), "_last": F.rank().over(up)})
    flag = F.when(F.col("rnk") == 1, "TOP").when(F.col("_last") == 1, "BOTTOM")
    return rows.select("region", "branch_id", "branch_name", "net_volume", "txn_count", "rnk", "dense_rnk", flag.alias("performer_flag"))


def kyc_exposure(s: Star) -> DataFrame:
    """KPI 8: counts and value by the status that held at the time, with shares of the whole."""
    status = s.customer.select("customer_sk", "kyc_status")
    rows = successes(s.fact).join(status, "customer_sk", "left").groupBy(F.coalesce("kyc_status", F.lit("UNKNOWN")).alias("kyc_status")).agg(F.count("*").alias("txn_count"), F.sum("amount").alias("total_value"))
    everything = Window.partitionBy()  # one row per status
    share = lambda c: exact_pct(F.col(c), F.sum(c).over(everything))
    return rows.select("kyc_status", (F.col("kyc_status") != "Verified").alias("is_not_verified"), "txn_count", "total_value", share("txn_count").alias("pct_count"), share("total_value").alias("pct_value"))


def refund_rate(s: Star) -> DataFrame:
    """KPI 9: refunds by product and branch, in count and value."""
    product = _current(s.product).select("product_id", "product_name")
    refund = F.col("is_refund")
    rows = successes(s.fact).groupBy(F.col("product_id"), "branch_id").agg(
        F.count("*").alias("total_count"), F.count_if(refund).alias("refund_count"), F.sum("amount").alias("total_value"), F.sum(F.when(refund, F.col("amount")).otherwise(0)).alias("refund_value")
    )
    rows = rows.withColumnRenamed("product_id", "fact_product").join(product, F.col("fact_product") == F.col("product_id"), "left")
    return rows.select(
        "product_id", "product_name", "branch_id", "total_count", "refund_count", exact_pct(F.col("refund_count"), F.col("total_count")).alias("refund_count_pct"),
        "total_value", "refund_value", exact_pct(F.col("refund_value"), F.col("total_value")).alias("refund_value_pct"),
    )


def scorecard_rates(scorecard: DataFrame) -> DataFrame:
    """KPI 10: the scorecard with rejection rates."""
    return scorecard.select("batch_id", "entity", "source_file", "received", "passed", "rejected", exact_pct(F.col("rejected"), F.col("received")).alias("reject_pct"), "top_reasons")


def snapshots(fact: DataFrame, branch: DataFrame, held: dict[str, Column], k: int = 5) -> DataFrame:
    """(batch_id, kpi, key, metric) of KPI 1 and 7 for several states of the facts at once; `held` tells each state's rows.

    Facts are read once: sums per account and branch, for every state, meet in one aggregation; only the k best accounts
    of each state go on.
    """
    ok = successes(fact)
    signed = F.when(F.col("is_refund"), -F.col("amount")).otherwise(F.col("amount"))
    states = F.array_compact(F.array(*[F.when(c, F.lit(b)) for b, c in held.items()]))
    kinds = F.array(F.struct(F.lit("kpi_01_top5_net").alias("kpi"), F.col("account_id").alias("key")), F.struct(F.lit("kpi_07_branch_net").alias("kpi"), F.col("branch_id").alias("key")))
    by_state = ok.groupBy("account_id", "branch_id", states.alias("states")).agg(F.sum(signed).alias("net"), F.count("*").alias("n"))
    rows = by_state.select(F.explode("states").alias("batch_id"), kinds.alias("kinds"), "net", "n").select("batch_id", F.inline("kinds"), "net", "n")
    sums = rows.groupBy("batch_id", "kpi", "key").agg(F.sum("net").alias("net"), F.sum("n").alias("n"))
    # Branches are each a group of their own, so the limit per group keeps them all.
    alone = F.when(F.col("kpi") != "kpi_01_top5_net", F.col("key"))
    rank = F.row_number().over(Window.partitionBy("batch_id", "kpi", alone).orderBy(F.desc("net"), F.desc("n"), "key"))
    best = sums.withColumn("_rank", rank).filter(F.col("_rank") <= k)
    now = _current(branch).select(F.col("branch_id").alias("_branch"), F.lit(True).alias("_known"))
    best = best.join(now, (F.col("kpi") == "kpi_07_branch_net") & (F.col("key") == F.col("_branch")), "left").filter((F.col("kpi") == "kpi_01_top5_net") | F.col("_known"))
    return best.select("batch_id", "kpi", "key", F.col("net").cast("double").alias("metric"))


def snapshot_deltas(snapshot: DataFrame) -> DataFrame:
    """Totals of each indicator by batch, and the change from the batch before (by batch id)."""
    rows = snapshot.groupBy("batch_id", "kpi").agg(F.sum("metric").alias("total"))
    return rows.withColumn("delta", F.col("total") - F.lag("total").over(Window.partitionBy("kpi").orderBy("batch_id")))


def reconciliation(changes: DataFrame, snapshot: DataFrame) -> DataFrame:
    """KPI 11: what each batch changed, beside the totals of KPI 1 and 7 and their change."""
    names = {"kpi_01_top5_net": "kpi01_top5_net", "kpi_07_branch_net": "kpi07_network_net"}
    wide = snapshot_deltas(snapshot).groupBy("batch_id").pivot("kpi", list(names)).agg(F.first("total").alias("total"), F.first("delta").alias("delta"))
    columns = [c for k, v in names.items() for c in (F.col(f"{k}_total").alias(v), F.col(f"{k}_delta").alias(f"{v.split('_')[0]}_delta"))]
    return changes.join(wide, "batch_id", "left").select(
        "batch_id", F.col("fact_inserted").alias("new_txns"), F.col("fact_updated").alias("updated_txns"), F.col("fact_corrected").alias("corrected_txns"),
        "customers_new", "customers_changed", "products_changed", "branches_changed", *columns,
    )


def kyc_transitions(customer: DataFrame) -> DataFrame:
    """KPI 12: statuses that changed from one version to the next."""
    new = customer.select("customer_id", F.col("valid_from").alias("changed_on"), F.col("kyc_status").alias("to_status"))
    old = customer.select("customer_id", "customer_name", F.col("valid_to").alias("changed_on"), F.col("kyc_status").alias("from_status"))
    return old.join(new, ["customer_id", "changed_on"]).filter("from_status <> to_status").select("customer_id", "customer_name", "from_status", "to_status", "changed_on")


def activation(fact: DataFrame, customer: DataFrame, before: str, now: str, cutoff: str) -> DataFrame:
    """KPI 13: accounts whose first transactions came with batch `now` and none with `before`; customers who joined at the cutoff and have none."""
    by_account = fact.groupBy("account_id").agg(F.max((F.col("first_batch_id") == before)).alias("_old"), F.max(F.col("first_batch_id") == now).alias("_new"))
    first = by_account.filter("_new AND NOT _old").select(F.lit("FIRST_TXN_DAY2").alias("activation_type"), "account_id", F.lit(None).cast("string").alias("customer_id"))
    joined = customer.groupBy("customer_id").agg(F.max("account_id").alias("account_id"), F.min("valid_from").alias("since")).filter(F.col("since") == _timestamp(cutoff))
    idle = joined.join(fact.select("account_id").distinct(), "account_id", "left_anti").select(F.lit("ONBOARDED_NO_TXN_DAY2").alias("activation_type"), "account_id", "customer_id")
    return first.unionByName(idle)


# The order in which each indicator's rows are shown; nulls as told, the SQL standard's last where nothing is told.
ORDERS: dict[str, list[tuple[str, str]]] = {
    "kpi01": [("rnk", "asc")],
    "kpi02": [("region", "asc_nulls_last"), ("branch_id", "asc_nulls_last"), ("month", "asc_nulls_last")],
    "kpi03": [("month", "asc_nulls_last"), ("category", "asc_nulls_last"), ("revenue", "desc_nulls_last"), ("product_id", "asc")],
    "kpi04": [("dormant_flag", "asc"), ("last_txn_ts", "asc_nulls_first"), ("account_id", "asc_nulls_last")],
    "kpi05": [("txn_ts", "asc_nulls_last"), ("transaction_id", "asc_nulls_last")],
    "kpi06": [("rfm_score", "desc"), ("monetary", "desc"), ("account_id", "asc_nulls_last")],
    "kpi07": [("region", "asc_nulls_last"), ("rnk", "asc"), ("branch_id", "asc")],
    "kpi08": [("kyc_status", "asc")],
    "kpi09": [("refund_value_pct", "desc_nulls_last"), ("product_id", "asc_nulls_last"), ("branch_id", "asc_nulls_last")],
    "kpi10": [("batch_id", "asc"), ("entity", "asc")],
    "kpi11": [("batch_id", "asc")],
    "kpi12": [("changed_on", "asc"), ("customer_id", "asc")],
    "kpi13": [("activation_type", "asc"), ("account_id", "asc_nulls_last")],
}


def in_order(kpi: str, rows: DataFrame) -> DataFrame:
    """The rows of an indicator in the order in which it is shown (kpi01 to kpi13)."""
    return rows.orderBy(*[getattr(F.col(c), how)() for c, how in ORDERS[kpi]])
