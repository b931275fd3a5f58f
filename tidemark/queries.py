"""The engine's registered queries over the sample tables, and the SQL that each must agree with."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import dates, numbers, text
from .operators import dedup, facts, fuzzy, pit, scd2
from .operators.rules import Flag, Rule, annotate
from .plans import cleansing_samples, entities, kpis, quality
from .sources import star as sample
from .sources.star import AS_OF, BASELINE, CUTOFF, INCREMENTAL, cents, read, star

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    """Register a function under its name, with the SQL for the same result."""

    def keep(f: Query) -> Query:
        QUERIES[f.__name__] = f
        ORACLE_SQL[f.__name__] = sql
        return f

    return keep


def pct(a: str, b: str) -> str:
    """SQL of the exact percentage."""
    return f"((CASE WHEN sign({a}) * sign({b}) < 0 THEN -1 ELSE 1 END) * ((abs({a}) * 20000 + abs({b})) // nullif(2 * abs({b}), 0))::DOUBLE / 100)"


CUSTOMER_SQL = f"""cust AS (
  SELECT c_custkey k, 'C' || c_custkey AS customer_id, c_name AS customer_name, 'A' || c_custkey AS account_id,
         CASE c_mktsegment WHEN 'FURNITURE' THEN 'Pending' WHEN 'HOUSEHOLD' THEN 'Rejected' ELSE 'Verified' END AS st,
         c_custkey % 5 = 0 AND c_custkey % 13 <> 0 AS moved, c_custkey % 13 = 0 AS late FROM customer),
dim_customer AS (
  SELECT customer_id, customer_name, account_id, 2 * k + 1 AS customer_sk, st AS kyc_status,
         CASE WHEN late THEN TIMESTAMP '{CUTOFF}' ELSE TIMESTAMP '1900-01-01' END AS valid_from,
         CASE WHEN moved THEN TIMESTAMP '{CUTOFF}' ELSE TIMESTAMP '9999-12-31' END AS valid_to, NOT moved AS is_current FROM cust
  UNION ALL
  SELECT customer_id, customer_name, account_id, 2 * k + 2, CASE st WHEN 'Verified' THEN 'Pending' ELSE 'Verified' END,
         TIMESTAMP '{CUTOFF}', TIMESTAMP '9999-12-31', true FROM cust WHERE moved)"""
BRANCH_SQL = """dim_branch AS (
  SELECT s_suppkey + 1 AS branch_sk, 'B' || s_suppkey AS branch_id, s_name AS branch_name, r_name AS region
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
PRODUCT_SQL = """dim_product AS (
  SELECT p_partkey + 1 AS product_sk, 'P' || p_partkey AS product_id, p_name AS product_name, p_brand AS category,
         CASE p_type WHEN 'ECONOMY' THEN 'Loan' WHEN 'SMALL' THEN 'Credit Card' ELSE 'Savings Account' END AS product_type FROM part)"""
FACT_SQL = f"""fact AS (
  SELECT l_orderkey || '-' || l_linenumber AS transaction_id, 'A' || o_custkey AS account_id, 'P' || l_partkey AS product_id, 'B' || l_suppkey AS branch_id,
         l_shipdate AS txn_ts, date_trunc('month', l_shipdate)::TIMESTAMP AS month, round(l_extendedprice * 100)::BIGINT AS amount,
         CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' WHEN 'O' THEN 'PENDING' ELSE 'FAILED' END AS status,
         CASE WHEN l_orderkey % 17 = 0 THEN 'USD' ELSE 'INR' END AS currency, l_returnflag = 'R' AS is_refund,
         CASE WHEN o_orderdate >= TIMESTAMP '{CUTOFF}' OR o_custkey % 11 = 0 THEN '{INCREMENTAL}' ELSE '{BASELINE}' END AS first_batch_id,
         2 * o_custkey + CASE WHEN o_custkey % 5 = 0 AND o_custkey % 13 <> 0 AND l_shipdate >= TIMESTAMP '{CUTOFF}' THEN 2 ELSE 1 END AS customer_sk,
         l_partkey + 1 AS product_sk, l_suppkey + 1 AS branch_sk
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
ok AS (SELECT *, CASE WHEN is_refund THEN -amount ELSE amount END AS signed FROM fact WHERE status = 'SUCCESS' AND currency = 'INR')"""
STAR_SQL = f"{CUSTOMER_SQL}, {BRANCH_SQL}, {PRODUCT_SQL}, {FACT_SQL}"


# ---------------------------------------------------------------- indicators


@query(f"""WITH {STAR_SQL}, n AS (SELECT account_id, sum(signed)::BIGINT AS net_volume, count(*) AS txn_count FROM ok GROUP BY 1),
r AS (SELECT *, row_number() OVER (ORDER BY net_volume DESC, txn_count DESC, account_id) AS rnk FROM n)
SELECT rnk::INTEGER AS rnk, customer_id, customer_name, r.account_id, net_volume, txn_count
FROM r LEFT JOIN dim_customer c ON c.account_id = r.account_id AND c.is_current WHERE rnk <= 5""")
def kpi01_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.in_order("kpi01", kpis.top_customers(star(spark, sf_dir)))


@query(f"""WITH {STAR_SQL}, m AS (SELECT region, ok.branch_id, month, sum(amount)::BIGINT AS volume, count(*) AS txn_count
  FROM ok JOIN dim_branch b ON ok.branch_sk = b.branch_sk GROUP BY ALL),
p AS (SELECT *, lag(volume) OVER (PARTITION BY branch_id ORDER BY month) AS prev_month_volume FROM m)
SELECT region, branch_id, month, volume, txn_count, prev_month_volume, {pct('(volume - prev_month_volume)', 'prev_month_volume')} AS mom_pct FROM p""")
def kpi02_branch_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.in_order("kpi02", kpis.branch_trend(star(spark, sf_dir)))


@query(f"""WITH {STAR_SQL}, m AS (SELECT category, ok.product_id, month, sum(signed)::BIGINT AS revenue
  FROM ok JOIN dim_product p ON ok.product_sk = p.product_sk GROUP BY ALL),
p AS (SELECT *, lag(revenue) OVER (PARTITION BY product_id ORDER BY month) AS prev_period_revenue,
             (sum(revenue) OVER (PARTITION BY category, month))::BIGINT AS c, (sum(revenue) OVER (PARTITION BY month))::BIGINT AS t FROM m)
SELECT category, product_id, month, revenue, {pct('revenue', 'c')} AS category_share_pct, {pct('revenue', 't')} AS total_share_pct, prev_period_revenue,
       {pct('(revenue - prev_period_revenue)', 'prev_period_revenue')} AS pop_pct FROM p""")
def kpi03_product_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.in_order("kpi03", kpis.product_revenue(star(spark, sf_dir)))


@query(f"""WITH {STAR_SQL}, l AS (SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY txn_ts DESC, transaction_id DESC, product_id DESC) AS rn FROM ok)
SELECT c.customer_id, c.account_id, l.txn_ts AS last_txn_ts, p.product_type,
       CASE WHEN p.product_type IN ('Credit Card', 'Loan') THEN 'High-Risk Dormant' ELSE 'Dormant' END AS dormant_flag
FROM dim_customer c LEFT JOIN l ON l.account_id = c.account_id AND rn = 1 LEFT JOIN dim_product p ON p.product_id = l.product_id
WHERE c.is_current AND (l.txn_ts IS NULL OR l.txn_ts < TIMESTAMP '{AS_OF}' - INTERVAL 90 DAY)""")
def kpi04_dormant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.in_order("kpi04", kpis.dormant_accounts(star(spark, sf_dir), AS_OF))


def event_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as transactions: they have times of day."""
    e = read(spark, sf_dir, "events")
    return e.select(
        F.concat(F.lit("E"), "event_id").alias("transaction_id"), F.concat(F.lit("A"), "user_id").alias("account_id"), F.concat(F.lit("B"), F.col("user_id") % 7).alias("branch_id"),
        F.col("ts").alias("txn_ts"), (cents("value") * 10).alias("amount"), F.upper("event_type").alias("status"), F.when(F.col("event_id") % 9 == 0, "USD").otherwise("INR").alias("currency"),
    )


EVENT_SQL = """ev AS (SELECT 'E' || event_id AS transaction_id, 'A' || user_id AS account_id, 'B' || (user_id % 7) AS branch_id, ts AS txn_ts,
  round(value * 100)::BIGINT * 10 AS amount, upper(event_type) AS status, CASE WHEN event_id % 9 = 0 THEN 'USD' ELSE 'INR' END AS currency FROM events)"""


@query(f"""WITH {EVENT_SQL}, s AS (SELECT *, count(*) OVER (PARTITION BY account_id ORDER BY txn_ts RANGE BETWEEN INTERVAL 10 MINUTE PRECEDING AND CURRENT ROW) AS txns_last_10m
  FROM ev WHERE currency = 'INR')
SELECT transaction_id, account_id, branch_id, txn_ts, amount, status, txns_last_10m,
  concat_ws('; ', CASE WHEN amount > 100000 THEN 'HIGH_VALUE' END, CASE WHEN txns_last_10m >= 3 THEN 'VELOCITY_3_IN_10M' END, CASE WHEN hour(txn_ts) < 5 THEN 'NIGHT_00_05' END) AS risk_reason
FROM s WHERE amount > 100000 OR txns_last_10m >= 3 OR hour(txn_ts) < 5""")
def kpi05_suspicious(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.in_order("kpi05", kpis.suspicious(event_facts(spark, sf_dir)))


RFM_SQL = f"""rfm AS (SELECT account_id, date_diff('day', max(txn_ts), TIMESTAMP '{AS_OF}') AS recency_days, count(*) AS frequency, sum(signed)::BIGINT AS monetary FROM ok GROUP BY 1),
pr AS (SELECT *, percent_rank() OVER (ORDER BY recency_days DESC) AS r, percent_rank() OVER (ORDER BY frequency) AS f, percent_rank() OVER (ORDER BY monetary) AS m FROM rfm),
sc AS (SELECT *, {' + '.join(f"(CASE WHEN {c} < 1.0::DOUBLE / 3 THEN 1 WHEN {c} < 2.0::DOUBLE / 3 THEN 2 ELSE 3 END)" for c in 'rfm')} AS rfm_score FROM pr)"""


@query(f"""WITH {STAR_SQL}, {RFM_SQL}
SELECT c.customer_id, sc.account_id, recency_days, frequency, monetary, rfm_score,
  CASE WHEN rfm_score >= 8 THEN 'Platinum' WHEN rfm_score >= 6 THEN 'Gold' WHEN rfm_score = 5 THEN 'Silver' ELSE 'Bronze' END AS segment
FROM sc LEFT JOIN dim_customer c ON c.account_id = sc.account_id AND c.is_current""")
def kpi06_rfm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.in_order("kpi06", kpis.rfm_segments(star(spark, sf_dir), AS_OF))


BRANCH_RANK_SQL = f"""WITH {STAR_SQL}, n AS (SELECT region, ok.branch_id, branch_name, sum(signed)::BIGINT AS net_volume, count(*) AS txn_count
  FROM ok JOIN dim_branch b ON b.branch_id = ok.branch_id GROUP BY ALL),
r AS (SELECT *, rank() OVER (PARTITION BY region ORDER BY net_volume DESC)::INTEGER AS rnk, dense_rank() OVER (PARTITION BY region ORDER BY net_volume DESC)::INTEGER AS dense_rnk,
             rank() OVER (PARTITION BY region ORDER BY net_volume) AS up FROM n)"""


@query(f"""{BRANCH_RANK_SQL}
SELECT region, branch_id, branch_name, net_volume, txn_count, rnk, dense_rnk, CASE WHEN rnk = 1 THEN 'TOP' WHEN up = 1 THEN 'BOTTOM' END AS performer_flag FROM r""")
def kpi07_branch_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.in_order("kpi07", kpis.branch_rank(star(spark, sf_dir)))


@query(f"""WITH {STAR_SQL}, g AS (SELECT coalesce(kyc_status, 'UNKNOWN') AS kyc_status, count(*) AS txn_count, sum(amount)::BIGINT AS total_value
  FROM ok LEFT JOIN dim_customer c ON c.customer_sk = ok.customer_sk GROUP BY 1),
t AS (SELECT *, (sum(txn_count) OVER ())::BIGINT AS n, (sum(total_value) OVER ())::BIGINT AS v FROM g)
SELECT kyc_status, kyc_status <> 'Verified' AS is_not_verified, txn_count, total_value, {pct('txn_count', 'n')} AS pct_count, {pct('total_value', 'v')} AS pct_value FROM t""")
def kpi08_kyc_exposure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.in_order("kpi08", kpis.kyc_exposure(star(spark, sf_dir)))


@query(f"""WITH {STAR_SQL}, g AS (SELECT p.product_id, product_name, branch_id, count(*) AS total_count, count(*) FILTER (is_refund) AS refund_count,
  sum(amount)::BIGINT AS total_value, coalesce(sum(amount) FILTER (is_refund), 0)::BIGINT AS refund_value
  FROM ok LEFT JOIN dim_product p ON p.product_id = ok.product_id GROUP BY ALL)
SELECT product_id, product_name, branch_id, total_count, refund_count, {pct('refund_count', 'total_count')} AS refund_count_pct, total_value, refund_value,
  {pct('refund_value', 'total_value')} AS refund_value_pct FROM g""")
def kpi09_refund_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.in_order("kpi09", kpis.refund_rate(star(spark, sf_dir)))


# Rows of line items that fail a check, by the first that they fail.
def checked_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items under three ordered rules and two flags."""
    rows = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_returnflag")
    rules = [
        Rule("LI-QTY", "SMALL_QUANTITY", "quantity below 3", F.col("l_quantity") < 3),
        Rule("LI-DISC", "HIGH_DISCOUNT", "discount of 9 % or more", F.col("l_discount") >= 0.09),
        Rule("LI-TAX", "HIGH_TAX", "tax of 8 % or more", F.col("l_tax") >= 0.08),
    ]
    flags = [Flag("RETURNED", F.col("l_returnflag") == "R"), Flag("LARGE", F.col("l_quantity") > 40)]
    return annotate(rows, rules, flags)


CHECK_SQL = """ck AS (SELECT *, CASE WHEN l_quantity < 3 THEN 'SMALL_QUANTITY' WHEN l_discount >= 0.09 THEN 'HIGH_DISCOUNT' WHEN l_tax >= 0.08 THEN 'HIGH_TAX' END AS error_code,
  CASE WHEN l_quantity < 3 THEN 'LI-QTY' WHEN l_discount >= 0.09 THEN 'LI-DISC' WHEN l_tax >= 0.08 THEN 'LI-TAX' END AS rule_id, l_orderkey % 2 AS b FROM lineitem),
top AS (SELECT 'batch' || b AS batch_id, error_code, count(*) AS n FROM ck WHERE error_code IS NOT NULL GROUP BY ALL),
tr AS (SELECT batch_id, string_agg(error_code || '=' || n, '; ' ORDER BY n DESC, error_code) AS top_reasons
  FROM (SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY n DESC, error_code) AS r FROM top) WHERE r <= 3 GROUP BY 1),
sc AS (SELECT 'batch' || b AS batch_id, 'lineitem.parquet' AS source_file, 'lineitem' AS entity, count(*) AS received, count(*) FILTER (error_code IS NULL) AS passed,
  count(error_code) AS rejected FROM ck GROUP BY b)"""


def line_scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = checked_lines(spark, sf_dir).withColumns({"batch_id": F.concat(F.lit("batch"), F.col("l_orderkey") % 2), "entity": F.lit("lineitem")})
    received = rows.groupBy("batch_id", "entity").agg(F.lit("lineitem.parquet").alias("source_file"), F.count("*").alias("received"))
    rejects = rows.filter("first_error IS NOT NULL").select("batch_id", "entity", "first_error.error_code")
    return quality.scorecard(received, rejects)


@query(f"WITH {CHECK_SQL} SELECT sc.batch_id, entity, source_file, received, passed, rejected, {pct('rejected', 'received')} AS reject_pct, top_reasons FROM sc JOIN tr USING (batch_id)")
def kpi10_scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.in_order("kpi10", kpis.scorecard_rates(line_scorecard(spark, sf_dir)))


def batch_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KPI 1 and 7 after the first batch and after both, from one pass over the facts."""
    s = star(spark, sf_dir)
    return kpis.snapshots(s.fact, s.branch, {BASELINE: F.col("first_batch_id") == BASELINE, INCREMENTAL: F.lit(True)})


SNAP_SQL = "snap AS (" + " UNION ALL ".join(
    f"""SELECT '{b}' AS batch_id, 'kpi_01_top5_net' AS kpi, sum(net)::DOUBLE AS total FROM (SELECT account_id, sum(signed) AS net, count(*) AS c FROM ok WHERE {w} GROUP BY 1 ORDER BY net DESC, c DESC, account_id LIMIT 5)
  UNION ALL SELECT '{b}', 'kpi_07_branch_net', sum(signed)::DOUBLE FROM ok WHERE {w}"""
    for b, w in ((BASELINE, f"first_batch_id = '{BASELINE}'"), (INCREMENTAL, "true"))
) + """), delta AS (SELECT *, total - lag(total) OVER (PARTITION BY kpi ORDER BY batch_id) AS delta FROM snap)"""


@query(f"WITH {STAR_SQL}, {SNAP_SQL} SELECT batch_id, kpi, total, delta FROM delta")
def snapshot_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.snapshot_deltas(batch_snapshots(spark, sf_dir))


@query(f"""WITH {STAR_SQL}, {SNAP_SQL}, ch AS (
  SELECT '{BASELINE}' AS batch_id, count(*) FILTER (first_batch_id = '{BASELINE}') AS new_txns, 0::BIGINT AS customers_new, 0::BIGINT AS customers_changed FROM fact
  UNION ALL SELECT '{INCREMENTAL}', count(*) FILTER (first_batch_id = '{INCREMENTAL}'), (SELECT count(*) FROM cust WHERE late), (SELECT count(*) FROM cust WHERE moved) FROM fact)
SELECT ch.batch_id, new_txns, 0::BIGINT AS updated_txns, 0::BIGINT AS corrected_txns, customers_new, customers_changed, 0::BIGINT AS products_changed, 0::BIGINT AS branches_changed,
  a.total AS kpi01_top5_net, a.delta AS kpi01_delta, b.total AS kpi07_network_net, b.delta AS kpi07_delta
FROM ch JOIN delta a ON a.batch_id = ch.batch_id AND a.kpi = 'kpi_01_top5_net' JOIN delta b ON b.batch_id = ch.batch_id AND b.kpi = 'kpi_07_branch_net'""")
def kpi11_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = star(spark, sf_dir)
    new = s.fact.groupBy(F.col("first_batch_id").alias("batch_id")).agg(F.count("*").alias("fact_inserted"))
    first = s.customer.groupBy("customer_id").agg(F.min("valid_from").alias("since"), F.count("*").alias("n"))
    at = F.lit(CUTOFF).cast("timestamp_ntz")
    moved = first.agg(F.count_if(F.col("since") == at).alias("customers_new"), F.count_if(F.col("n") > 1).alias("customers_changed")).withColumn("batch_id", F.lit(INCREMENTAL))
    zero = F.lit(0).cast("bigint")
    changes = new.join(moved, "batch_id", "left").select(
        "batch_id", "fact_inserted", zero.alias("fact_updated"), zero.alias("fact_corrected"), F.coalesce("customers_new", zero).alias("customers_new"),
        F.coalesce("customers_changed", zero).alias("customers_changed"), zero.alias("products_changed"), zero.alias("branches_changed"),
    )
    return kpis.in_order("kpi11", kpis.reconciliation(changes, batch_snapshots(spark, sf_dir)))


@query(f"""WITH {CUSTOMER_SQL} SELECT customer_id, customer_name, st AS from_status, CASE st WHEN 'Verified' THEN 'Pending' ELSE 'Verified' END AS to_status, TIMESTAMP '{CUTOFF}' AS changed_on
FROM cust WHERE moved""")
def kpi12_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.in_order("kpi12", kpis.kyc_transitions(sample.customers(spark, sf_dir)))


@query(f"""WITH {STAR_SQL}
SELECT 'FIRST_TXN_DAY2' AS activation_type, account_id, NULL::VARCHAR AS customer_id
FROM (SELECT DISTINCT account_id FROM fact WHERE first_batch_id = '{INCREMENTAL}') WHERE account_id NOT IN (SELECT account_id FROM fact WHERE first_batch_id = '{BASELINE}')
UNION ALL SELECT 'ONBOARDED_NO_TXN_DAY2', account_id, customer_id FROM cust WHERE late AND account_id NOT IN (SELECT account_id FROM fact)""")
def kpi13_activation(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = star(spark, sf_dir)
    return kpis.in_order("kpi13", kpis.activation(s.fact, s.customer, BASELINE, INCREMENTAL, CUTOFF))


# ---------------------------------------------------------------- rules and normalisers


@query(f"WITH {CHECK_SQL} SELECT l_orderkey, l_linenumber, rule_id, error_code FROM ck WHERE error_code IS NOT NULL")
def rule_reject_first_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checked_lines(spark, sf_dir).filter("first_error IS NOT NULL").select("l_orderkey", "l_linenumber", "first_error.rule_id", "first_error.error_code")


@query("""SELECT l_orderkey, l_linenumber, concat_ws(';', CASE WHEN l_returnflag = 'R' THEN 'RETURNED' END, CASE WHEN l_quantity > 40 THEN 'LARGE' END) AS dq_flags
FROM lineitem WHERE NOT (l_quantity < 3 OR l_discount >= 0.09 OR l_tax >= 0.08)""")
def flag_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checked_lines(spark, sf_dir).filter("first_error IS NULL").select("l_orderkey", "l_linenumber", "dq_flags")


def _by(key: str, n: int, *choices: Column) -> Column:
    """The choice whose number is key modulo n; the last for the others."""
    out = choices[-1]
    for i, c in reversed(list(enumerate(choices[:-1]))):
        out = F.when(F.col(key) % n == i, c).otherwise(out)
    return out


DIGITS_SQL = "lpad((c_custkey * 7919 % 10000000000)::VARCHAR, 10, '0')"


@query(f"""WITH d AS (SELECT c_custkey, {DIGITS_SQL} AS n FROM customer)
SELECT c_custkey, CASE WHEN c_custkey % 6 IN (0, 1, 2, 3) THEN '+91-' || n END AS phone FROM d""")
def norm_phone(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.lpad((F.col("c_custkey") * 7919 % 10000000000).cast("string"), 10, "0")
    raw = _by("c_custkey", 6, F.concat(F.lit("+91-"), n), F.concat(F.lit(" +91 "), F.substring(n, 1, 5), F.lit(" "), F.substring(n, 6, 5)), n, F.concat(F.lit("91"), n), F.substring(n, 1, 9), F.lit(None).cast("string"))
    return read(spark, sf_dir, "customer").select("c_custkey", text.phone(raw).alias("phone"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 5 IN (0, 1, 2) THEN 'user' || c_custkey || '@example.com' END AS email FROM customer""")
def norm_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    raw = _by("c_custkey", 5, F.concat(F.lit("User"), k, F.lit("@Example.com")), F.concat(F.lit(" user"), k, F.lit("@@example.com ")), F.concat(F.lit("user"), k, F.lit("@example.com")), F.concat(F.lit("user"), k, F.lit("@example")), F.lit("none"))
    return read(spark, sf_dir, "customer").select("c_custkey", text.email(raw).alias("email"))


@query("""WITH o AS (SELECT o_orderkey, o_orderdate::DATE AS d, o_orderkey % 4 AS k FROM orders),
f AS (SELECT *, try_strptime(strftime(d, '%m/%d/%Y'), '%d/%m/%Y')::DATE AS dmy FROM o)
SELECT o_orderkey, CASE WHEN k IN (0, 1) THEN d::VARCHAR
  WHEN k = 2 THEN CASE WHEN day(d) > 12 OR day(d) = month(d) THEN d::VARCHAR ELSE d::VARCHAR || ',' || strftime(d, '%Y-%d-%m') END
  ELSE '' END AS readings FROM f""")
def date_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("o_orderdate")
    raw = _by("o_orderkey", 4, F.date_format(d, "yyyy-MM-dd"), F.date_format(d, "yyyy/M/d"), F.date_format(d, "dd/MM/yyyy"), F.lit("31-02-2001"))
    return read(spark, sf_dir, "orders").select("o_orderkey", F.array_join(F.transform(dates.candidates(raw), lambda x: x.cast("string")), ",").alias("readings"))


@query("""SELECT l_orderkey, l_linenumber, round(l_extendedprice * 100)::BIGINT AS cents,
  CASE l_linenumber % 4 WHEN 3 THEN NULL ELSE floor(l_extendedprice)::BIGINT END AS amount FROM lineitem""")
def amount_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = F.floor("l_extendedprice")
    plain = whole.cast("string")
    raw = _by("l_linenumber", 4, plain, F.format_number(whole, 0), F.concat(F.lit("Rs."), F.format_number(whole, 0), F.lit(".9")), F.concat(F.lit("₹"), plain))
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", cents("l_extendedprice").alias("cents"), numbers.whole(numbers.number(raw)).alias("amount"))


@query("SELECT event_id, CASE WHEN event_id % 7 IN (0, 1, 2) THEN true WHEN event_id % 7 IN (3, 4, 5) THEN false END AS value FROM events")
def bool_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _by("event_id", 7, *[F.lit(x) for x in ("True", " y", "1", "FALSE", "no ", "0", "maybe")])
    return read(spark, sf_dir, "events").select("event_id", text.boolean(raw).alias("value"))


@query("SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') THEN upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2)) END AS segment FROM customer")
def title_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").select("c_custkey", text.canonical(F.concat(F.lit(" "), "c_mktsegment"), ("Building", "Furniture")).alias("segment"))


@query("""SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'SUCCESS' WHEN 1 THEN 'SUCCESS' WHEN 2 THEN 'FAILED' WHEN 3 THEN 'FAILED' WHEN 4 THEN 'PENDING' END AS status FROM orders""")
def status_close_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _by("o_orderkey", 6, *[F.lit(x) for x in ("Success", "Succes", "Faild", "FAIL", "pending", "PEND")])
    rows = read(spark, sf_dir, "orders").select("o_orderkey", raw.alias("raw"))
    return fuzzy.close_match(rows, "raw", list(entities.STATUSES), "status").select("o_orderkey", "status")


@query("""SELECT c_custkey, sha256(concat(c_name, '|', CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment END, '|', c_custkey, '|', CASE WHEN c_custkey % 2 = 0 THEN 'True' ELSE 'False' END)) AS row_hash FROM customer""")
def row_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer")
    c = c.withColumns({"seg": F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")), "even": F.col("c_custkey") % 2 == 0})
    return c.select("c_custkey", text.row_hash([(F.col(n), c.schema[n].dataType) for n in ("c_name", "seg", "c_custkey", "even")]).alias("row_hash"))


# ---------------------------------------------------------------- copies, accounts, references


def line_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items under their natural key, which repeats, cut to few values so that all kinds of copies occur."""
    rows = read(spark, sf_dir, "lineitem")
    key = F.concat_ws("-", F.col("l_orderkey"), F.col("l_linenumber"))
    order = (F.col("l_partkey") * 1_000_000 + F.round(F.col("l_extendedprice") * 100)).cast("bigint")
    return rows.select(
        key.alias("id"), order.alias("_src_row"), (F.col("l_partkey") % 3).cast("string").alias("a"), F.when(F.col("l_quantity") > 25, F.col("l_returnflag")).alias("b"),
        F.when(F.col("l_tax") > 0.04, "TAXED").otherwise("").alias("dq_flags"),
    )


COPY_SQL = """cp AS (SELECT l_orderkey || '-' || l_linenumber AS id, (l_partkey * 1000000 + round(l_extendedprice * 100))::BIGINT AS src, (l_partkey % 3)::VARCHAR AS a,
  CASE WHEN l_quantity > 25 THEN l_returnflag END AS b, (l_tax > 0.04)::INTEGER AS f FROM lineitem),
c1 AS (SELECT *, row_number() OVER (PARTITION BY id, a, b ORDER BY src) > 1 AS copy, count(DISTINCT a) OVER (PARTITION BY id) > 1 OR count(DISTINCT b) OVER (PARTITION BY id) > 1 AS conflict FROM cp),
c2 AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY copy, f, src) AS r FROM c1)"""


@query(f"WITH {COPY_SQL} SELECT id, src AS src_row FROM c2 WHERE copy")
def dedup_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dedup.dedupe_errors(line_copies(spark, sf_dir), "id", ["a", "b"], "LI")
    return rows.filter("dup_error.error_detail = 'a copy of an earlier row'").select("id", F.col("_src_row").alias("src_row"))


@query(f"WITH {COPY_SQL} SELECT id, src AS src_row FROM c2 WHERE NOT copy AND conflict")
def dedup_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dedup.dedupe_errors(line_copies(spark, sf_dir), "id", ["a", "b"], "LI")
    return rows.filter("dup_error.error_code = 'CONFLICTING_DUPLICATE'").select("id", F.col("_src_row").alias("src_row"))


@query(f"WITH {COPY_SQL} SELECT id, src AS src_row, f::BOOLEAN AS flagged FROM c2 WHERE NOT copy AND NOT conflict AND r = 1")
def dedup_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dedup.dedupe_errors(line_copies(spark, sf_dir), "id", ["a", "b"], "LI")
    return rows.filter("dup_error IS NULL").select("id", F.col("_src_row").alias("src_row"), (F.col("dq_flags") != "").alias("flagged"))


@query("""WITH c AS (SELECT c_custkey AS k, 'A' || (c_custkey - c_custkey % 3) AS account_id FROM customer), w AS (SELECT *, count(*) OVER (PARTITION BY account_id) AS n FROM c)
SELECT 'C' || k AS customer_id, account_id FROM w WHERE n > 1 AND 'A' || k <> account_id""")
def account_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    rows = read(spark, sf_dir, "customer").select(F.concat(F.lit("C"), k).alias("customer_id"), F.concat(F.lit("A"), k - k % 3).alias("account_id"), k.alias("_src_row"), F.lit(None).cast("struct<rule_id:string,error_code:string,error_detail:string>").alias("first_error"))
    return entities.shared_accounts(rows).filter("first_error IS NOT NULL").select("customer_id", "account_id")


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10)")
def ri_missing_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = read(spark, sf_dir, "part").filter("p_size > 10").select(F.col("p_partkey").alias("l_partkey"))
    return pit.missing(read(spark, sf_dir, "lineitem"), dim, "l_partkey", "l_partkey").select("l_orderkey", "l_linenumber", "l_partkey")


@query("SELECT l_suppkey, count(*) AS n FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 10) GROUP BY 1")
def semi_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = read(spark, sf_dir, "part").filter("p_size > 10").select(F.col("p_partkey").alias("l_partkey"))
    return pit.known(read(spark, sf_dir, "lineitem"), dim, "l_partkey", "l_partkey").groupBy("l_suppkey").agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- the four cleansing chains


@query(cleansing_samples.CUSTOMERS_SQL)
def cleanse_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleansing_samples.customers(read(spark, sf_dir, "customer"))


@query(cleansing_samples.BRANCHES_SQL)
def cleanse_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleansing_samples.branches(read(spark, sf_dir, "supplier"))


@query(cleansing_samples.PRODUCTS_SQL)
def cleanse_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleansing_samples.products(read(spark, sf_dir, "part"))


@query(cleansing_samples.TRANSACTIONS_SQL)
def cleanse_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleansing_samples.transactions(read(spark, sf_dir, "orders"), read(spark, sf_dir, "customer"), read(spark, sf_dir, "part"), read(spark, sf_dir, "supplier"))


# ---------------------------------------------------------------- dimensions and facts


def customer_dim(spark: SparkSession, sf_dir: str, changed: bool = False) -> DataFrame:
    """The first delivery (keys not divisible by 13), or the second (all that changed, are new, or come again unchanged)."""
    c = read(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    status = sample.kyc(F.col("c_mktsegment"))
    if changed:
        c = c.filter((k % 13 == 0) | (k % 5 == 0) | (k % 7 == 0))
        status = F.when((k % 5 == 0) & (k % 13 != 0), F.when(status == "Verified", "Pending").otherwise("Verified")).otherwise(status)
    else:
        c = c.filter(k % 13 != 0)
    rows = c.select(F.concat(F.lit("C"), k).alias("customer_id"), F.col("c_name").alias("customer_name"), status.alias("kyc_status"), k.alias("_order"))
    return scd2.with_hash(rows, ["customer_name", "kyc_status"])


STATUS_SQL = "CASE c_mktsegment WHEN 'FURNITURE' THEN 'Pending' WHEN 'HOUSEHOLD' THEN 'Rejected' ELSE 'Verified' END"
BASE_SQL = f"""base AS (SELECT c_custkey AS k, 'C' || c_custkey AS customer_id, c_name AS customer_name, {STATUS_SQL} AS kyc_status,
  row_number() OVER (ORDER BY c_custkey) AS customer_sk FROM customer WHERE c_custkey % 13 <> 0)"""
MERGE_SQL = f"""{BASE_SQL}, inc AS (SELECT c_custkey AS k, 'C' || c_custkey AS customer_id, c_name AS customer_name, c_custkey % 5 = 0 AND c_custkey % 13 <> 0 AS moved, {STATUS_SQL} AS st
  FROM customer WHERE c_custkey % 13 = 0 OR c_custkey % 5 = 0 OR c_custkey % 7 = 0),
fresh AS (SELECT customer_id, customer_name, CASE WHEN moved THEN CASE st WHEN 'Verified' THEN 'Pending' ELSE 'Verified' END ELSE st END AS kyc_status,
  (SELECT count(*) FROM base) + row_number() OVER (ORDER BY k) AS customer_sk FROM inc WHERE moved OR k % 13 = 0),
merged AS (SELECT customer_id, customer_name, kyc_status, customer_sk, TIMESTAMP '1900-01-01' AS valid_from,
    CASE WHEN k % 5 = 0 THEN TIMESTAMP '{CUTOFF}' ELSE TIMESTAMP '9999-12-31' END AS valid_to, k % 5 <> 0 AS is_current FROM base
  UNION ALL SELECT *, TIMESTAMP '{CUTOFF}', TIMESTAMP '9999-12-31', true FROM fresh)"""


def shown(dim: DataFrame) -> DataFrame:
    """A dimension with its validity as text: the end of time is beyond what some clients can hold."""
    return dim.select("customer_id", "customer_name", "kyc_status", "customer_sk", *[F.date_format(c, "yyyy-MM-dd").alias(c) for c in ("valid_from", "valid_to")], "is_current")


AT = datetime.fromisoformat(CUTOFF)


@query(f"WITH {BASE_SQL} SELECT customer_id, customer_name, kyc_status, customer_sk, '1900-01-01' AS valid_from, '9999-12-31' AS valid_to, true AS is_current FROM base")
def scd2_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(scd2.baseline(customer_dim(spark, sf_dir), "customer_sk", "_order"))


def merged_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = scd2.baseline(customer_dim(spark, sf_dir), "customer_sk", "_order")
    return scd2.merge(first, customer_dim(spark, sf_dir, True), "customer_id", "customer_sk", "_order", AT)


@query(f"WITH {MERGE_SQL} SELECT * REPLACE (strftime(valid_from, '%Y-%m-%d') AS valid_from, strftime(valid_to, '%Y-%m-%d') AS valid_to) FROM merged")
def scd2_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(merged_dim(spark, sf_dir))


@query(f"WITH {MERGE_SQL} SELECT CASE WHEN k % 13 = 0 THEN 'new' WHEN moved THEN 'changed' ELSE 'unchanged' END AS change, count(*) AS n FROM inc GROUP BY 1")
def scd2_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.change_counts(scd2.baseline(customer_dim(spark, sf_dir), "customer_sk", "_order"), customer_dim(spark, sf_dir, True), "customer_id")


@query(f"""WITH {MERGE_SQL}, m AS (SELECT o_orderkey, customer_sk, row_number() OVER (PARTITION BY o_orderkey
    ORDER BY coalesce((o_orderdate >= valid_from AND o_orderdate < valid_to)::INTEGER, 0) * 2 + is_current::INTEGER DESC NULLS LAST) AS r
  FROM orders LEFT JOIN merged ON customer_id = 'C' || o_custkey)
SELECT o_orderkey, customer_sk FROM m WHERE r = 1""")
def pit_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("C"), "o_custkey").alias("customer_id"), "o_orderdate")
    return pit.resolve_sk(orders, merged_dim(spark, sf_dir), "customer_id", "customer_id", "customer_sk", "o_orderdate").select("o_orderkey", "customer_sk")


def order_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders as a fact table and a second delivery: new keys, corrected prices, and repeats without change."""
    o = read(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    columns = [k, cents("o_totalprice").alias("amount"), F.col("o_orderpriority").alias("priority"), (k % 20 == 0).alias("is_correction")]
    old = o.filter(k % 4 != 0).select(*columns).withColumns({"is_correction": F.lit(False), "loaded_batch_id": F.lit("b1"), "first_batch_id": F.lit("b1")})
    new = o.filter((k % 4 == 0) | (k % 5 == 0)).select(*columns)
    return old, new.withColumn("amount", F.when(k % 10 == 5, F.col("amount") + 1).otherwise(F.col("amount"))).withColumn("is_correction", k % 15 == 0)


ORDER_SQL = """inc AS (SELECT o_orderkey, round(o_totalprice * 100)::BIGINT + CASE WHEN o_orderkey % 10 = 5 THEN 1 ELSE 0 END AS amount, o_orderpriority AS priority,
    o_orderkey % 15 = 0 AS is_correction, o_orderkey % 4 <> 0 AS known FROM orders WHERE o_orderkey % 4 = 0 OR o_orderkey % 5 = 0)"""


@query(f"""WITH {ORDER_SQL} SELECT o_orderkey, amount, priority, is_correction, 'b2' AS loaded_batch_id, CASE WHEN known THEN 'b1' ELSE 'b2' END AS first_batch_id FROM inc
UNION ALL SELECT o_orderkey, round(o_totalprice * 100)::BIGINT, o_orderpriority, false, 'b1', 'b1' FROM orders WHERE o_orderkey % 4 <> 0 AND o_orderkey % 5 <> 0""")
def fact_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = order_batches(spark, sf_dir)
    return facts.upsert(old, new, "o_orderkey", "b2")


@query(f"WITH {ORDER_SQL} SELECT count(*) FILTER (NOT known) AS inserted, count(*) FILTER (known AND o_orderkey % 10 = 5) AS updated, count(*) FILTER (known AND is_correction) AS corrected FROM inc")
def fact_change_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = order_batches(spark, sf_dir)
    return facts.summary(old, new, "o_orderkey", ["amount", "priority"])


# ---------------------------------------------------------------- batch quality


@query(f"WITH {CHECK_SQL} SELECT batch_id AS entity, received AS raw, passed AS clean, rejected, received = passed + rejected AS balanced FROM sc")
def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = checked_lines(spark, sf_dir).groupBy(F.concat(F.lit("batch"), F.col("l_orderkey") % 2).alias("entity"))
    counts = rows.agg(F.count("*").alias("raw"), F.count_if(F.col("first_error").isNull()).alias("clean"), F.count_if(F.col("first_error").isNotNull()).alias("rejected"))
    return quality.reconcile(counts)


@query(f"WITH {CHECK_SQL} SELECT batch_id AS entity, received, rejected AS dq_rejected, rejected / received AS rate, rejected / received > 0.25 AS over_limit FROM sc")
def quarantine_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = checked_lines(spark, sf_dir).withColumn("entity", F.concat(F.lit("batch"), F.col("l_orderkey") % 2))
    return quality.quarantine_rate(rows.filter("first_error IS NOT NULL").select("entity", "first_error.error_code"), rows.groupBy("entity").agg(F.count("*").alias("received")))


@query(f"WITH {CHECK_SQL} SELECT sc.batch_id, source_file, entity, received, passed, rejected, top_reasons FROM sc JOIN tr USING (batch_id)")
def scorecard_top_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_scorecard(spark, sf_dir)


# ---------------------------------------------------------------- windows, sets, limits


@query("SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 10 MINUTE PRECEDING AND CURRENT ROW) AS n FROM events")
def range_velocity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.with_recent_count(read(spark, sf_dir, "events").select("event_id", "user_id", "ts"), "user_id", "ts", "n").select("event_id", "n")


@query(f"""WITH {STAR_SQL}, {RFM_SQL} SELECT account_id, CASE WHEN m < 1.0::DOUBLE / 3 THEN 1 WHEN m < 2.0::DOUBLE / 3 THEN 2 ELSE 3 END AS tertile FROM pr""")
def percent_rank_tertile(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = kpis.successes(sample.raw_facts(spark, sf_dir)).groupBy("account_id").agg(kpis.net().alias("monetary"))
    rows = rows.withColumnRenamed("monetary", "value")
    return rows.join(kpis.tertiles(rows, []), "value").select("account_id", "tertile")


@query("""SELECT s_suppkey, (rank() OVER w)::INTEGER AS rnk, (dense_rank() OVER w)::INTEGER AS dense_rnk FROM supplier
WINDOW w AS (PARTITION BY s_nationkey ORDER BY floor(s_acctbal / 1000) DESC)""")
def rank_dense_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("s_nationkey").orderBy(F.desc(F.floor(F.col("s_acctbal") / 1000)))
    return read(spark, sf_dir, "supplier").select("s_suppkey", F.rank().over(w).alias("rnk"), F.dense_rank().over(w).alias("dense_rnk"))


@query(f"""WITH m AS (SELECT o_orderpriority AS priority, date_trunc('month', o_orderdate)::TIMESTAMP AS month, sum(round(o_totalprice * 100)::BIGINT)::BIGINT AS volume FROM orders GROUP BY ALL),
p AS (SELECT *, lag(volume) OVER (PARTITION BY priority ORDER BY month) AS before FROM m) SELECT priority, month, volume, before, {pct('(volume - before)', 'before')} AS change_pct FROM p""")
def lag_mom(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("priority"), kpis.month_of("o_orderdate").alias("month")).agg(F.sum(cents("o_totalprice")).alias("volume"))
    before = F.lag("volume").over(Window.partitionBy("priority").orderBy("month"))
    return rows.withColumns({"before": before, "change_pct": numbers.exact_pct(F.col("volume") - before, before)})


@query(f"""WITH g AS (SELECT o_orderpriority AS priority, count(*) AS n FROM orders GROUP BY 1), t AS (SELECT *, (sum(n) OVER ())::BIGINT AS total FROM g) SELECT priority, n, {pct('n', 'total')} AS share_pct FROM t""")
def share_of_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("priority")).agg(F.count("*").alias("n"))
    return rows.withColumn("share_pct", numbers.exact_pct(F.col("n"), F.sum("n").over(Window.partitionBy())))  # one row per priority


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def not_in_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = read(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return read(spark, sf_dir, "customer").join(done, "c_custkey", "left_anti").select("c_custkey")


@query("SELECT 'C' AS kind, c_custkey AS id FROM customer WHERE c_acctbal < 0 UNION ALL SELECT 'S', s_suppkey FROM supplier WHERE s_acctbal < 0")
def union_all_activation(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer").filter("c_acctbal < 0").select(F.lit("C").alias("kind"), F.col("c_custkey").alias("id"))
    return c.unionByName(read(spark, sf_dir, "supplier").filter("s_acctbal < 0").select(F.lit("S").alias("kind"), F.col("s_suppkey").alias("id")))


@query("SELECT DISTINCT user_id FROM events WHERE event_type = 'error'")
def distinct_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").filter("event_type = 'error'").select("user_id").distinct()


@query("SELECT o_custkey, max(o_orderkey) AS last_order FROM orders GROUP BY 1 HAVING min(o_orderdate) >= TIMESTAMP '1996-01-01'")
def having_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.max("o_orderkey").alias("last_order"), F.min("o_orderdate").alias("since"))
    return rows.filter("since >= TIMESTAMP_NTZ '1996-01-01'").drop("since")


@query("SELECT o_orderkey, round(o_totalprice * 100)::BIGINT AS cents FROM orders ORDER BY cents DESC, o_orderkey LIMIT 5")
def topk_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select("o_orderkey", cents("o_totalprice").alias("cents")).orderBy(F.desc("cents"), "o_orderkey").limit(5)
