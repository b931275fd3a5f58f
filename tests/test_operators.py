import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.functions import numbers
from tidemark.operators import dedup, facts, fuzzy, ids, pit, scd2
from tidemark.plans import entities, kpis, quality


def test_dedup_kinds(spark):
    rows = [
        ("k1", "a", "x", "", 1), ("k1", "a", "x", "", 2),  # exact
        ("k2", "a", None, "F1;F2", 3), ("k2", "a", "y", "F1", 4),  # near: fewer flags stay
        ("k3", "a", "x", "", 5), ("k3", "a", "x", "", 6), ("k3", "b", "x", "", 7),  # a copy, and a conflict
        ("k4", None, None, "", 8), ("k4", None, None, "", 9),  # nulls are equal
    ]
    df = spark.createDataFrame(rows, "id string, a string, b string, dq_flags string, _src_row long")
    got = {r._src_row: r.dup_error and r.dup_error.error_code for r in dedup.dedupe_errors(df, "id", ["a", "b"], "X").collect()}
    dup, conflict = "DUPLICATE_RECORD", "CONFLICTING_DUPLICATE"
    assert got == {1: None, 2: dup, 3: dup, 4: None, 5: conflict, 6: dup, 7: conflict, 8: None, 9: dup}
    assert dedup.dedupe_errors(df.limit(0), "id", ["a", "b"], "X").count() == 0


def test_dense_ids_across_blocks(spark):
    df = spark.range(5).select((F.col("id") * 70_000 + 3).alias("at"))
    assert [r.n for r in ids.dense_ids(df, "at", "n", 10).orderBy("at").collect()] == [11, 12, 13, 14, 15]


def test_scd2_and_pit(spark):
    cut = datetime(2026, 10, 2)
    base = scd2.with_hash(spark.createDataFrame([("a", "1", 1), ("b", "2", 2), ("c", None, 3)], "id string, v string, o long"), ["v"])
    dim = scd2.baseline(base, "sk", "o")
    inc = scd2.with_hash(spark.createDataFrame([("d", "9", 1), ("a", "x", 2), ("b", "2", 3)], "id string, v string, o long"), ["v"])
    assert {(r.change, r.n) for r in scd2.change_counts(dim, inc, "id").collect()} == {("new", 1), ("changed", 1), ("unchanged", 1)}
    merged = scd2.merge(dim, inc, "id", "sk", "o", cut)
    got = {(r.id, r.v, r.sk, r.is_current, str(r.valid_from)[:10], str(r.valid_to)[:10]) for r in merged.collect()}
    assert got == {
        ("a", "1", 1, False, "1900-01-01", "2026-10-02"), ("a", "x", 5, True, "2026-10-02", "9999-12-31"), ("b", "2", 2, True, "1900-01-01", "9999-12-31"),
        ("c", None, 3, True, "1900-01-01", "9999-12-31"), ("d", "9", 4, True, "2026-10-02", "9999-12-31"),
    }
    with pytest.raises(ValueError):
        scd2.merge(dim, inc, "id", "sk", "o", None)
    f = spark.createDataFrame([(1, "a", datetime(2026, 10, 1)), (2, "a", cut), (3, "d", datetime(2020, 1, 1)), (4, "z", cut), (5, "a", None)], "n int, id string, ts timestamp_ntz")
    assert {r.n: r.sk for r in pit.resolve_sk(f, merged, "id", "id", "sk", "ts").collect()} == {1: 1, 2: 5, 3: 4, 4: None, 5: 5}


def test_upsert(spark):
    old = spark.createDataFrame([(1, 5, False, "b1", "b1"), (2, 6, False, "b1", "b1")], "id int, v int, is_correction boolean, loaded_batch_id string, first_batch_id string")
    new = spark.createDataFrame([(2, 7, True), (3, None, False)], "id int, v int, is_correction boolean")
    got = {tuple(r) for r in facts.upsert(old, new, "id", "b2").collect()}
    assert got == {(1, 5, False, "b1", "b1"), (2, 7, True, "b2", "b1"), (3, None, False, "b2", "b2")}
    assert tuple(facts.summary(old, new, "id", ["v"]).first()) == (1, 1, 1)


def test_velocity_is_exact_to_the_microsecond(spark):
    times = ["2026-01-01 00:00:00", "2026-01-01 00:05:00", "2026-01-01 00:10:00", "2026-01-01 00:20:00.000500"]
    df = spark.createDataFrame([("a", t) for t in times], "k string, t string").select("k", F.col("t").cast("timestamp_ntz").alias("ts"))
    assert [r.n for r in kpis.with_recent_count(df, "k", "ts", "n").orderBy("ts").collect()] == [1, 2, 3, 1]


def test_velocity_counts_over_slots(spark):
    draw = random.Random(4)
    starts = [datetime(1969, 12, 31, 23, 0), datetime(9998, 1, 1)]
    times = [draw.choice(starts) + timedelta(microseconds=draw.choice([0, 1, 599_999_999, 600_000_000, draw.randrange(7_200_000_000)]) + 600_000_000 * draw.randrange(8)) for _ in range(400)]
    rows = [(i, draw.choice(["a", "a", "a", "b", None]), draw.choice([t, t, t, t, None])) for i, t in enumerate(times)]
    got = {r.i: r.n for r in kpis.with_recent_count(spark.createDataFrame(rows, "i int, k string, ts timestamp_ntz"), "k", "ts", "n").collect()}
    ten = timedelta(minutes=10)
    assert got == {i: sum(k2 == k and (t2 is None if t is None else t2 is not None and t - ten <= t2 <= t) for _, k2, t2 in rows) for i, k, t in rows}


def test_orders_and_nulls(spark):
    four = spark.createDataFrame([("D", None, "a2"), ("D", datetime(2020, 1, 1), "a1"), ("H", None, "a0")], "dormant_flag string, last_txn_ts timestamp_ntz, account_id string")
    assert [r.account_id for r in kpis.in_order("kpi04", four).collect()] == ["a2", "a1", "a0"]
    nine = spark.createDataFrame([(None, "p1", "b"), (5.0, "p2", "b"), (5.0, None, "b"), (7.0, "p3", "b")], "refund_value_pct double, product_id string, branch_id string")
    assert [r.product_id for r in kpis.in_order("kpi09", nine).collect()] == ["p3", "p2", None, "p1"]


def test_percentages_are_exact_for_large_numbers(spark):
    rows = [(10**15, 3), (-1, 3), (1, 0), (2**63 - 1, 2**63 - 1), (2**62, 2**63 - 1), (0, 5), (None, 1), (1, 40_000)]
    df = spark.createDataFrame(rows, "a long, b long")
    want = [None if not b or a is None else (1 if a * b >= 0 else -1) * float((2 * 10_000 * abs(a) + abs(b)) // (2 * abs(b))) / 100 for a, b in rows]
    assert [r[0] for r in df.select(numbers.exact_pct(F.col("a"), F.col("b"))).collect()] == want


def test_tertiles_equal_percent_ranks(spark):
    draw = random.Random(4)
    values = [draw.choice([draw.randrange(-(10**12), 10**12), draw.randrange(50), -(2**63), 2**63 - 1]) for _ in range(500)] + [7] * 60
    df = spark.createDataFrame([("k", v) for v in values] + [("one", 3)], "kind string, value long")
    got = {(r.kind, r.value): r.tertile for r in kpis.tertiles(df, ["kind"]).collect()}
    for v in set(values):
        p = sum(x < v for x in values) / (len(values) - 1)
        assert got["k", v] == (1 if p < 1 / 3 else 2 if p < 2 / 3 else 3)
    assert got["one", 3] == 1


def scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan")


def test_cleansing_reads_its_rows_once(spark, tmp_path):
    """One scan for the rows; the distinct odd values come from a job of their own, and each dimension is read once."""
    raw = spark.createDataFrame([(*GOOD, 2, "{}")], ", ".join(f"{c} string" for c in TX) + ", _src_row long, _raw string")
    raw.write.parquet(f"{tmp_path}/raw")
    spark.createDataFrame([("A1",)], "account_id string").write.parquet(f"{tmp_path}/dim")
    rows = entities.transactions(spark.read.parquet(f"{tmp_path}/raw"))
    assert scans(rows) == 1 and scans(entities.references(rows, [("TX-RI-ACCT", "account_id", spark.read.parquet(f"{tmp_path}/dim"))])) == 2
    c = spark.createDataFrame([(*["x"] * 10, 2, "{}")], ", ".join(f"{n} string" for n in entities.CUSTOMERS.raw) + ", _src_row long, _raw string")
    c.write.parquet(f"{tmp_path}/customers")
    assert scans(entities.customers(spark.read.parquet(f"{tmp_path}/customers"))) == 1


def test_many_odd_values_are_joined(spark, monkeypatch):
    df = spark.createDataFrame([(v,) for v in ("Succes", "success", "Faild", "zzz", None, "SUCC")], "status string")
    want = {("Succes", "SUCCESS"), ("success", "SUCCESS"), ("Faild", "FAILED"), ("zzz", None), (None, None), ("SUCC", None)}
    for most in (10, 1):
        monkeypatch.setattr(fuzzy, "LOCAL_VALUES", most)
        assert {tuple(r) for r in fuzzy.close_match(df, "status", ["SUCCESS", "FAILED"], "to").collect()} == want


def test_top_reasons_break_ties_by_rank(spark):
    df = spark.createDataFrame([("e", "B", 1), ("e", "A", 2), ("e", "C", 3), ("e", "C", 3), ("e", "D", 9)], "entity string, error_code string, rank int")
    assert quality.top_reasons(df, ["entity"], 3, F.col("rank")).first().top_reasons == "C=2; B=1; A=1"


TX = ("transaction_id", "account_id", "product_id", "branch_id", "date", "timestamp", "amount", "payment_method", "status", "currency", "remarks", "is_refund")
GOOD = ("t1", "a1", "p1", "b1", "2026-09-01", "2026-09-01 10:00:00", "1,234.9", "upi", "Succes", "", "fine", "N")


def with_value(**values):
    return tuple(values.get(n, v) for n, v in zip(TX, GOOD, strict=True))


def cleansed(spark, *rows):
    df = spark.createDataFrame([(*r, i, "{}") for i, r in enumerate(rows, 2)], ", ".join(f"{c} string" for c in TX) + ", _src_row long, _raw string")
    return {r._src_row: r for r in entities.transactions(df).collect()}


def test_transactions(spark):
    cases = {
        "TX-STRUCT": with_value(account_id=" "), "TX-AMT-BLANK": with_value(amount="abc"), "TX-AMT-ZERO": with_value(amount="0"), "TX-AMT-NEG": with_value(amount="-4"), "TX-TS": with_value(timestamp="2026-09-01"),
        "TX-FUT": with_value(timestamp="2026-10-07 00:00:00"), "TX-FUT-DATE": with_value(date="2027-01-01"), "TX-STATUS": with_value(status="SUCC"), "TX-PAY": with_value(payment_method="gold"),
    }
    got = cleansed(spark, *[(f"x{i}", *r[1:]) for i, r in enumerate(cases.values())])
    assert [got[i].first_error.rule_id for i in range(2, 2 + len(cases))] == list(cases)
    ok = cleansed(spark, GOOD, with_value(transaction_id="t2", date="09/01/2026", currency="usd", is_refund="?", remarks="[late correction]"), with_value(transaction_id="t3", date="2026-08-30"))
    assert all(r.first_error is None for r in ok.values())
    assert (ok[2].amount, ok[2].status, ok[2].payment_method, ok[2].currency, ok[2].is_refund, ok[2].dq_flags) == (1234, "SUCCESS", "UPI", "INR", False, "")
    assert ok[3].dq_flags == "DATE_AMBIGUOUS_RESOLVED_BY_TS;NON_INR_CURRENCY;IS_REFUND_DEFAULTED;LATE_CORRECTION" and ok[3].remarks is None and str(ok[3].transaction_date) == "2026-09-01"
    assert ok[4].dq_flags == "DATE_RECONCILED_TO_TIMESTAMP"


def test_customers_branches_products(spark):
    c = spark.createDataFrame([
        ("c1", "Ann", "A@@x.com", "9876543210", "a1", "m", "1990-01-01", "s", "verified", "2020-01-31", 2, "{}"), ("c2", "Bo", "", "1", "a2", "?", "", "s", "Pending", "03/04/2020", 3, "{}"),
        ("c3", "Cy", "", "", "a1", "", "1990-01-01", "s", "Pending", "2020-01-01", 4, "{}"), ("c4", "Di", "", "", "a4", "", "2015-01-01", "s", "Pending", "2020-01-01", 5, "{}"),
        ("c5", "Ed", "", "", "a5", "", "", "s", "no", "2020-01-01", 6, "{}"), ("", "Fi", "", "", "a6", "", "", "s", "Pending", "2020-01-01", 7, "{}"), ("c7", "Gy", "", "", "a7", "", "", "s", "Pending", "2030-01-01", 8, "{}"),
    ], ", ".join(f"{n} string" for n in entities.CUSTOMERS.raw) + ", _src_row long, _raw string")
    got = {r._src_row: r for r in entities.customers(c).collect()}
    assert {k: r.first_error and r.first_error.rule_id for k, r in got.items()} == {2: None, 3: None, 4: "CU-ACCT", 5: "CU-DOB", 6: "CU-KYC", 7: "CU-STRUCT", 8: "CU-REGDATE-FUT"}
    assert got[3].dq_flags == "EMAIL_MISSING;PHONE_INVALID;DOB_MISSING;REG_DATE_AMBIGUOUS_ASSUMED_DMY" and got[3].gender == "Unknown" and got[2].email == "a@x.com"
    b = spark.createDataFrame([("b1", "N", "l", "Jo (New)", "2020-01-01", "north", "urban", "1", 2, "{}"), ("b2", "N", "l", "", "2020-01-01", "mid", "urban", "", 3, "{}"), ("b3", "N", "l", "", "2030-01-01", "East", "Rural", "", 4, "{}")], ", ".join(f"{n} string" for n in entities.BRANCHES.raw) + ", _src_row long, _raw string")
    got = {r._src_row: r for r in entities.branches(b).collect()}
    assert {k: r.first_error and r.first_error.rule_id for k, r in got.items()} == {2: None, 3: "BR-REGION", 4: "BR-OPENED"}
    assert (got[2].manager_name, got[2].dq_flags) == ("Jo", "MANAGER_LABEL_STRIPPED;PHONE_INVALID")
    p = spark.createDataFrame([("p1", "x", "loan", "Rs. 1,200.7", "2020-01-01", "yes", "sme", "v", 1, "{}"), ("p2", "x", "loan", "true", "2020-01-01", "", "sme", "v", 2, "{}"), ("p3", "x", "loan", "-1", "2020-01-01", "", "sme", "v", 3, "{}"), ("p4", "x", "loan", "0", "?", "", "sme", "v", 4, "{}")], ", ".join(f"{n} string" for n in entities.PRODUCTS.raw) + ", _src_row long, _raw string")
    got = {r._src_row: r for r in entities.products(p).collect()}
    assert {k: r.first_error and r.first_error.rule_id for k, r in got.items()} == {1: None, 2: "PR-PRICE-NUM", 3: "PR-PRICE-NEG", 4: "PR-LAUNCH"}
    assert (got[1].price, got[1].is_active, got[1].category) == (1200, True, "SME")
