import pytest
from pyspark.sql import functions as F

from tidemark.functions import dates, numbers, text
from tidemark.operators.fuzzy import close


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(("raw", "want"), [("+91-9876543210", "+91-9876543210"), (" +91 98765 43210 ", "+91-9876543210"), ("9876543210", "+91-9876543210"), ("919876543210", "+91-9876543210"), ("987654321", None), ("", None), (None, None), ("+91 123", None)])
def test_phone(spark, raw, want):
    assert one(spark, raw, text.phone) == want


@pytest.mark.parametrize(("raw", "want"), [(" A.B@X.com ", "a.b@x.com"), ("a@@x.com", "a@x.com"), ("a@x", None), ("", None), (None, None)])
def test_email(spark, raw, want):
    assert one(spark, raw, text.email) == want


@pytest.mark.parametrize(("raw", "want"), [
    ("2024-02-29", ["2024-02-29"]), ("2024/2/9", ["2024-02-09"]), ("31/01/2024", ["2024-01-31"]), ("01/31/2024", ["2024-01-31"]), ("03/04/2024", ["2024-04-03", "2024-03-04"]),
    ("05-05-2024", ["2024-05-05"]), ("30/02/2024", []), ("13/13/2024", []), ("x", []), ("", []), (None, []),
])
def test_candidates(spark, raw, want):
    assert [str(d) for d in one(spark, raw, dates.candidates)] == want


@pytest.mark.parametrize(("raw", "want"), [("36602", 36602.0), ("119,367", 119367.0), ("Rs. 5", 5.0), ("-3.5", -3.5), ("1e3", 1000.0), ("NaN", None), ("10d", None), ("₹5", None), ("", None), (None, None)])
def test_number(spark, raw, want):
    assert one(spark, raw, numbers.number) == want


@pytest.mark.parametrize(("a", "b", "want"), [(1, 3, 33.33), (2, 3, 66.67), (-1, 3, -33.33), (1, -3, -33.33), (-1, -3, 33.33), (1, 800, 0.13), (0, 5, 0.0), (5, 0, None), (None, 5, None)])
def test_exact_pct(spark, a, b, want):
    got = spark.createDataFrame([(a, b)], "a long, b long").select(numbers.exact_pct(F.col("a"), F.col("b")).alias("p")).first().p
    assert got == want


def test_small_ones(spark):
    assert one(spark, " \t x ", text.blank_to_null) == "x" and one(spark, " \n", text.blank_to_null) is None
    assert one(spark, "C007", text.first_number) == 7 and one(spark, "C", text.first_number) is None
    assert one(spark, "2026-10-06 01:02:03", dates.strict_timestamp) is not None and one(spark, "2026-10-06", dates.strict_timestamp) is None
    assert [one(spark, x, text.boolean) for x in ("Yes", "0", "?", None)] == [True, False, None, None]
    assert one(spark, "upi", lambda c: text.canonical(c, {"upi": "UPI"})) == "UPI"


@pytest.mark.parametrize(("raw", "want"), [("Succes", "SUCCESS"), ("Faild", "FAILED"), ("FAIL", "FAILED"), ("SUCC", None), ("PEND", None)])
def test_close(raw, want):
    assert close(raw, ["SUCCESS", "FAILED", "PENDING"], 0.75) == want
