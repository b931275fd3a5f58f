"""The four cleansing chains over raw rows made from the sample tables, and the SQL that says what must come out.

Raw texts follow from a row's number by moduli, so that every rule, flag and kind of copy occurs; the SQL knows from the
same moduli what each text must be read as, and applies the rules in its own words. Every row comes out: src_row,
rule_id and error_code of a rejected one, and the flags and clean columns, as text, of an accepted one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import entities
from .entities import AS_OF, Entity


def _by(n: Column, modulus: int, cases: dict[int, Column | str], otherwise: Column | str) -> Column:
    """The case whose number is n modulo `modulus`."""
    out = F.lit(otherwise) if isinstance(otherwise, str) else otherwise
    for i, c in cases.items():
        out = F.when(n % modulus == i, F.lit(c) if isinstance(c, str) else c).otherwise(out)
    return out


def _shown(rows: DataFrame, columns: list[str]) -> DataFrame:
    """All rows: position, error, and of accepted ones flags and columns as text."""
    fine = F.col("first_error").isNull()
    kinds = dict(rows.dtypes)
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") if kinds[c].startswith("timestamp") else F.col(c).cast("string")
    return rows.select(F.col("_src_row").alias("src_row"), "first_error.rule_id", "first_error.error_code", *[F.when(fine, text(c)).alias(c) for c in ("dq_flags", *columns)])


def _raw(rows: DataFrame, entity: Entity, n: Column, columns: dict[str, Column], *more: Column) -> DataFrame:
    return rows.select(n.alias("_src_row"), *[columns[c].alias(c) for c in entity.raw], *more, F.lit("{}").alias("_raw"))


def _chain(key: str, columns: list[str], prefix: str, shown: list[str], source: str, after: str = "") -> str:
    """SQL of copies and conflicts over `ck` (src, err, code, flags, columns), of what follows, and of the rows that come out."""
    differs = " OR ".join(f"count(DISTINCT {c}) OVER (PARTITION BY err IS NULL, {key}) > 1" for c in columns)
    text = ", ".join(f"CASE WHEN rule_id IS NULL THEN {c}::VARCHAR END AS {c}" for c in shown)
    return f"""{source},
d1 AS (SELECT *, row_number() OVER (PARTITION BY err IS NULL, {key}, {', '.join(columns)} ORDER BY src) > 1 AS copy, {differs} AS conflict FROM ck),
d2 AS (SELECT *, row_number() OVER (PARTITION BY err IS NULL, {key} ORDER BY copy, CASE WHEN flags = '' THEN 0 ELSE len(string_split(flags, ';')) END, src) AS place FROM d1),
d3 AS (SELECT * EXCLUDE (err, code), CASE WHEN err IS NOT NULL THEN err WHEN copy THEN '{prefix}-DUP' WHEN conflict THEN '{prefix}-CONFLICT' WHEN place > 1 THEN '{prefix}-DUP' END AS rule_id,
  CASE WHEN err IS NOT NULL THEN code WHEN copy THEN 'DUPLICATE_RECORD' WHEN conflict THEN 'CONFLICTING_DUPLICATE' WHEN place > 1 THEN 'DUPLICATE_RECORD' END AS error_code FROM d2){after}
SELECT src AS src_row, rule_id, error_code, CASE WHEN rule_id IS NULL THEN flags END AS dq_flags, {text} FROM {'d4' if after else 'd3'}"""


# ---------------------------------------------------------------- customers


def customers(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    b = k - F.when(k % 20 == 1, 1).otherwise(0)  # every twentieth row comes under the number of the one before it
    digits = F.lpad((b * 7919 % 10000000000).cast("string"), 10, "0")
    raw = _raw(customer, entities.CUSTOMERS, k, {
        "customer_id": _by(k, 41, {0: " "}, F.concat(F.lit("c"), b)), "customer_name": F.concat(F.lit(" Name "), b),
        "email": F.when((k % 40 == 1) | (b % 4 == 2), F.lit("")).otherwise(_by(b, 4, {0: F.concat(F.lit("User"), b, F.lit("@@Example.com ")), 1: F.concat(F.lit("u"), b, F.lit("@example"))}, F.concat(F.lit("u"), b, F.lit("@example.com")))),
        "phone": _by(b, 5, {0: F.concat(F.lit("+91 "), F.substring(digits, 1, 5), F.lit(" "), F.substring(digits, 6, 5)), 1: F.concat(F.lit("91"), digits), 2: F.substring(digits, 1, 9), 3: ""}, digits),
        "account_id": F.concat(F.lit("a"), b - F.when(b % 33 == 1, 1).otherwise(0)), "gender": _by(b, 5, {0: "M", 1: "FEMALE", 2: "other", 3: "x"}, ""),
        "dob": _by(b, 13, {0: "2015-05-05", 1: "2090-01-01", 2: "1890-01-01", 3: "15/08/1985", 4: "junk", 5: ""}, "1990-01-15"), "address": _by(k, 60, {21: "elsewhere"}, "12 High St"),
        "kyc_status": _by(b, 17, {0: "maybe", 1: "PENDING", 2: " rejected "}, "verified"), "registration_date": _by(b, 19, {0: "2090-01-01", 1: "bad", 2: "03/04/2020", 3: "25/12/2019", 4: "12/25/2019", 5: "2021/2/3"}, "2020-01-31"),
    })
    return _shown(entities.customers(raw), list(entities.CUSTOMERS.clean))


_CUSTOMER_COLUMNS = ["customer_name", "email", "phone", "account_id", "gender", "dob", "address", "kyc_status", "registration_date"]
CUSTOMERS_SQL = _chain("customer_id", _CUSTOMER_COLUMNS, "CU", ["customer_id", *_CUSTOMER_COLUMNS], f"""WITH r AS (SELECT c_custkey AS k, c_custkey - (c_custkey % 20 = 1)::INTEGER AS b FROM customer),
v AS (SELECT k AS src, b, k, CASE WHEN k % 41 <> 0 THEN 'C' || b END AS customer_id, 'Name ' || b AS customer_name,
  (k % 40 = 1 OR b % 4 = 2) AS no_email, CASE WHEN k % 40 = 1 OR b % 4 IN (1, 2) THEN NULL WHEN b % 4 = 0 THEN 'user' || b || '@example.com' ELSE 'u' || b || '@example.com' END AS email,
  CASE WHEN b % 5 NOT IN (2, 3) THEN '+91-' || lpad((b * 7919 % 10000000000)::VARCHAR, 10, '0') END AS phone,
  'A' || (b - (b % 33 = 1)::INTEGER) AS account_id, b - (b % 33 = 1)::INTEGER AS account_number, CASE b % 5 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' WHEN 2 THEN 'Other' ELSE 'Unknown' END AS gender,
  CASE b % 13 WHEN 0 THEN DATE '2015-05-05' WHEN 1 THEN DATE '2090-01-01' WHEN 2 THEN DATE '1890-01-01' WHEN 3 THEN DATE '1985-08-15' WHEN 4 THEN NULL WHEN 5 THEN NULL ELSE DATE '1990-01-15' END AS dob,
  CASE WHEN k % 60 = 21 THEN 'elsewhere' ELSE '12 High St' END AS address, CASE b % 17 WHEN 0 THEN NULL WHEN 1 THEN 'Pending' WHEN 2 THEN 'Rejected' ELSE 'Verified' END AS kyc_status,
  CASE b % 19 WHEN 0 THEN DATE '2090-01-01' WHEN 1 THEN NULL WHEN 2 THEN DATE '2020-04-03' WHEN 3 THEN DATE '2019-12-25' WHEN 4 THEN DATE '2019-12-25' WHEN 5 THEN DATE '2021-02-03' ELSE DATE '2020-01-31' END AS registration_date FROM r),
e AS (SELECT *, CASE WHEN customer_id IS NULL THEN 'CU-STRUCT' WHEN kyc_status IS NULL THEN 'CU-KYC'
    WHEN dob > DATE '{AS_OF}' OR (DATE '{AS_OF}' - dob) / 365.25 < 18 OR (DATE '{AS_OF}' - dob) / 365.25 > 110 THEN 'CU-DOB' WHEN registration_date IS NULL THEN 'CU-REGDATE' WHEN registration_date > DATE '{AS_OF}' THEN 'CU-REGDATE-FUT' END AS err,
  concat_ws(';', CASE WHEN no_email THEN 'EMAIL_MISSING' END, CASE WHEN NOT no_email AND email IS NULL THEN 'EMAIL_INVALID' END, CASE WHEN b % 5 = 3 THEN 'PHONE_MISSING' END, CASE WHEN b % 5 = 2 THEN 'PHONE_INVALID' END,
    CASE WHEN b % 13 = 5 THEN 'DOB_MISSING' END, CASE WHEN b % 19 = 2 THEN 'REG_DATE_AMBIGUOUS_ASSUMED_DMY' END) AS flags FROM v),
ck AS (SELECT *, CASE err WHEN 'CU-STRUCT' THEN 'MALFORMED_STRUCTURE' WHEN 'CU-KYC' THEN 'INVALID_KYC_STATUS' WHEN 'CU-DOB' THEN 'INVALID_DOB' WHEN 'CU-REGDATE' THEN 'INVALID_DATE' WHEN 'CU-REGDATE-FUT' THEN 'FUTURE_DATE' END AS code FROM e)""",
    """,
m AS (SELECT *, count(*) OVER (PARTITION BY rule_id IS NULL, account_id) AS n, count(*) FILTER (account_number = b) OVER (PARTITION BY rule_id IS NULL, account_id) AS matches FROM d3),
d4 AS (SELECT * EXCLUDE (rule_id, error_code), coalesce(rule_id, CASE WHEN n > 1 AND NOT (account_number = b AND matches = 1) THEN 'CU-ACCT' END) AS rule_id,
  coalesce(error_code, CASE WHEN n > 1 AND NOT (account_number = b AND matches = 1) THEN 'ACCOUNT_CONFLICT' END) AS error_code FROM m)""")  # fmt: skip


# ---------------------------------------------------------------- branches


def branches(supplier: DataFrame) -> DataFrame:
    k = F.col("s_suppkey")
    b = k - F.when(k % 10 == 1, 1).otherwise(0)
    raw = _raw(supplier, entities.BRANCHES, k, {
        "branch_id": _by(k, 37, {0: ""}, F.concat(F.lit(" b"), b)), "branch_name": F.concat(F.lit("Branch "), b), "location": _by(k, 30, {21: "moved"}, "Town"),
        "manager_name": F.when(k % 20 == 11, F.lit("")).otherwise(_by(b, 5, {0: "Ann (New)", 1: "", 2: "Bo "}, "Cy")), "opened_date": _by(b, 17, {0: "2090-01-01", 1: "soon", 2: "31/01/2019"}, "2019-01-31"),
        "region": _by(b, 13, {0: "Middle", 1: "north", 2: "EAST"}, "South"), "branch_type": _by(b, 19, {0: "floating", 1: "rural"}, "URBAN"), "contact_number": _by(b, 7, {0: "12", 1: ""}, "98765 43210"),
    })
    return _shown(entities.branches(raw), list(entities.BRANCHES.clean))


_BRANCH_COLUMNS = ["branch_name", "location", "manager_name", "opened_date", "region", "branch_type", "contact_number"]
BRANCHES_SQL = _chain("branch_id", _BRANCH_COLUMNS, "BR", ["branch_id", *_BRANCH_COLUMNS], f"""WITH r AS (SELECT s_suppkey AS k, s_suppkey - (s_suppkey % 10 = 1)::INTEGER AS b FROM supplier),
v AS (SELECT k AS src, b, k, CASE WHEN k % 37 <> 0 THEN 'B' || b END AS branch_id, 'Branch ' || b AS branch_name, CASE WHEN k % 30 = 21 THEN 'moved' ELSE 'Town' END AS location,
  CASE WHEN k % 20 = 11 OR b % 5 = 1 THEN 'UNASSIGNED' WHEN b % 5 = 0 THEN 'Ann' WHEN b % 5 = 2 THEN 'Bo' ELSE 'Cy' END AS manager_name,
  CASE b % 17 WHEN 0 THEN DATE '2090-01-01' WHEN 1 THEN NULL ELSE DATE '2019-01-31' END AS opened_date, CASE b % 13 WHEN 0 THEN NULL WHEN 1 THEN 'North' WHEN 2 THEN 'East' ELSE 'South' END AS region,
  CASE b % 19 WHEN 0 THEN NULL WHEN 1 THEN 'Rural' ELSE 'Urban' END AS branch_type, CASE WHEN b % 7 NOT IN (0, 1) THEN '+91-9876543210' END AS contact_number FROM r),
e AS (SELECT *, CASE WHEN branch_id IS NULL THEN 'BR-STRUCT' WHEN region IS NULL THEN 'BR-REGION' WHEN branch_type IS NULL THEN 'BR-TYPE' WHEN opened_date IS NULL OR opened_date > DATE '{AS_OF}' THEN 'BR-OPENED' END AS err,
  concat_ws(';', CASE WHEN k % 20 <> 11 AND b % 5 = 0 THEN 'MANAGER_LABEL_STRIPPED' END, CASE WHEN manager_name = 'UNASSIGNED' THEN 'MANAGER_MISSING' END, CASE WHEN b % 7 = 0 THEN 'PHONE_INVALID' END) AS flags FROM v),
ck AS (SELECT *, CASE err WHEN 'BR-STRUCT' THEN 'MALFORMED_STRUCTURE' WHEN 'BR-REGION' THEN 'INVALID_REGION' WHEN 'BR-TYPE' THEN 'INVALID_BRANCH_TYPE' WHEN 'BR-OPENED' THEN 'INVALID_DATE' END AS code FROM e)""")  # fmt: skip


# ---------------------------------------------------------------- products


def products(part: DataFrame) -> DataFrame:
    k = F.col("p_partkey")
    b = k - F.when(k % 15 == 1, 1).otherwise(0)
    raw = _raw(part, entities.PRODUCTS, k, {
        "product_id": _by(k, 43, {0: F.lit(None).cast("string")}, F.concat(F.lit("p"), b)), "product_name": F.concat(F.lit("Product "), b), "product_type": _by(b, 23, {0: "gift", 1: "credit card", 2: "FIXED DEPOSIT", 3: "Savings Account"}, "loan"),
        "price": _by(k, 45, {31: "77"}, _by(b, 11, {0: "-3", 1: "true", 2: "Rs. 1,200.7", 3: "1e3", 4: "free"}, b.cast("string"))), "launch_date": _by(b, 29, {0: "2090-01-02", 1: "?", 2: "02/03/2020"}, "2020-05-06"),
        "is_active": _by(b, 6, {0: "true", 1: "no", 2: "1", 3: "1", 4: "perhaps"}, F.lit(None).cast("string")), "category": _by(b, 31, {0: "other", 1: "SME"}, "retail"), "vendor_name": F.when(k % 30 == 16, F.lit(None).cast("string")).otherwise(F.lit(" V ")),
    }, _by(b, 6, {0: "boolean", 2: "number", 3: "string"}, "string").alias("is_active_kind"))
    return _shown(entities.products(raw), list(entities.PRODUCTS.clean))


_PRODUCT_COLUMNS = ["product_name", "product_type", "price", "launch_date", "is_active", "category", "vendor_name"]
PRODUCTS_SQL = _chain("product_id", _PRODUCT_COLUMNS, "PR", ["product_id", *_PRODUCT_COLUMNS], f"""WITH r AS (SELECT p_partkey AS k, p_partkey - (p_partkey % 15 = 1)::INTEGER AS b FROM part),
v AS (SELECT k AS src, b, k, CASE WHEN k % 43 <> 0 THEN 'P' || b END AS product_id, 'Product ' || b AS product_name,
  CASE b % 23 WHEN 0 THEN NULL WHEN 1 THEN 'Credit Card' WHEN 2 THEN 'Fixed Deposit' WHEN 3 THEN 'Savings Account' ELSE 'Loan' END AS product_type,
  CASE WHEN k % 45 = 31 THEN 77 ELSE CASE b % 11 WHEN 0 THEN -3 WHEN 1 THEN NULL WHEN 2 THEN 1200 WHEN 3 THEN 1000 WHEN 4 THEN NULL ELSE b END END AS price,
  CASE b % 29 WHEN 0 THEN DATE '2090-01-02' WHEN 1 THEN NULL WHEN 2 THEN DATE '2020-03-02' ELSE DATE '2020-05-06' END AS launch_date, b % 6 IN (0, 3) AS is_active,
  CASE b % 31 WHEN 0 THEN NULL WHEN 1 THEN 'SME' ELSE 'Retail' END AS category, CASE WHEN k % 30 <> 16 THEN 'V' END AS vendor_name FROM r),
e AS (SELECT *, CASE WHEN product_id IS NULL THEN 'PR-STRUCT' WHEN price IS NULL THEN 'PR-PRICE-NUM' WHEN price < 0 THEN 'PR-PRICE-NEG' WHEN category IS NULL THEN 'PR-CAT' WHEN product_type IS NULL THEN 'PR-TYPE'
    WHEN launch_date IS NULL OR launch_date > DATE '{AS_OF}' THEN 'PR-LAUNCH' END AS err, CASE WHEN b % 6 IN (2, 4, 5) THEN 'IS_ACTIVE_DEFAULTED' ELSE '' END AS flags FROM v),
ck AS (SELECT *, CASE err WHEN 'PR-STRUCT' THEN 'MALFORMED_STRUCTURE' WHEN 'PR-PRICE-NUM' THEN 'INVALID_PRICE' WHEN 'PR-PRICE-NEG' THEN 'NEGATIVE_PRICE' WHEN 'PR-CAT' THEN 'INVALID_CATEGORY' WHEN 'PR-TYPE' THEN 'INVALID_PRODUCT_TYPE'
  WHEN 'PR-LAUNCH' THEN 'INVALID_DATE' END AS code FROM e)""")  # fmt: skip


# ---------------------------------------------------------------- transactions


def transactions(orders: DataFrame, customer: DataFrame, part: DataFrame, supplier: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    b = k - F.when(k % 25 == 1, 1).otherwise(0)
    day = F.lpad((b % 28 + 1).cast("string"), 2, "0")
    id_of = lambda letter, n: F.concat(F.lit(letter), n)
    raw = _raw(orders, entities.TRANSACTIONS, k, {
        "transaction_id": _by(k, 101, {0: ""}, id_of("t", b)), "account_id": id_of("a", b % 200), "product_id": id_of(" p", b % 150), "branch_id": id_of("b", b % 12),
        "date": _by(b, 97, {0: "2027-01-01"}, _by(b, 6, {0: F.concat(day, F.lit("/09/2026")), 1: "2026-08-30", 2: "", 3: F.concat(F.lit("09/"), day, F.lit("/2026"))}, F.concat(F.lit("2026-09-"), day))),
        "timestamp": _by(b, 89, {0: "yesterday", 1: "2026-10-07 00:00:00", 2: ""}, F.concat(F.lit("2026-09-"), day, F.lit(" 10:00:00"))),
        "amount": _by(k, 50, {26: "7"}, _by(b, 31, {0: "0", 1: "-5", 2: "abc", 3: "", 4: "Rs.119,367"}, F.concat(F.lit("1,"), F.lpad((b % 1000).cast("string"), 3, "0"), F.lit(".9")))),
        "payment_method": _by(b, 37, {0: "gold"}, _by(b, 5, {0: "upi", 1: "NETBANKING", 2: "Cash", 3: "card"}, "Cheque")), "status": _by(b, 41, {0: "zzz", 1: "SUCC", 2: "Faild", 3: "Succes", 4: "pendng"}, _by(b, 3, {0: "failed", 1: "Pending"}, "SUCCESS")),
        "currency": _by(b, 7, {0: "", 1: "usd"}, "inr"), "remarks": F.when(k % 75 == 51, F.lit("")).otherwise(_by(b, 9, {0: "[late correction]", 1: "[late correction] again", 2: ""}, "fine")), "is_refund": _by(b, 8, {0: "Y", 1: "1", 2: "?", 3: ""}, "no"),
    })
    dims = [
        ("TX-RI-ACCT", "account_id", customer.filter("c_custkey % 13 <> 0").select(F.concat(F.lit("A"), "c_custkey").alias("account_id"))),
        ("TX-RI-PROD", "product_id", part.filter("p_partkey % 17 <> 0").select(F.concat(F.lit("P"), "p_partkey").alias("product_id"))),
        ("TX-RI-BR", "branch_id", supplier.filter("s_suppkey < 10").select(F.concat(F.lit("B"), "s_suppkey").alias("branch_id"))),
    ]
    return _shown(entities.references(entities.transactions(raw), dims), list(entities.TRANSACTIONS.clean))


_TX_COLUMNS = ["account_id", "product_id", "branch_id", "transaction_date", "timestamp", "amount", "payment_method", "status", "currency", "remarks", "is_refund"]
TRANSACTIONS_SQL = _chain("transaction_id", _TX_COLUMNS, "TX", ["transaction_id", *_TX_COLUMNS, "is_correction"], f"""WITH r AS (SELECT o_orderkey AS k, o_orderkey - (o_orderkey % 25 = 1)::INTEGER AS b FROM orders),
v AS (SELECT k AS src, b, k, CASE WHEN k % 101 <> 0 THEN 'T' || b END AS transaction_id, 'A' || (b % 200) AS account_id, 'P' || (b % 150) AS product_id, 'B' || (b % 12) AS branch_id,
  CASE b % 89 WHEN 0 THEN NULL WHEN 1 THEN TIMESTAMP '2026-10-07 00:00:00' WHEN 2 THEN NULL ELSE TIMESTAMP '2026-09-01 10:00:00' + to_days((b % 28)::INTEGER) END AS ts,
  CASE WHEN b % 97 = 0 THEN [DATE '2027-01-01'] WHEN b % 6 = 1 THEN [DATE '2026-08-30'] WHEN b % 6 = 2 THEN []
    WHEN b % 6 = 0 AND b % 28 < 12 AND b % 28 <> 8 THEN [make_date(2026, 9, (b % 28 + 1)::INTEGER), make_date(2026, (b % 28 + 1)::INTEGER, 9)]
    WHEN b % 6 = 3 AND b % 28 < 12 AND b % 28 <> 8 THEN [make_date(2026, (b % 28 + 1)::INTEGER, 9), make_date(2026, 9, (b % 28 + 1)::INTEGER)]
    ELSE [make_date(2026, 9, (b % 28 + 1)::INTEGER)] END AS readings,
  CASE WHEN k % 50 = 26 THEN 7 ELSE CASE b % 31 WHEN 0 THEN 0 WHEN 1 THEN -5 WHEN 2 THEN NULL WHEN 3 THEN NULL WHEN 4 THEN 119367 ELSE 1000 + b % 1000 END END AS amount,
  CASE WHEN b % 37 = 0 THEN NULL ELSE ['UPI', 'NetBanking', 'Cash', 'Card', 'Cheque'][(b % 5)::INTEGER + 1] END AS payment_method,
  CASE b % 41 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN 'FAILED' WHEN 3 THEN 'SUCCESS' WHEN 4 THEN 'PENDING' ELSE ['FAILED', 'PENDING', 'SUCCESS'][(b % 3)::INTEGER + 1] END AS status,
  CASE WHEN b % 7 = 1 THEN 'USD' ELSE 'INR' END AS currency, k % 75 <> 51 AND b % 9 IN (0, 1) AS is_correction, CASE WHEN k % 75 = 51 OR b % 9 IN (0, 2) THEN NULL WHEN b % 9 = 1 THEN 'again' ELSE 'fine' END AS remarks, b % 8 IN (0, 1) AS is_refund FROM r),
w AS (SELECT *, ts AS timestamp, ts::DATE AS transaction_date, list_contains(readings, ts::DATE) AS agrees FROM v),
e AS (SELECT *, CASE WHEN transaction_id IS NULL OR b % 89 = 2 THEN 'TX-STRUCT' WHEN amount IS NULL THEN 'TX-AMT-BLANK' WHEN amount = 0 THEN 'TX-AMT-ZERO' WHEN amount < 0 THEN 'TX-AMT-NEG' WHEN ts IS NULL THEN 'TX-TS'
    WHEN ts >= DATE '{AS_OF}' + 1 THEN 'TX-FUT' WHEN list_min(readings) > DATE '{AS_OF}' THEN 'TX-FUT-DATE' WHEN status IS NULL THEN 'TX-STATUS' WHEN payment_method IS NULL THEN 'TX-PAY' END AS err,
  concat_ws(';', CASE WHEN len(readings) > 0 AND NOT agrees THEN 'DATE_RECONCILED_TO_TIMESTAMP' END, CASE WHEN len(readings) > 1 AND agrees THEN 'DATE_AMBIGUOUS_RESOLVED_BY_TS' END, CASE WHEN currency <> 'INR' THEN 'NON_INR_CURRENCY' END,
    CASE WHEN b % 8 IN (2, 3) THEN 'IS_REFUND_DEFAULTED' END, CASE WHEN is_correction THEN 'LATE_CORRECTION' END) AS flags FROM w),
ck AS (SELECT *, CASE err WHEN 'TX-STRUCT' THEN 'MALFORMED_STRUCTURE' WHEN 'TX-AMT-BLANK' THEN 'AMOUNT_BLANK' WHEN 'TX-AMT-ZERO' THEN 'AMOUNT_ZERO' WHEN 'TX-AMT-NEG' THEN 'AMOUNT_NEGATIVE' WHEN 'TX-TS' THEN 'INVALID_DATE'
  WHEN 'TX-FUT' THEN 'FUTURE_DATE' WHEN 'TX-FUT-DATE' THEN 'FUTURE_DATE' WHEN 'TX-STATUS' THEN 'INVALID_STATUS' WHEN 'TX-PAY' THEN 'INVALID_PAYMENT_METHOD' END AS code FROM e)""",
    """,
d4 AS (SELECT * EXCLUDE (rule_id, error_code), coalesce(rule_id, CASE WHEN account_id NOT IN (SELECT 'A' || c_custkey FROM customer WHERE c_custkey % 13 <> 0) THEN 'TX-RI-ACCT'
    WHEN product_id NOT IN (SELECT 'P' || p_partkey FROM part WHERE p_partkey % 17 <> 0) THEN 'TX-RI-PROD' WHEN branch_id NOT IN (SELECT 'B' || s_suppkey FROM supplier WHERE s_suppkey < 10) THEN 'TX-RI-BR' END) AS rule_id,
  CASE WHEN rule_id IS NOT NULL THEN error_code WHEN account_id NOT IN (SELECT 'A' || c_custkey FROM customer WHERE c_custkey % 13 <> 0) OR product_id NOT IN (SELECT 'P' || p_partkey FROM part WHERE p_partkey % 17 <> 0)
    OR branch_id NOT IN (SELECT 'B' || s_suppkey FROM supplier WHERE s_suppkey < 10) THEN 'MISSING_DIM' END AS error_code FROM d3)""")  # fmt: skip
