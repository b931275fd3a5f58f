"""Cleansing of the four source entities: normalised columns, then rules and flags in their order.

Every function takes a text table with _src_row and _raw and returns it annotated with first_error and dq_flags; the
first rule that fails claims the row. Set-based steps (copies, conflicts, shared accounts, unknown keys) see only
rows that passed what comes before them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates, numbers, text
from ..operators.dedup import dedupe_errors
from ..operators.fuzzy import close_match
from ..operators.rules import Flag, Rule, annotate, error

AS_OF = "2026-10-06"

# What the sources may say, and what it counts as.
GENDERS = {"male": "Male", "m": "Male", "female": "Female", "f": "Female", "other": "Other", "unknown": "Unknown"}
KYC = ("Verified", "Pending", "Rejected")
REGIONS = ("North", "South", "East", "West")
BRANCH_TYPES = ("Urban", "Rural")
CATEGORIES = ("Retail", "Corporate", "SME")
PRODUCT_TYPES = ("Loan", "Credit Card", "Savings Account", "Fixed Deposit")
STATUSES = ("SUCCESS", "FAILED", "PENDING")
PAYMENTS = {"upi": "UPI", "netbanking": "NetBanking", "cash": "Cash", "card": "Card", "cheque": "Cheque"}
CORRECTION = "[late correction]"


@dataclass(frozen=True)
class Entity:
    """How a source is read and where its rows go."""

    name: str
    key: str
    raw: tuple[str, ...]
    clean: tuple[str, ...]
    business: tuple[str, ...]
    prefix: str
    cleanse: Callable[[DataFrame, str], DataFrame]


def _null(name: str) -> Column:
    return F.col(name).isNull()


def _any_null(*names: str) -> Column:
    out = _null(names[0])
    for n in names[1:]:
        out = out | _null(n)
    return out


def _date(as_of: str) -> Column:
    return F.lit(as_of).cast("date")


def _after_dedup(df: DataFrame, entity: Entity) -> DataFrame:
    """Copies and conflicts among the rows that passed so far; one pass over all rows."""
    passed = F.col("first_error").isNull()
    rows = dedupe_errors(df, entity.key, list(entity.business), entity.prefix, among=passed)
    return rows.withColumn("first_error", F.coalesce("first_error", F.when(passed, F.col("dup_error")))).drop("dup_error")


def customers(raw: DataFrame, as_of: str = AS_OF) -> DataFrame:
    c = raw.drop("transaction_id") if "transaction_id" in raw.columns else raw
    c = c.withColumns({n: text.blank_to_null(F.col(n)) for n in CUSTOMERS.raw if n in c.columns})
    c = c.withColumns({n: F.upper(n) for n in ("customer_id", "account_id")})
    c = c.withColumns({f"_{n}": F.col(n) for n in ("email", "phone", "dob", "registration_date")})
    readings = dates.candidates(F.col("_registration_date"))
    c = c.withColumns({
        "email": text.email(F.col("_email")), "phone": text.phone(F.col("_phone")), "gender": F.coalesce(text.canonical(F.col("gender"), GENDERS), F.lit("Unknown")),
        "kyc_status": text.canonical(F.col("kyc_status"), KYC), "dob": dates.first(F.col("_dob")), "registration_date": F.get(readings, F.lit(0)), "_readings": F.size(readings),
    })
    age = F.datediff(_date(as_of), "dob") / 365.25
    rules = [
        Rule("CU-STRUCT", "MALFORMED_STRUCTURE", "id, account or name is missing", _any_null("customer_id", "account_id", "customer_name")),
        Rule("CU-KYC", "INVALID_KYC_STATUS", "unknown status", _null("kyc_status")),
        Rule("CU-DOB", "INVALID_DOB", "birth in the future, or age below 18 or above 110", F.coalesce((F.col("dob") > _date(as_of)) | (age < 18) | (age > 110), F.lit(False))),
        Rule("CU-REGDATE", "INVALID_DATE", "registration date is missing or unreadable", _null("registration_date")),
        Rule("CU-REGDATE-FUT", "FUTURE_DATE", "registration in the future", F.col("registration_date") > _date(as_of)),
    ]
    flags = [
        Flag("EMAIL_MISSING", _null("_email")), Flag("EMAIL_INVALID", F.col("_email").isNotNull() & _null("email")),
        Flag("PHONE_MISSING", _null("_phone")), Flag("PHONE_INVALID", F.col("_phone").isNotNull() & _null("phone")),
        Flag("DOB_MISSING", _null("_dob")), Flag("REG_DATE_AMBIGUOUS_ASSUMED_DMY", F.col("_readings") > 1),
    ]
    c = annotate(c, rules, flags).drop("_email", "_phone", "_dob", "_registration_date", "_readings")
    return shared_accounts(_after_dedup(c, CUSTOMERS))


def shared_accounts(df: DataFrame) -> DataFrame:
    """Of customers with one account, the one whose number is the account's stays; with no or several such, none does.

    Rows that failed before stand alone by their position.
    """
    passed = F.col("first_error").isNull()
    rows = df.withColumns({"_account": F.when(passed, F.col("account_id")), "_alone": F.when(~passed, F.col("_src_row"))})
    w = Window.partitionBy("_account", "_alone")
    same = F.coalesce(text.first_number(F.col("customer_id")) == text.first_number(F.col("account_id")), F.lit(False))
    rows = rows.withColumns({"_same": same, "_n": F.count("*").over(w)}).withColumn("_matches", F.count_if("_same").over(w))
    rule = Rule("CU-ACCT", "ACCOUNT_CONFLICT", "several customers claim one account", passed & (F.col("_n") > 1) & ~(F.col("_same") & (F.col("_matches") == 1)))
    return rows.withColumn("first_error", F.coalesce("first_error", F.when(rule.fails, error(rule)))).drop("_same", "_n", "_matches", "_account", "_alone")


def branches(raw: DataFrame, as_of: str = AS_OF) -> DataFrame:
    b = raw.withColumns({n: text.blank_to_null(F.col(n)) for n in BRANCHES.raw})
    b = b.withColumns({"branch_id": F.upper("branch_id"), "_manager": F.col("manager_name"), "_contact": F.col("contact_number")})
    label = r"\s*\(New\)$"
    b = b.withColumns({
        "region": text.canonical(F.col("region"), REGIONS), "branch_type": text.canonical(F.col("branch_type"), BRANCH_TYPES),
        "manager_name": F.coalesce(F.regexp_replace("_manager", label, ""), F.lit("UNASSIGNED")), "contact_number": text.phone(F.col("_contact")), "opened_date": dates.first(F.col("opened_date")),
    })
    rules = [
        Rule("BR-STRUCT", "MALFORMED_STRUCTURE", "id or name is missing", _any_null("branch_id", "branch_name")),
        Rule("BR-REGION", "INVALID_REGION", "unknown region", _null("region")),
        Rule("BR-TYPE", "INVALID_BRANCH_TYPE", "unknown branch type", _null("branch_type")),
        Rule("BR-OPENED", "INVALID_DATE", "opening date is missing, unreadable or in the future", _null("opened_date") | (F.col("opened_date") > _date(as_of))),
    ]
    flags = [
        Flag("MANAGER_LABEL_STRIPPED", F.col("_manager").rlike(label)), Flag("MANAGER_MISSING", _null("_manager")),
        Flag("PHONE_INVALID", F.col("_contact").isNotNull() & _null("contact_number")),
    ]
    return _after_dedup(annotate(b, rules, flags).drop("_manager", "_contact"), BRANCHES)


def products(raw: DataFrame, as_of: str = AS_OF) -> DataFrame:
    """Values as text; JSON booleans come as true and false. Numbers, 1 and 0 too, are no booleans where is_active_kind tells them."""
    p = raw.withColumns({n: text.blank_to_null(F.col(n)) for n in PRODUCTS.raw})
    price = numbers.number(F.col("price"))
    active = text.boolean(F.col("is_active"))
    if "is_active_kind" in p.columns:
        active = F.when(F.col("is_active_kind") != "number", active)
    p = p.withColumns({
        "product_id": F.upper("product_id"), "_price": price, "_active": active, "category": text.canonical(F.col("category"), CATEGORIES),
        "product_type": text.canonical(F.col("product_type"), PRODUCT_TYPES), "launch_date": dates.first(F.col("launch_date")),
    })
    p = p.withColumns({"price": numbers.whole(F.col("_price")), "is_active": F.coalesce("_active", F.lit(False))})
    rules = [
        Rule("PR-STRUCT", "MALFORMED_STRUCTURE", "id is missing", _null("product_id")),
        Rule("PR-PRICE-NUM", "INVALID_PRICE", "price is no number", _null("_price")),
        Rule("PR-PRICE-NEG", "NEGATIVE_PRICE", "price is below zero", F.col("_price") < 0),
        Rule("PR-CAT", "INVALID_CATEGORY", "unknown category", _null("category")),
        Rule("PR-TYPE", "INVALID_PRODUCT_TYPE", "unknown product type", _null("product_type")),
        Rule("PR-LAUNCH", "INVALID_DATE", "launch date is missing, unreadable or in the future", _null("launch_date") | (F.col("launch_date") > _date(as_of))),
    ]
    annotated = annotate(p, rules, [Flag("IS_ACTIVE_DEFAULTED", _null("_active"))]).drop("_price", "_active", "is_active_kind")
    return _after_dedup(annotated, PRODUCTS)


def transactions(raw: DataFrame, as_of: str = AS_OF) -> DataFrame:
    t = raw.withColumns({n: text.blank_to_null(F.col(n)) for n in TRANSACTIONS.raw})
    t = t.withColumns({n: F.upper(n) for n in ("transaction_id", "account_id", "product_id", "branch_id")})
    t = close_match(t, "status", list(STATUSES), "_status")
    t = t.withColumns({"_amount": numbers.number(F.col("amount")), "_ts": dates.strict_timestamp(F.col("timestamp")), "_read": dates.candidates(F.col("date")), "_refund": text.boolean(F.col("is_refund"))})
    day = F.to_date("_ts")
    agrees = F.coalesce(F.array_contains("_read", day), F.lit(False))
    marked = F.coalesce(F.contains(F.col("remarks"), F.lit(CORRECTION)), F.lit(False))
    t = t.withColumns({
        "transaction_date": day, "_agrees": agrees, "currency": F.coalesce(F.upper("currency"), F.lit("INR")), "_payment": text.canonical(F.col("payment_method"), PAYMENTS), "is_correction": marked,
        "remarks": F.when(marked, text.blank_to_null(F.replace(F.col("remarks"), F.lit(CORRECTION), F.lit("")))).otherwise(F.col("remarks")),
    })
    structure = _any_null("transaction_id", "account_id", "product_id", "branch_id") | F.col("timestamp").isNull()
    rules = [
        Rule("TX-STRUCT", "MALFORMED_STRUCTURE", "an id or the timestamp is missing", structure),
        Rule("TX-AMT-BLANK", "AMOUNT_BLANK", "amount is missing or no number", _null("_amount")),
        Rule("TX-AMT-ZERO", "AMOUNT_ZERO", "amount is zero", F.col("_amount") == 0),
        Rule("TX-AMT-NEG", "AMOUNT_NEGATIVE", "amount is below zero", F.col("_amount") < 0),
        Rule("TX-TS", "INVALID_DATE", "timestamp is unreadable", _null("_ts")),
        Rule("TX-FUT", "FUTURE_DATE", "timestamp in the future", F.col("_ts") >= F.date_add(_date(as_of), 1).cast("timestamp_ntz")),
        Rule("TX-FUT-DATE", "FUTURE_DATE", "date in the future", F.coalesce(F.array_min("_read") > _date(as_of), F.lit(False))),
        Rule("TX-STATUS", "INVALID_STATUS", "unknown status", _null("_status")),
        Rule("TX-PAY", "INVALID_PAYMENT_METHOD", "unknown payment method", _null("_payment")),
    ]
    flags = [
        Flag("DATE_RECONCILED_TO_TIMESTAMP", ~F.col("_agrees") & (F.size("_read") > 0)), Flag("DATE_AMBIGUOUS_RESOLVED_BY_TS", F.col("_agrees") & (F.size("_read") > 1)),
        Flag("NON_INR_CURRENCY", F.col("currency") != "INR"), Flag("IS_REFUND_DEFAULTED", _null("_refund")), Flag("LATE_CORRECTION", F.col("is_correction")),
    ]
    t = annotate(t, rules, flags).withColumns({"amount": numbers.whole(F.col("_amount")), "timestamp": F.col("_ts"), "status": F.col("_status"), "payment_method": F.col("_payment"), "is_refund": F.coalesce("_refund", F.lit(False))})
    t = t.drop("_amount", "_ts", "_read", "_refund", "_status", "_payment", "_agrees", "date")
    return _after_dedup(t, TRANSACTIONS)


def references(df: DataFrame, dims: list[tuple[str, str, DataFrame]]) -> DataFrame:
    """Reject passed rows whose key no version of a dimension has: (rule id, key, dimension) in order.

    Each dimension's distinct keys are joined once to all rows; the first that is missing claims the row.
    """
    for rule_id, key, dim in dims:
        keys = dim.select(F.col(key).alias("_known")).filter("_known IS NOT NULL").distinct()
        rule = Rule(rule_id, "MISSING_DIM", f"{key} is in no dimension", F.col("_known").isNull())
        df = df.join(keys, F.col(key) == F.col("_known"), "left").withColumn("first_error", F.coalesce("first_error", F.when(rule.fails, error(rule)))).drop("_known")
    return df


CUSTOMERS = Entity(
    "customers", "customer_id", ("customer_id", "customer_name", "email", "phone", "account_id", "gender", "dob", "address", "kyc_status", "registration_date"),
    ("customer_id", "customer_name", "email", "phone", "account_id", "gender", "dob", "address", "kyc_status", "registration_date"),
    ("customer_name", "email", "phone", "account_id", "gender", "dob", "address", "kyc_status", "registration_date"), "CU", customers,
)
BRANCHES = Entity(
    "branches", "branch_id", ("branch_id", "branch_name", "location", "manager_name", "opened_date", "region", "branch_type", "contact_number"),
    ("branch_id", "branch_name", "location", "manager_name", "opened_date", "region", "branch_type", "contact_number"),
    ("branch_name", "location", "manager_name", "opened_date", "region", "branch_type", "contact_number"), "BR", branches,
)
PRODUCTS = Entity(
    "products", "product_id", ("product_id", "product_name", "product_type", "price", "launch_date", "is_active", "category", "vendor_name"),
    ("product_id", "product_name", "product_type", "price", "launch_date", "is_active", "category", "vendor_name"),
    ("product_name", "product_type", "price", "launch_date", "is_active", "category", "vendor_name"), "PR", products,
)
TRANSACTIONS = Entity(
    "transactions", "transaction_id", ("transaction_id", "account_id", "product_id", "branch_id", "date", "timestamp", "amount", "payment_method", "status", "currency", "remarks", "is_refund"),
    ("transaction_id", "account_id", "product_id", "branch_id", "transaction_date", "timestamp", "amount", "payment_method", "status", "currency", "remarks", "is_refund", "is_correction"),
    ("account_id", "product_id", "branch_id", "transaction_date", "timestamp", "amount", "payment_method", "status", "currency", "remarks", "is_refund"), "TX", transactions,
)
ENTITIES = {e.name: e for e in (CUSTOMERS, BRANCHES, PRODUCTS, TRANSACTIONS)}
