import hashlib
import json
from datetime import datetime

import pytest

from tidemark.plans import batches, entities, kpis, serving
from tidemark.sources import readers, sinks
from tidemark.sources.store import Store
from tidemark.streaming.arrivals import DEAD, redrive, watch

CUSTOMERS = "customer_id,customer_name,email,phone,account_id,gender,dob,address,kyc_status,registration_date,transaction_id\n"
BRANCHES = "branch_id,branch_name,location,manager_name,opened_date,region,branch_type,contact_number\n"
TX = "transaction_id,account_id,product_id,branch_id,date,timestamp,amount,payment_method,status,currency,remarks,is_refund\n"


def customer(i, kyc="Verified"):
    return f'c{i},Name {i},u{i}@x.com,98765432{i:02d},a{i},m,1990-01-01,"Street {i}, City",{kyc},2020-01-31,t0\n'


def product(i, price="100"):
    return f'{{"product_id": "p{i}", "product_name": "P{i}", "product_type": "Loan", "price": {price}, "launch_date": "2020-01-01", "is_active": true, "category": "SME", "vendor_name": "V"}}'


def tx(i, account, when="2026-09-01", amount="1000", status="SUCCESS", remarks=""):
    return f"t{i},a{account},p{i % 3},b{i % 2},{when},{when} 10:00:{i % 60:02d},{amount},UPI,{status},INR,{remarks},N\n"


@pytest.fixture
def drops(tmp_path):
    def drop(name, customers, branches, products, transactions, glue=",\n"):
        d = tmp_path / name
        d.mkdir()
        (d / "customers.csv").write_text(CUSTOMERS + "".join(customers))
        (d / "branches.csv").write_text(BRANCHES + "".join(branches))
        (d / "products_json.txt").write_text("[" + glue.join(products) + "]")
        (d / "transactions.csv").write_text(TX + "".join(transactions))
        return {"customers": f"{d}/customers.csv", "branches": f"{d}/branches.csv", "products": f"{d}/products_json.txt", "transactions": f"{d}/transactions.csv"}

    branch = [f"b{i},Branch {i},Loc,Boss,2019-01-01,North,Urban,9876543210\n" for i in range(2)]
    one = drop("one", [customer(i) for i in range(5)], branch, [product(i) for i in range(3)], [tx(i, i % 4, amount=str(1000 + i)) for i in range(12)] + [tx(90, 77), tx(91, 1, amount="0")], glue="\n")
    two = drop("two", [customer(1, "Pending"), customer(8), customer(2)], [branch[0]], [product(0, "150")], [tx(3, 3, amount="5000", remarks="[late correction]"), tx(50, 4, "2026-10-02"), tx(51, 1, "2026-10-02")])
    return one, two


def batch(name, files, **more):
    return batches.Batch(name, more.pop("load_type", "baseline"), "2026-10-01", files, **more)


def test_two_batches(spark, drops, tmp_path):
    root, (one, two) = str(tmp_path / "lake"), drops
    assert batches.run(spark, root, batch("day1-baseline", one)) == "LOADED"
    assert batches.run(spark, root, batch("day1-baseline", one)) == "SKIPPED"
    store = Store(spark, root)
    facts = {r.transaction_id: r for r in batches.gold(store, "fact_transaction").collect()}
    assert len(facts) == 12 and facts["T3"].amount == 1003 and facts["T3"].customer_sk == 4
    card = {r.entity: r for r in batches.gold(store, "dq_scorecard").collect()}
    assert (card["transactions"].received, card["transactions"].passed, card["transactions"].top_reasons) == (14, 12, "AMOUNT_ZERO=1; MISSING_DIM=1")
    assert card["products"].received == 3  # the comma between the objects was missing
    rejects = spark.read.parquet(f"{root}/quarantine/transactions")
    bad = {r.error_code: r for r in rejects.collect()}
    assert bad["AMOUNT_ZERO"].source_row == 15 and json.loads(bad["AMOUNT_ZERO"].raw_payload)["amount"] == "0"
    cut = datetime(2026, 10, 2)
    assert batches.run(spark, root, batch("day2-incremental", two, load_type="incremental", cutoff=cut)) == "LOADED"
    facts = {r.transaction_id: r for r in batches.gold(store, "fact_transaction").collect()}
    assert len(facts) == 14 and facts["T3"].amount == 5000 and facts["T3"].is_correction and facts["T3"].first_batch_id == "day1-baseline" and facts["T3"].loaded_batch_id == "day2-incremental"
    dim = batches.gold(store, "dim_customer").collect()
    assert sorted((r.customer_id, r.kyc_status, r.is_current) for r in dim if r.customer_id in ("C1", "C8")) == [("C1", "Pending", True), ("C1", "Verified", False), ("C8", "Verified", True)]
    assert facts["T51"].customer_sk == max(r.customer_sk for r in dim if r.customer_id == "C1")
    out = batches.indicators(spark, root, "2026-10-06", "2026-10-02", "day1-baseline", "day2-incremental")
    got = {k: v.collect() for k, v in out.items()}
    assert store.read_json("control/audit/day1-baseline.json")["clean_amount_inr"] == sum(range(1000, 1012))
    assert set(kpis.ORDERS) == set(out) and [r.rnk for r in got["kpi01"]] == [1, 2, 3, 4, 5][: len(got["kpi01"])]
    times = [r.txn_ts for r in got["kpi05"]]
    assert times == sorted(times) and [r.batch_id for r in got["kpi10"]] == sorted(r.batch_id for r in got["kpi10"])
    changes = {r.batch_id: r for r in got["kpi11"]}["day2-incremental"]
    assert (changes.new_txns, changes.updated_txns, changes.corrected_txns, changes.customers_new, changes.customers_changed, changes.products_changed, changes.branches_changed) == (2, 1, 1, 1, 1, 1, 0)
    assert sum(r.revenue for r in got["kpi03"]) == sum(r.monetary for r in got["kpi06"]) == sum(r.net_volume for r in got["kpi07"]) == changes.kpi07_network_net
    assert sum(r.volume for r in got["kpi02"]) == sum(r.total_value for r in got["kpi08"]) == sum(r.total_value for r in got["kpi09"])
    assert {(r.activation_type, r.account_id) for r in got["kpi13"]} == {("FIRST_TXN_DAY2", "A4"), ("ONBOARDED_NO_TXN_DAY2", "A8")}
    assert [(r.customer_id, r.from_status, r.to_status) for r in got["kpi12"]] == [("C1", "Verified", "Pending")]
    sinks.create_views({"v_kpi01": out["kpi01"]})
    assert spark.sql("SELECT count(*) AS n FROM v_kpi01").first().n == 5
    sinks.write_csv(out["kpi08"], f"{root}/kpi08")
    page = sinks.dashboard("Daily", {"facts": 14}, {"KPI 8": out["kpi08"]}, {"Branches": (out["kpi07"], "branch_id", "net_volume")}, {"Trend": (out["kpi02"], "branch_id", "month", "volume")})
    assert "<polyline" in page and "<rect" in page and "Daily" in page
    shown = serving.views(spark, root, "2026-10-06", "2026-10-02", "day1-baseline", "day2-incremental")
    assert len(shown) == 13 and spark.sql("SELECT count(*) AS n FROM v_fact JOIN dim_customer USING (customer_sk)").first().n == 14
    assert spark.sql("SELECT sum(net_volume) AS v FROM kpi_07_branch_rank_region").first().v == changes.kpi07_network_net
    some = {k: shown[k] for k in ("kpi_04_dormant_accounts", "kpi_09_refund_rate", "kpi_10_dq_scorecard")}
    counts = serving.export(some, f"{root}/csv")
    assert counts == {k: len(got[f"kpi{k[4:6]}"]) for k in some}
    assert spark.read.option("header", True).csv(f"{root}/csv/kpi_09_refund_rate").count() == counts["kpi_09_refund_rate"]
    sizes = [len(page) for page in serving.pages(shown["kpi_10_dq_scorecard"], 3)]
    assert sum(sizes) == counts["kpi_10_dq_scorecard"] and max(sizes) <= 3
    never = serving.views(spark, root, "2020-01-01", "2026-10-02", "day1-baseline", "day2-incremental")
    assert all(r.last_txn_ts is None for r in never["kpi_04_dormant_accounts"].collect())  # another date, the same views
    try:
        assert serving.catalogue(spark, root, "lake_test") == list(serving.TABLES)
        assert spark.sql("SELECT count(*) AS n FROM lake_test.fact_transaction").first().n == 14
    finally:
        spark.sql("DROP DATABASE IF EXISTS lake_test CASCADE")


def test_a_closed_gate_changes_nothing(spark, drops, tmp_path):
    root, (one, two) = str(tmp_path / "lake"), drops
    with pytest.raises(batches.GateError):
        batches.run(spark, root, batch("b1", one, reject_limit=0.05))
    store = Store(spark, root)
    assert batches.status(store, "b1")["status"] == "FAILED" and store.latest(batches.POINTER) == (0, None)
    assert batches.run(spark, root, batch("b1", one)) == "LOADED"
    before = store.latest(batches.POINTER)
    with pytest.raises(batches.GateError):
        batches.run(spark, root, batch("b2", two, load_type="incremental"))  # no cutoff
    assert store.latest(batches.POINTER) == before


class Killed(BaseException):
    """What ends a run without letting it say anything."""


@pytest.mark.parametrize("where", ["copy_in", "_load", "append", "write_json"])
def test_a_killed_batch_may_come_again(spark, drops, tmp_path, monkeypatch, where):
    """Killed after RECEIVED, while PROCESSING, before its tables are published, and after that but before LOADED."""
    root, (one, _) = str(tmp_path / "lake"), drops
    store = Store(spark, root)

    def kill(*a, **k):
        raise Killed

    with monkeypatch.context() as m:
        if where in ("copy_in", "_load"):
            m.setattr(batches, where, kill)
        elif where == "append":
            append = Store.append
            m.setattr(Store, where, lambda self, log, after, value: kill() if log == batches.POINTER else append(self, log, after, value))
        else:
            write = Store.write_json
            m.setattr(Store, where, lambda self, name, value: kill() if "audit" in name else write(self, name, value))
        m.setattr(batches.Lock, "say", (lambda say: lambda self, **v: say(self, **v) if v["status"] != "FREE" else None)(batches.Lock.say))
        with pytest.raises(Killed):
            batches.run(spark, root, batch("b1", one))
    assert batches.status(store, "b1")["status"] in batches.RUNNING
    with pytest.raises(batches.BusyError):  # its lease has not ended
        batches.run(spark, root, batch("b1", one))
    assert batches.run(spark, root, batch("b1", one), take_over=True) == "LOADED"
    assert batches.gold(store, "fact_transaction").count() == 12 and batches.status(store, "b1")["status"] == "LOADED"
    assert batches.run(spark, root, batch("b1", one)) == "SKIPPED"


def test_two_batches_at_once(spark, drops, tmp_path, monkeypatch):
    """The second is turned away while the first holds the lock; a writer that lost its lock cannot publish over another."""
    root, (one, two) = str(tmp_path / "lake"), drops
    assert batches.run(spark, root, batch("b1", one)) == "LOADED"
    store, load = Store(spark, root), batches._load
    second = batch("b2", two, load_type="incremental", cutoff=datetime(2026, 10, 2))
    third = batch("b3", two, load_type="incremental", cutoff=datetime(2026, 10, 3))
    seen = []

    def slow(s, b, *a):
        if b.batch_id == "b2" and not seen:
            with pytest.raises(batches.BusyError):
                batches.run(spark, root, third)
            seen.append(batches.run(spark, root, third, take_over=True))
        return load(s, b, *a)

    monkeypatch.setattr(batches, "_load", slow)
    with pytest.raises(batches.BusyError):
        batches.run(spark, root, second)
    assert seen == ["LOADED"] and store.latest(batches.POINTER)[1]["batches"] == ["b1", "b3"] and batches.status(store, "b2")["status"] == "FAILED"
    assert batches.run(spark, root, second) == "LOADED" and batches.gold(store, "fact_transaction").count() == 14


def test_logs(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    assert store.create("a/x.json", {"n": 1}) and not store.create("a/x.json", {"n": 2}) and store.read_json("a/y.json") is None
    assert store.latest("log") == (0, None) and store.append("log", 0, {"n": 1}) and not store.append("log", 0, {"n": 2}) and store.append("log", 1, {"n": 3})
    (tmp_path / "log" / "000000000003.json").write_text('{"n":')  # its writer died
    assert store.latest("log") == (3, {"n": 3}) and store.append("log", 3, {"n": 4}) and store.latest("log") == (4, {"n": 4})
    (tmp_path / "raw").write_bytes(b"abc" * 100_000)
    assert store.copy(f"{tmp_path}/raw", "copied") == store.checksum("copied") == (300_000, hashlib.sha256(b"abc" * 100_000).hexdigest())


def test_readers(spark, tmp_path):
    (tmp_path / "p.json").write_text("no json")
    rows, repaired = readers.json_array(spark, f"{tmp_path}/p.json", ["a"])
    assert rows.count() == 0 and not repaired.first().repaired
    (tmp_path / "q.json").write_text('[{"a": 1}\n{"a": true}\n{"a": "1"}, {"a": null}, {}, {"a": 1.5}, {"a": [1]}]')
    rows, repaired = readers.json_array(spark, f"{tmp_path}/q.json", ["a"], ("a",))
    assert [(r.a, r.a_kind) for r in rows.orderBy("_src_row").collect()] == [("1", "number"), ("true", "boolean"), ("1", "string"), (None, "null"), (None, None), ("1.5", "number"), ("[1]", "other")] and repaired.first().repaired
    (tmp_path / "c.csv").write_text('b,a,c\n1,,x\n"x, ""y""","line one\nline two",\n"",2\n')
    got = readers.csv_text(spark, f"{tmp_path}/c.csv", ["a", "b"]).collect()
    assert [(r.a, r.b, r._src_row) for r in got] == [("", "1", 2), ("line one\nline two", 'x, "y"', 3), ("2", "", 4)] and json.loads(got[0]._raw) == {"a": "", "b": "1", "c": "x"}
    many = readers.with_positions(spark.range(0, 1000, 1, 7).withColumnRenamed("id", "n"), 5)
    assert many.filter("_src_row <> n + 5").count() == 0 and many.count() == 1000


def test_products_of_a_file_keep_their_kinds(spark, tmp_path):
    """Numbers are no booleans, and launch dates may not lie in the future."""
    given = ["1", "true", '"1"', "null", '"no"', '"?"']
    items = [f'{{"product_id": "p{i}", "product_name": "P", "product_type": "Loan", "price": 5, "launch_date": "2020-01-01", "is_active": {v}, "category": "SME", "vendor_name": "V"}}' for i, v in enumerate(given)]
    items.append(items[0].replace("p0", "p9").replace("2020-01-01", "2090-01-02"))
    (tmp_path / "products_json.txt").write_text("[" + ",".join(items) + "]")
    raw = readers.json_array(spark, f"{tmp_path}/products_json.txt", list(entities.PRODUCTS.raw), ("is_active",))[0]
    got = {r.product_id: r for r in entities.products(raw).collect()}
    assert [(got[f"P{i}"].is_active, got[f"P{i}"].dq_flags) for i in range(6)] == [(False, "IS_ACTIVE_DEFAULTED"), (True, ""), (True, ""), (False, "IS_ACTIVE_DEFAULTED"), (False, ""), (False, "IS_ACTIVE_DEFAULTED")]
    assert got["P9"].first_error.rule_id == "PR-LAUNCH"


def test_arrivals(spark, drops, tmp_path):
    root, (one, two) = str(tmp_path / "lake"), drops
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    for name, files, kind, cut in (("day1", one, "baseline", None), ("day2", two, "incremental", "2026-10-02T00:00:00")):
        (inbox / f"{name}.json").write_text(json.dumps({"batch_id": name, "load_type": kind, "dt": "2026-10-01", "cutoff": cut, "files": files}))
    (inbox / "bad.json").write_text("{ no description")
    late = {"customers": f"{tmp_path}/late.csv"} | {k: v for k, v in two.items() if k != "customers"}
    (inbox / "day3.json").write_text(json.dumps({"batch_id": "day3", "load_type": "incremental", "dt": "2026-10-03", "cutoff": "2026-10-03T00:00:00", "files": late}))
    for _ in range(2):  # the second call sees nothing new
        q = watch(spark, str(inbox), root, str(tmp_path / "seen"))
        q.awaitTermination(600)
        assert q.exception() is None
    store = Store(spark, root)
    assert [batches.status(store, n)["status"] for n in ("day1", "day2", "day3")] == ["LOADED", "LOADED", "FAILED"]
    assert len([n for n in store.names(DEAD) if n.endswith(".json")]) == 2
    (tmp_path / "late.csv").write_text(CUSTOMERS + customer(9))
    assert sorted(redrive(spark, root).values()) == ["DEAD", "LOADED"] and batches.status(store, "day3")["status"] == "LOADED"
    assert store.read_json("control/audit/day3.json")["results"]["customers"]["clean"] == 1
