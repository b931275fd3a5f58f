import pytest
from tests.compare import assert_same, oracle

from tidemark.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_agrees_with_sql(spark, con, name):
    assert_same(QUERIES[name](spark, SF), con, ORACLE_SQL[name])


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 5
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_filters_and_columns_reach_the_scan(spark):
    plan = QUERIES["topk_limit"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan
    plan = QUERIES["distinct_accounts"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_type,error)" in plan


def test_single_passes_over_the_facts(spark):
    """The indicators that share sums read the line items once; reconciliation reads them once more to count new rows."""
    for name, most in (("kpi02_branch_trend", 1), ("kpi03_product_revenue", 1), ("snapshot_delta", 1), ("kpi11_reconciliation", 2)):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("l_orderkey#") and sum("lineitem.parquet" in line and "FileScan" in line for line in plan.splitlines()) <= most, name


def test_indicators_are_in_order(spark):
    got = [(r.region, r.rnk, r.branch_id) for r in QUERIES["kpi07_branch_rank"](spark, SF).collect()]
    assert got == sorted(got)
    got = [(r.refund_value_pct is None, -(r.refund_value_pct or 0)) for r in QUERIES["kpi09_refund_rate"](spark, SF).collect()]
    assert got == sorted(got)
