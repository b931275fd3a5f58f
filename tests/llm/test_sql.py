import pytest
from tests.compare import assert_same, oracle
from tests.llm.samples import SF

from tidemark.llm.queries import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def con():
    return oracle(SF)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_agrees_with_sql(spark, con, name):
    assert_same(QUERIES[name](spark, SF), con, ORACLE_SQL[name])


def test_ten_operators_and_the_pipeline_are_registered():
    assert {q.split("_")[0] for q in QUERIES} == {f"op{i}" for i in range(1, 11)} | {"pipeline"}
