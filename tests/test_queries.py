import pytest

import __spark_entry__ as contract
from checks.compare import DATA, database, difference

SF = "sf0.001"
SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return database(SF)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query_equals_its_sql(spark, con, name):
    frame = contract.queries()[name](spark, str(DATA / SF))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    ours = frame.toPandas()
    assert len(ours.columns)
    if name in SQL:
        assert difference(ours, con.execute(SQL[name]).df()) is None
    else:
        assert len(ours)


def test_contract(spark):
    assert set(SQL) <= set(contract.queries())
    assert contract.entry(spark).count() >= 1
