"""Every registered query against its SQL on the same tables."""

import pytest
from compare import compare, oracle_connection
from conftest import SF_DIR

from logloom.catalog import ORACLES, QUERIES


@pytest.fixture(scope="session")
def con():
    return oracle_connection(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    got = df.toPandas()
    assert compare(got, con.execute(ORACLES[name]).df()) is None
    assert len(got) > 0 or name == "pred_find"
