"""Every registered query equals its SQL on DuckDB, and its plan has no forbidden step."""

import os

import pytest

from tests import oracle
from tidemark.catalogue import ALL

SF_DIR = os.environ.get("CATALOGUE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ALL))
def test_query_equals_sql(spark, con, name):
    # On the smallest tables a query may find nothing; then the SQL must agree.
    assert oracle.compare(ALL[name], spark, con, SF_DIR) in (None, "no rows")


@pytest.mark.parametrize("name", sorted(ALL))
def test_plan_has_no_cross_join_and_no_python(spark, name):
    plan = ALL[name].run(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for step in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert step not in plan


def test_entry_points_agree():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 70
