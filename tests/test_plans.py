"""Plan-shape guards over every registered query with an oracle: no
cartesian product or nested-loop join, and pruned scans."""

import pytest

import __spark_entry__ as E
from tests.conftest import SMALL

NAMES = sorted(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_no_cross_or_nested_loop_join(spark, name):
    df = E.queries()[name](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_user_tag_score_scans_only_needed_columns(spark):
    df = E.queries()["user_tag_score"](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint,l_quantity:double>" in plan
    assert "PushedFilters: [IsNotNull(l_orderkey)]" in plan
