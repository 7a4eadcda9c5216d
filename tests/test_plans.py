"""Plans that must hold at scale: no cross joins, pruned and filtered scans."""

import pytest

from sparkkit import queries as Q

FOLDER = "/root/testdata/sf0.001"


def plan(spark, name):
    return Q.load()[name].run(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["market_basket", "kendall", "regressor_metrics", "range_join_counts", "neighbour_context", "tf_idf", "regressor_terms"])
def test_no_cross_joins(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_scan_reads_only_what_is_used(spark):
    text = plan(spark, "semi_join")
    assert "l_extendedprice" not in text and "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,45.0)" in text
