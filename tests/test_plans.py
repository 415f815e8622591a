"""Plans as they ran: how often a log is read, and that nothing is sorted to be aggregated."""

import pytest

from hitledger.registry.catalog import QUERIES

SF = "/root/testdata/sf0.001"


def ran(spark, name):
    df = QUERIES[name](spark, SF)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan[plan.index("== Final Plan ==") : plan.index("== Initial Plan ==")] if "== Final Plan ==" in plan else plan
    return final


@pytest.mark.parametrize("name, most", [("phantom_reads", 2), ("write_skew_pairs", 2), ("changelog_apply", 2), ("upsert_metrics", 1)])
def test_how_often_the_log_is_read(spark, name, most):
    assert 1 <= ran(spark, name).count("FileScan") <= most


@pytest.mark.parametrize("name", ["upsert_metrics", "phantom_reads", "write_skew_pairs"])
def test_no_aggregate_needs_a_sort(spark, name):
    assert "SortAggregate" not in ran(spark, name)


@pytest.mark.parametrize("name", ["phantom_reads", "resolve_reads", "lock_waits", "dirty_reads_by_writer"])
def test_borders_are_no_subqueries(spark, name):
    assert "Subquery" not in ran(spark, name)
