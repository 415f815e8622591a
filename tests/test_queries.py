"""Every registered query against its SQL, and the shape of the plans."""

import re

import pytest

import __spark_entry__ as contract
import check
from hitledger.registry.catalog import QUERIES
from hitledger.registry.oracle import ORACLE

SF = "/root/testdata/sf0.001"
STREAMS = {"stream_parse", "stream_metrics", "stream_daily", "topic_roundtrip", "metrics_topic"}


@pytest.fixture(scope="module")
def db():
    return check.connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, db, name):
    outcome, _ = check.compare(spark, db, SF, name)
    assert outcome == "ok"


def test_entry(spark):
    assert contract.entry(spark).columns == ["url", "count"]


def plan(spark, name):
    df = contract.queries()[name](spark, SF)
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMS))
def test_no_cross_join_and_no_python(spark, name):
    df = contract.queries()[name](spark, SF)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|Python|Pandas", text)


@pytest.mark.parametrize(
    "name", ["top_pages", "status_shares", "anomalies_strict", "anomalies_inclusive", "url_report", "url_metrics"]
)
def test_a_report_parses_the_log_once(spark, name):
    assert scans(spark, name) == 1


def scans(spark, name):
    text = plan(spark, name).split("== Initial Plan ==")[0]
    return text.count("FileScan")


@pytest.mark.parametrize("name, most", [("daily_statistics", 1), ("upsert_metrics", 1), ("changelog_apply", 2)])
def test_scans_of_the_log(spark, name, most):
    assert scans(spark, name) <= most


def test_only_needed_columns_are_read(spark):
    text = plan(spark, "outcomes")
    assert re.search(r"ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>", text)


def test_top_k_is_cut_before_the_shuffle(spark):
    assert "TakeOrderedAndProject" in plan(spark, "top_pages")
    assert "WindowGroupLimit" in plan(spark, "top_per_group")
