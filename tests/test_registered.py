"""Every registered query against its SQL counterpart, and the shape of some plans."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from checks import fixtures as fx
from checks import oracles, queries
from checks.compare import connect, differences
from tallyline.operators import reports

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = queries.queries(), oracles.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


def test_each_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


def test_one_tenants_history_reads_the_ledger_once_and_gathers_no_keys_of_others(spark):
    plan = plan_of(QUERIES["tenant_invoice_history"](spark, SF))
    assert plan.count("o_orderkey#") and len(re.findall(r"FileScan parquet \[o_", plan)) == 1


@pytest.mark.parametrize("name", QUERIES)
def test_same_result(spark, connection, name):
    assert differences(QUERIES[name](spark, SF), connection, ORACLES[name]) == []


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", ["revenue_by_month", "outstanding_balance", "invoice_history", "usage_by_cycle"])
def test_no_cross_join_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Python" not in plan


def test_scans_read_only_what_the_report_needs(spark):
    plan = plan_of(QUERIES["lifetime_revenue"](spark, SF))
    orders = re.search(r"FileScan parquet \[(o_[^\]]*)\]", plan).group(1)
    assert "o_orderpriority" not in orders


def test_usage_reads_only_the_months_of_the_cycles(spark):
    plan = plan_of(QUERIES["usage_by_cycle_months"](spark, SF))
    assert "dynamicpruning" in plan


def test_the_version_feed_is_shuffled_once(spark):
    plan = plan_of(QUERIES["status_changes_from_feed"](spark, SF))
    assert "ReusedExchange" in plan


def test_a_hot_tenant_changes_nothing_but_the_split(spark):
    """A third of all invoices on one subscription, join partitions split from 1 KB on."""
    hot = fx.invoices(spark, SF).withColumn(
        "subscription_id", F.when(F.col("id") % 3 == 0, 24).otherwise(F.col("subscription_id")),
    )
    owners = [fx.tenants(spark, SF), fx.subscriptions(spark, SF), fx.plans(spark)]
    usual = sorted(map(str, reports.invoice_history(*owners, hot).collect()))
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1b",
    }
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        split = reports.invoice_history(*owners, hot)
        assert sorted(map(str, split.collect())) == usual
        assert "skew=true" in plan_of(split)
    finally:
        for key in conf:
            spark.conf.unset(key)


def test_reports_hold_without_any_broadcast(spark):
    """With broadcasts off, as for dimensions beyond their size bound, results stay the same."""
    names = ["invoices", "subscriptions", "plans", "tenants"]
    frames = {n: fx.plans(spark) if n == "plans" else getattr(fx, n)(spark, SF) for n in names}
    calls = [
        lambda: reports.revenue_by_month(*frames.values()),
        lambda: reports.invoice_history(frames["tenants"], frames["subscriptions"], frames["plans"], frames["invoices"]),
    ]
    usual = [sorted(map(str, call().collect())) for call in calls]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = [call() for call in calls]
        assert [sorted(map(str, df.collect())) for df in shuffled] == usual
        assert all("BroadcastHashJoin" not in plan_of(df) for df in shuffled)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
