"""Rules kept up by folder against the whole validation."""

import pytest
from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.broken import broken_tables
from tallyline import scratch_dir
from tallyline.operators import kept_rules, rules, usage
from tallyline.sources.lake import delete_path, read_monthly, write_monthly
from tallyline.sources.schema import MONTHLY, schema_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def frames(spark):
    return broken_tables(spark, SF)


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize("table", sorted(set(MONTHLY) - {"api_usage_events"}))
def test_kept_rules_equal_the_whole_validation(spark, frames, table):
    root, time = scratch_dir(spark, "test"), MONTHLY[table]
    source, path, schema = f"{root}/data", f"{root}/kept", schema_of(table, fx.KEY)

    def check(refs=frames):
        read = kept_rules.refresh_months(spark, table, source, path, fx.KEY)
        assert same(kept_rules.violations(spark, table, path, refs), rules.validate(table, read_monthly(spark, source, schema), refs))
        return read

    rows = frames[table]
    write_monthly(rows.where(F.month(time) % 2 == 0), time, source)
    first = check()
    assert first and check() == []
    # Rows that come to a month, some of them again, and a month of rows without a time.
    month = first[0]
    more = rows.where(F.date_format(time, "yyyy-MM") == month)
    nameless = more.limit(3).withColumn(time, F.lit(None).cast("timestamp"))
    write_monthly(more.unionByName(nameless), time, source)
    assert set(check()) == {month, "__HIVE_DEFAULT_PARTITION__"}
    assert check({**frames, "tenants": frames["tenants"].where("id % 2 = 0"), "subscriptions": frames["subscriptions"].limit(5)}) == []
    delete_path(spark, f"{source}/month={month}")
    assert check() == [] and check({}) == []


def test_usage_is_validated_by_the_days_that_changed(spark, frames):
    root = scratch_dir(spark, "test")
    source, path = f"{root}/usage", f"{root}/kept"
    rows = frames["api_usage_events"].dropDuplicates(["tenant_id", "recorded_at", "endpoint"])

    def check():
        read = kept_rules.refresh_usage(spark, source, path, fx.KEY)
        assert same(kept_rules.violations(spark, "api_usage_events", path, frames),
                    rules.validate("api_usage_events", usage.read_usage(spark, source, fx.KEY), frames))
        return read

    usage.upsert_usage(spark, source, rows.where("day(recorded_at) <= 20"), fx.KEY)
    assert len(check()) > 10 and check() == []
    fixed = rows.where("day(recorded_at) = 20").withColumn("event_count", F.lit(1))
    usage.upsert_usage(spark, source, fixed.unionByName(rows.where("day(recorded_at) = 21").withColumn("tenant_id", F.lit(-5).cast("long"))), fx.KEY)
    assert {d[-2:] for d in check()} == {"20", "21"}


def test_nothing_yet(spark):
    root = scratch_dir(spark, "test")
    assert kept_rules.refresh_months(spark, "invoices", f"{root}/none", f"{root}/kept") == []
    assert kept_rules.violations(spark, "invoices", f"{root}/kept").count() == 0
