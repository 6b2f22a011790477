"""Month folders: pruning, coverage, quarantine, re-layout, archive."""

from functools import reduce

import pytest
from pyspark.sql import functions as F

from checks import lake_queries
from tallyline import scratch_dir
from tallyline.functions import month_range, shift_month
from tallyline.operators import ledger, lookups
from tallyline.sources import load
from tallyline.sources.lake import delete_path, month_folders, read_monthly, write_monthly
from tallyline.sources.schema import MONTHLY, schema_of
from tests.seed import seed_tables

SCHEMA = schema_of("invoices")


@pytest.fixture(scope="module")
def t(spark):
    return seed_tables(spark)


@pytest.fixture()
def stored(spark, t):
    path = f"{scratch_dir(spark, 'test')}/invoices"
    write_monthly(t.invoices, "created_at", path)
    return path


def ids(df):
    return {r["id"] for r in df.select("id").collect()}


def test_month_arithmetic():
    assert month_range("2023-11", "2024-02") == ["2023-11", "2023-12", "2024-01", "2024-02"]
    assert shift_month("2024-01", -1) == "2023-12"


def test_a_range_reads_only_its_months(spark, stored):
    found = ledger.ledger_between(read_monthly(spark, stored, SCHEMA), "2025-07-05", "2025-09-01")
    assert ids(found) == {"i2", "i6", "i7", "i11"}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "PushedFilters: [IsNotNull(created_at)" in plan


def test_month_boundaries_belong_to_the_later_month(spark, t, stored):
    october = read_monthly(spark, stored, SCHEMA).where("month = '2025-10'")
    assert ids(october) == {"i4"}


def test_coverage(spark, t):
    facts = {"invoices": (t.invoices, "created_at"), "api_usage_events": (t.api_usage_events, "recorded_at")}
    found = [tuple(r) for r in ledger.missing_months(facts, as_of="2025-09-20", ahead=3).collect()]
    assert found == [
        ("api_usage_events", "2025-11"), ("api_usage_events", "2025-12"), ("invoices", "2025-11"),
        ("invoices", "2025-12"),
    ]


def test_quarantine_and_recovery(spark, t):
    root = scratch_dir(spark, "test")
    path, quarantine = f"{root}/invoices", f"{root}/default"
    ledger.write_declared(t.invoices, "created_at", path, quarantine, "2024-06", "2025-07")
    waiting = ledger.out_of_range_rows(t.invoices, "created_at", "2024-06", "2025-07")
    assert ids(read_monthly(spark, quarantine, SCHEMA)) == ids(waiting) == {"i2", "i3", "i4", "i7", "i8", "i11", "i12", "i13"}

    # A run that died between copy and removal: its rows are in both places.
    half = read_monthly(spark, quarantine, SCHEMA).where("id = 'i3'").drop("month")
    write_monthly(half, "created_at", path)
    assert ledger.recover_default(spark, path, quarantine, "2025-09", "created_at", SCHEMA) == (2, 0)
    assert ledger.recover_default(spark, path, quarantine, "2025-09", "created_at", SCHEMA) == (0, 0)
    september = read_monthly(spark, path, SCHEMA).where("month = '2025-09'")
    assert sorted(r["id"] for r in september.collect()) == ["i12", "i3"]
    assert "2025-09" not in month_folders(spark, quarantine)


def test_recovery_never_loses_a_row_that_differs(spark, t):
    root = scratch_dir(spark, "test")
    path, quarantine = f"{root}/invoices", f"{root}/default"
    march = t.invoices.where("id IN ('i3', 'i12')")
    write_monthly(march.where("id = 'i3'"), "created_at", path)
    other = march.where("id = 'i3'").selectExpr("id", "tenant_id", "subscription_id", "amount_cents + 989 AS amount_cents",
                                                "status", "due_date", "paid_at", "created_at")
    write_monthly(march.unionByName(other), "created_at", quarantine)
    for moved in (2, 0):
        assert ledger.recover_default(spark, path, quarantine, "2025-09", "created_at", SCHEMA) == (moved, 1)
    assert sorted(r["id"] for r in read_monthly(spark, path, SCHEMA).collect()) == ["i12", "i3"]
    assert read_monthly(spark, quarantine, SCHEMA).count() == 1


def test_the_archive_only_grows(spark, t):
    root = scratch_dir(spark, "test")
    path, archive = f"{root}/invoices", f"{root}/archive"
    late = t.invoices.where("id = 'i8'")
    write_monthly(t.invoices.where("id <> 'i8'").unionByName(late.selectExpr(
        "'x' AS id", "tenant_id", "subscription_id", "amount_cents", "status", "due_date", "paid_at", "created_at")), "created_at", path)
    def run():
        found = ledger.archive_months(spark, path, archive, "2024-10-01", "created_at", "amount_cents", SCHEMA)
        return {r["month"]: (r["rows"], r["archived_rows"], r["removable"]) for r in found.collect()}
    month = late.selectExpr("date_format(created_at, 'yyyy-MM')").first()[0]
    assert run()[month] == (1, 1, True)
    delete_path(spark, f"{path}/month={month}")
    write_monthly(late, "created_at", path)
    assert run()[month] == (1, 2, True)
    assert {"x", "i8"} <= ids(read_monthly(spark, archive, SCHEMA))


def test_rows_without_an_id_are_archived_and_stay(spark, t):
    root = scratch_dir(spark, "test")
    path, archive = f"{root}/invoices", f"{root}/archive"
    row = t.invoices.where("id = 'i8'")
    month = row.selectExpr("date_format(created_at, 'yyyy-MM')").first()[0]

    def nameless(*amounts):
        return reduce(lambda a, b: a.unionByName(b), [row.withColumns({
            "id": F.lit(None).cast("string"), "amount_cents": F.lit(a)}) for a in amounts]).select(*row.columns)

    def run():
        found = ledger.archive_months(spark, path, archive, "2024-10-01", "created_at", "amount_cents", SCHEMA)
        held = read_monthly(spark, archive, SCHEMA).where(F.col("month") == month)
        return ({r["month"]: r["removable"] for r in found.collect()}.get(month),
                sorted((r["id"] or "-", r["amount_cents"]) for r in held.collect()))

    write_monthly(row.unionByName(nameless(5, 5, 7)), "created_at", path)
    first = [("-", 5), ("-", 5), ("-", 7), ("i8", row.first()["amount_cents"])]
    assert run() == (True, first) and run() == (True, first)
    delete_path(spark, f"{path}/month={month}")
    write_monthly(nameless(5, 9, 9), "created_at", path)
    assert run() == (True, sorted([*first, ("-", 9), ("-", 9)]))
    assert run() == (True, sorted([*first, ("-", 9), ("-", 9)]))


def test_amounts_that_change_places_are_seen(t):
    rows = t.invoices.withColumn("amount_cents", F.when(F.col("id") == "i3", 11).otherwise(F.col("amount_cents")))

    def swapped(a, b):
        amounts = {r["id"]: r["amount_cents"] for r in rows.where(F.col("id").isin(a, b)).collect()}
        new = F.when(F.col("id") == a, amounts[b]).when(F.col("id") == b, amounts[a]).otherwise(F.col("amount_cents"))
        return rows.withColumn("amount_cents", new.cast("int"))

    same = ledger.reconcile(rows, rows.orderBy(F.desc("id")), "created_at", "amount_cents")
    assert all(r["matches"] for r in same.collect())
    found = ledger.reconcile(rows, swapped("i3", "i12"), "created_at", "amount_cents").collect()
    assert [(r["month"], r["source_rows"] == r["target_rows"], r["source_total"] == r["target_total"]) for r in found if not r["matches"]] == [("2025-09", True, True)]
    # A NULL that moves to the next column, a row that stands twice in place of another.
    other = rows.withColumns({"due_date": F.when(F.col("id") != "i5", F.col("due_date"))})
    assert [r["month"] for r in ledger.reconcile(rows, other, "created_at", "amount_cents").collect() if not r["matches"]] == ["2025-02"]
    twice = rows.where("id = 'i3'").unionByName(rows.where("id = 'i3'")).unionByName(rows.where("id NOT IN ('i3', 'i12')"))
    assert [r["month"] for r in ledger.reconcile(rows, twice, "created_at", "amount_cents").collect() if not r["matches"]] == ["2025-09"]


def test_reconciling_joins_no_rows(t):
    plan = ledger.reconcile(t.invoices, t.invoices, "created_at", "amount_cents")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and plan.count("Aggregate") == 2


def test_ranges_written_in_other_ways_prune_the_same_folders(spark, stored):
    table = read_monthly(spark, stored, SCHEMA)
    flat = table.drop("month")
    for start, end in (("2025-7-5", "2025-08-31T20:00:00-05:00"), ("2025-08-01", "2025-09-01"), ("2025-09-01T00:00:00+01:00", "2025-11-1")):
        assert ids(ledger.ledger_between(table, start, end)) == ids(ledger.ledger_between(flat, start, end))
    august = ledger.ledger_between(table, "2025-08-01", "2025-09-01")
    plan = august._jdf.queryExecution().executedPlan().toString()
    assert "(month" in plan and "<= 2025-08)" in plan


def test_coverage_from_a_listing_reads_no_data(spark, stored):
    facts = {"invoices": (read_monthly(spark, stored, SCHEMA), "created_at")}
    listed = ledger.missing_months(facts, as_of="2025-09-20", since="2024-01", stored={"invoices": month_folders(spark, stored)})
    assert [tuple(r) for r in listed.collect()] == [tuple(r) for r in ledger.missing_months(facts, as_of="2025-09-20", since="2024-01").collect()]
    assert "FileScan" not in listed._jdf.queryExecution().executedPlan().toString()


def test_migration_reconciles(spark, t):
    path = f"{scratch_dir(spark, 'test')}/invoices"
    for _ in range(2):
        report = ledger.migrate_to_monthly(spark, t.invoices, path, "created_at", "amount_cents", SCHEMA).collect()
        assert all(r["matches"] for r in report) and sum(r["target_rows"] for r in report) == 13
    off = ledger.reconcile(t.invoices, t.invoices.where("id <> 'i5'"), "created_at", "amount_cents")
    assert {r["month"] for r in off.where("NOT matches").collect()} == {"2025-02"}


def test_archive_keeps_the_original(spark, stored):
    archive = f"{stored}.archive"
    report = ledger.archive_months(spark, stored, archive, "2024-10-01", "created_at", "amount_cents", SCHEMA)
    assert {r["month"]: r["removable"] for r in report.collect()} == {
        "2023-04": True, "2024-01": True, "2024-06": True,
    }
    assert read_monthly(spark, stored, SCHEMA).count() == 13


def test_load_declares_every_table(spark, t):
    root = scratch_dir(spark, "test")
    for table, df in t.items():
        if table in MONTHLY:
            write_monthly(df, MONTHLY[table], f"{root}/{table}")
        else:
            df.write.parquet(f"{root}/{table}")
    loaded = load(spark, root)
    assert {name: df.count() for name, df in loaded.items()} == {name: df.count() for name, df in t.items()}
    assert "month" in loaded.invoices.columns and "month" not in loaded.tenants.columns


def test_lookups(t):
    assert ids(lookups.users_of(t.users, "t4")) == {"u7", "u9"}
    assert ids(lookups.users_of(t.users, "t4", active_only=True)) == {"u7"}
    assert ids(lookups.subscriptions_of(t.subscriptions, "t4")) == {"s4", "s5"}
    assert ids(lookups.subscriptions_of(t.subscriptions, "t4", "active")) == {"s5"}
    assert ids(lookups.subscriptions_ending(t.subscriptions, "2025-09-01", "2025-11-02 23:59:59")) == {"s1", "s5", "s6"}
    assert ids(lookups.subscriptions_on(t.subscriptions, "p3")) == {"s1", "s5"}
    assert ids(lookups.invoices_of(t.invoices, tenant_id="t4", status="open")) == {"i12"}
    assert ids(lookups.invoices_of(t.invoices, subscription_id="s3")) == {"i6", "i7"}
    assert ids(lookups.reported_invoices_between(t.invoices, "2025-05-01", "2025-08-01")) == {"i1", "i6"}
    assert ids(lookups.plan_changes_of(t.plan_change_events, subscription_id="s4")) == {"c1"}
    left = {(r["plan_name"], r["status"]): r["subscriptions"] for r in lookups.plan_subscribers(t.plans, t.subscriptions).collect()}
    assert left["team-2019", None] == 0 and left["team", "cancelled"] == 2


def test_recovery_query_shows_changes_of_other_months(spark, monkeypatch):
    query, recover = lake_queries.LAKE["recover_default_conflicts"], ledger.recover_default
    right = query(spark, "/root/testdata/sf0.001").count()

    def too_much(spark, path, quarantine, *rest):
        delete_path(spark, f"{quarantine}/month=1996-04")
        return recover(spark, path, quarantine, *rest)

    monkeypatch.setattr(ledger, "recover_default", too_much)
    assert query(spark, "/root/testdata/sf0.001").count() > right > 0
