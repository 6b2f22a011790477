"""Golden outputs of the reports on the small data set, in report order."""

from datetime import datetime
from decimal import Decimal

import pytest

from tallyline.operators import reports
from tests.seed import frame, seed_tables


@pytest.fixture(scope="module")
def t(spark):
    return seed_tables(spark)


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_revenue_by_month(t):
    report = reports.revenue_by_month(t.invoices, t.subscriptions, t.plans, t.tenants)
    found = [
        (r["tenant_name"], r["plan_name"], r["billing_month"].strftime("%Y-%m"), r["total_cents"], r["invoice_count"])
        for r in report.collect()
    ]
    assert found == [
        ("Kiln & Kettle", "studio", "2025-07", 11250, 1), ("Kiln & Kettle", "studio", "2025-08", 11250, 1),
        ("Kiln & Kettle", "studio", "2025-09", 11250, 1), ("Marrow Labs", "team", "2025-07", 3750, 1),
        ("Osprey Freight", "fleet", "2025-02", 71880, 1), ("Quillwright", "team", "2024-01", 3750, 1),
        ("Quillwright", "team", "2024-06", 3750, 1), ("Quillwright", "studio", "2025-08", 11250, 1),
    ]


def test_revenue_for_month(t):
    def report(month):
        df = reports.revenue_for_month(t.invoices, t.subscriptions, t.plans, t.tenants, month)
        return rows(df, "tenant_name", "total_cents", "total_dollars")

    assert report("2025-10") == []
    assert report("2025-07") == [
        ("Kiln & Kettle", 11250, Decimal("112.50")), ("Marrow Labs", 3750, Decimal("37.50")),
    ]


def test_same_named_tenants_share_a_row_of_the_month_report(spark, t):
    twin = frame(spark, "tenants", [("t9", "Kiln & Kettle", "kiln-two", "2024-01-01 00:00:00", None)])
    sub = frame(spark, "subscriptions", [
        ("s9", "t9", "p3", "active", "2025-01-01 00:00:00", "2025-02-01 00:00:00", None, "2024-01-01 00:00:00"),
    ])
    inv = frame(spark, "invoices", [
        ("i99", "t9", "s9", 100, "paid", "2025-07-08", "2025-07-02 00:00:00", "2025-07-01 00:00:00"),
    ])
    report = reports.revenue_for_month(
        t.invoices.union(inv), t.subscriptions.union(sub), t.plans, t.tenants.union(twin), "2025-07",
    )
    assert ("Kiln & Kettle", 11350) in rows(report, "tenant_name", "total_cents")


def test_lifetime_revenue(t):
    report = reports.lifetime_revenue(t.invoices, t.tenants)
    assert rows(report, "tenant_name", "total_invoices_paid", "lifetime_cents") == [
        ("Osprey Freight", 1, 71880), ("Kiln & Kettle", 3, 33750), ("Quillwright", 3, 18750), ("Marrow Labs", 1, 3750),
    ]
    kiln = report.where("tenant_id = 't1'").collect()[0]
    assert kiln["first_payment_at"] == datetime(2025, 7, 6, 8, 12)
    assert kiln["most_recent_payment_at"] == datetime(2025, 9, 4, 12, 30)


def test_outstanding_balance(t):
    report = reports.outstanding_balance(t.tenants, t.subscriptions, t.plans, t.invoices, as_of="2025-10-18")
    assert rows(
        report, "tenant_name", "plan_name", "outstanding_cents", "open_invoice_count", "days_remaining_in_period",
    ) == [
        ("Kiln & Kettle", "studio", 11250, 1, 15), ("Quillwright", "studio", 11250, 1, 2),
        ("Osprey Freight", "fleet", 0, 0, 118), ("Tin Orchard", "team", 0, 0, -18),
    ]


def test_equal_looking_subscriptions_share_a_balance_row(spark, t):
    sub = frame(spark, "subscriptions", [
        ("s8", "t5", "p2", "trialing", "2025-09-02 00:00:00", "2025-09-30 23:59:59", None, "2025-09-03 00:00:00"),
    ])
    inv = frame(spark, "invoices", [
        ("i98", "t5", "s8", 500, "open", "2025-04-08", None, "2025-04-01 00:00:00"),
        ("i97", "t5", "s6", 700, "open", "2025-04-08", None, "2025-04-01 00:00:00"),
    ])
    report = reports.outstanding_balance(
        t.tenants, t.subscriptions.union(sub), t.plans, t.invoices.union(inv), as_of="2025-10-18",
    ).where("tenant_id = 't5'")
    assert rows(report, "outstanding_cents", "open_invoice_count") == [(1200, 2)]


def test_renewals_due(t):
    report = reports.renewals_due(t.tenants, t.subscriptions, t.plans, as_of="2025-10-16 00:00:00")
    assert rows(report, "tenant_name", "renewal_amount_cents", "days_until_renewal") == [
        ("Quillwright", 11250, 4),
    ]
    # Both ends of the window belong to it.
    at_end = reports.renewals_due(t.tenants, t.subscriptions, t.plans, as_of="2025-10-20 23:59:59")
    a_week_before = reports.renewals_due(t.tenants, t.subscriptions, t.plans, as_of="2025-10-13 23:59:59")
    assert at_end.count() == a_week_before.count() == 1


def test_plan_mrr(t):
    report = reports.plan_mrr(t.subscriptions, t.plans, t.tenants)
    assert [tuple(r) for r in report.collect()] == [
        ("studio", "monthly", Decimal("112.50"), 2, Decimal("225.00")),
        ("fleet", "annual", Decimal("718.80"), 1, Decimal("59.90")),
    ]


def test_invoice_history(t):
    report = reports.invoice_history(t.tenants, t.subscriptions, t.plans, t.invoices)
    found = rows(report, "tenant_name", "invoice_id")
    names = [name for name, _ in found]
    assert names == (
        ["Kiln & Kettle"] * 4 + ["Marrow Labs"] * 2 + ["Osprey Freight"] + ["Quillwright"] * 5 + ["Tin Orchard"]
    )
    assert ("Tin Orchard", None) in found
    assert [i for name, i in found if name == "Quillwright"] == ["i8", "i9", "i10", "i11", "i12"]


def test_invoice_history_keeps_a_tenant_without_subscription(spark, t):
    lone = frame(spark, "tenants", [("t8", "Lone", "lone", "2024-01-01 00:00:00", None)])
    report = reports.invoice_history(t.tenants.union(lone), t.subscriptions, t.plans, t.invoices)
    assert rows(report.where("tenant_name = 'Lone'"), "subscription_id", "plan_name", "invoice_id") == [
        (None, None, None),
    ]


def test_invoice_history_of_one_tenant(t):
    report = reports.invoice_history(t.tenants, t.subscriptions, t.plans, t.invoices, tenant_id="t4")
    assert rows(report, "plan_name", "invoice_id", "invoice_status") == [
        ("team", "i8", "paid"), ("team", "i9", "paid"), ("team", "i10", "void"),
        ("studio", "i11", "paid"), ("studio", "i12", "open"),
    ]
    assert "tenant_name" not in report.columns
    gone = reports.invoice_history(t.tenants, t.subscriptions, t.plans, t.invoices, tenant_id="t6")
    assert gone.count() == 0


def test_outstanding_invoices(t):
    report = reports.outstanding_invoices(t.invoices, t.subscriptions, t.plans, t.tenants, as_of="2025-10-18")
    assert rows(report, "tenant_name", "amount_dollars", "days_overdue") == [
        ("Quillwright", Decimal("112.50"), 17), ("Kiln & Kettle", Decimal("112.50"), 5),
    ]


def test_usage_by_cycle(t):
    report = reports.usage_by_cycle(t.api_usage_events, t.tenants, t.subscriptions, t.plans, as_of="2025-10-18")
    found = sorted(
        rows(report, "tenant_id", "endpoint", "total_calls", "api_limit", "calls_remaining", "pct_limit_consumed"),
        key=lambda r: r[:2],
    )
    assert found == [
        ("t1", "/v2/orders", 75, None, None, None), ("t1", "/v2/refunds", 9, None, None, None),
        ("t2", "/v2/orders", 125, None, None, None),
        ("t3", "/v2/exports", 15300, 18000, 2700, Decimal("85.00")),
        ("t4", "/v2/orders", 12, None, None, None), ("t4", "/v2/users", 106, None, None, None),
        ("t5", "/v2/orders", 27, 18000, 17973, Decimal("0.15")),
    ]


def test_an_open_ended_cycle_makes_no_more_months_than_usage_has(spark, t):
    subs = frame(spark, "subscriptions", [
        ("x1", "t1", "p2", "active", "2025-10-01 00:00:00", "9999-12-31 00:00:00", None, "2024-01-01 00:00:00"),
    ])
    report = reports.usage_by_cycle(t.api_usage_events, t.tenants, subs, t.plans, as_of="2025-10-18")
    assert sorted(rows(report, "endpoint", "total_calls")) == [("/v2/orders", 75), ("/v2/refunds", 9)]
    assert reports._by_month(subs.selectExpr("current_period_start AS period_start", "current_period_end AS period_end"), t.api_usage_events).count() == 1
    none = reports.usage_by_cycle(t.api_usage_events.limit(0), t.tenants, subs, t.plans, as_of="2025-10-18")
    assert none.count() == 0


def test_usage_cycle_is_half_open_and_overlaps_count_twice(spark, t):
    subs = frame(spark, "subscriptions", [
        ("x1", "t1", "p2", "active", "2025-01-31 10:00:00", "2025-03-01 00:00:00", None, "2024-01-01 00:00:00"),
        ("x2", "t1", "p2", "trialing", "2025-02-28 00:00:00", "2025-04-01 00:00:00", None, "2024-01-01 00:00:00"),
        ("x3", "t1", "p2", "active", "2025-03-05 00:00:00", "2025-03-01 00:00:00", None, "2024-01-01 00:00:00"),
    ])
    usage = frame(spark, "api_usage_events", [
        ("e1", "t1", "2025-01-31 09:00:00", "/a", 1), ("e2", "t1", "2025-01-31 10:00:00", "/a", 10),
        ("e3", "t1", "2025-02-28 23:00:00", "/a", 100), ("e4", "t1", "2025-03-01 00:00:00", "/a", 1000),
        ("e5", "t1", "2025-04-01 00:00:00", "/a", 10000),
    ])
    report = reports.usage_by_cycle(usage, t.tenants, subs, t.plans, as_of="2025-10-18")
    assert sorted(rows(report, "subscription_id", "total_calls")) == [("x1", 110), ("x2", 1100)]
