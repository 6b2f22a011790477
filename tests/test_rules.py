"""Each bad row breaks exactly the rule it should; the small data set breaks none."""

import pytest

from tallyline.operators import rules
from tests.seed import frame, seed_tables

_T = "2025-01-15 10:00:00"
_BEFORE = "2025-01-14 10:00:00"
_SUB = ("active", "2025-04-01 00:00:00", "2025-05-01 00:00:00")


@pytest.fixture(scope="module")
def t(spark):
    return dict(seed_tables(spark).items())


def broken(spark, t, table, *bad):
    df = t[table].union(frame(spark, table, bad))
    refs = {**t, table: df}
    listed = {(r["rule"], r["key"]): r["rows"] for r in rules.validate(table, df, refs).collect()}
    counted = {r["rule"]: r["violations"] for r in rules.table_summary(table, df, refs).collect() if r["violations"]}
    assert sum(counted.values()) == len(listed)
    assert set(counted) == {rule for rule, _ in listed}
    return listed


def test_the_seed_is_clean_and_every_rule_is_counted(t):
    summary = rules.rule_summary(t).collect()
    assert {r["rule"]: r["violations"] for r in summary if r["violations"]} == {}
    # The rollup's key rule belongs to a table that is not among the base tables.
    assert len(summary) == rules.RULE_COUNT - 1


# Table, bad rows, the rule they break and the key reported.
CASES = {
    "duplicate slug": ("tenants", [("x", "Dupe", "kiln-kettle", _T, None)], "slug_unique", "kiln-kettle"),
    "upper-case slug": ("tenants", [("x", "Bad", "Bad-Slug", _T, None)], "slug_format", "x"),
    "slug with space": ("tenants", [("x", "Bad", "bad slug", _T, None)], "slug_format", "x"),
    "slug with final hyphen": ("tenants", [("x", "Bad", "bad-slug-", _T, None)], "slug_format", "x"),
    "slug with two hyphens": ("tenants", [("x", "Bad", "bad--slug", _T, None)], "slug_format", "x"),
    "empty slug": ("tenants", [("x", "Bad", "", _T, None)], "slug_format", "x"),
    "slug with final newline": ("tenants", [("x", "Bad", "bad-slug\n", _T, None)], "slug_format", "x"),
    "tenant deleted before created": ("tenants", [("x", "P", "paradox", _T, _BEFORE)], "deleted_after_created", "x"),
    "tenant without name": ("tenants", [("x", None, "no-name", _T, None)], "name_not_null", "x"),
    "negative price": ("plans", [("x", "neg", -1, "monthly", None, True, _T)], "price_not_negative", "x"),
    "weekly cycle": ("plans", [("x", "wk", 1000, "weekly", None, True, _T)], "billing_cycle_known", "x"),
    "zero limit": ("plans", [("x", "zero", 1000, "monthly", 0, True, _T)], "api_limit_positive", "x"),
    "negative limit": ("plans", [("x", "neg", 1000, "monthly", -100, True, _T)], "api_limit_positive", "x"),
    "duplicate plan name": ("plans", [("x", "studio", 999, "monthly", None, True, _T)], "name_unique", "studio"),
    "duplicate e-mail in tenant": (
        "users", [("x", "t1", "d@example.com", "admin", _T, None), ("y", "t1", "d@example.com", "member", _T, None)],
        "email_unique_in_tenant", "t1|d@example.com",
    ),
    "unknown role": ("users", [("x", "t1", "r@example.com", "superuser", _T, None)], "role_known", "x"),
    "malformed e-mail": ("users", [("x", "t1", "notanemail", "member", _T, None)], "email_format", "x"),
    "user deleted before created": (
        "users", [("x", "t1", "p@example.com", "member", _T, _BEFORE)], "deleted_after_created", "x",
    ),
    "user of unknown tenant": ("users", [("x", "t0", "g@example.com", "member", _T, None)], "tenant_id_exists", "t0"),
    "unknown subscription status": (
        "subscriptions", [("x", "t5", "p2", "expired", *_SUB[1:], None, _T)], "status_known", "x",
    ),
    "period ends before it starts": (
        "subscriptions", [("x", "t5", "p2", "active", _SUB[1], "2025-03-31 00:00:00", None, _T)], "period_order", "x",
    ),
    "cancelled without date": (
        "subscriptions", [("x", "t5", "p2", "cancelled", *_SUB[1:], None, _T)], "cancelled_has_date", "x",
    ),
    "active with cancel date": (
        "subscriptions", [("x", "t5", "p2", *_SUB, "2025-02-01 00:00:00", _T)], "cancelled_has_date", "x",
    ),
    "subscription to unknown plan": (
        "subscriptions", [("x", "t5", "p0", *_SUB, None, _T)], "plan_id_exists", "p0",
    ),
    "second active subscription": (
        "subscriptions", [("x", "t1", "p2", *_SUB, None, _T)], "one_active_per_tenant", "t1",
    ),
    "negative amount": (
        "invoices", [("x", "t1", "s1", -1, "open", "2025-02-01", None, _T)], "amount_not_negative", "x|2025-01-15 10:00:00",
    ),
    "unknown invoice status": (
        "invoices", [("x", "t1", "s1", 1, "overdue", "2025-02-01", None, _T)], "status_known", "x|2025-01-15 10:00:00",
    ),
    "paid without date": (
        "invoices", [("x", "t1", "s1", 1, "paid", "2025-02-01", None, _T)], "paid_has_date", "x|2025-01-15 10:00:00",
    ),
    "open with payment date": (
        "invoices", [("x", "t1", "s1", 1, "open", "2025-02-01", _T, _T)], "paid_has_date", "x|2025-01-15 10:00:00",
    ),
    "due before created": (
        "invoices", [("x", "t1", "s1", 1, "open", "2020-01-01", None, _T)], "due_after_created", "x|2025-01-15 10:00:00",
    ),
    "invoice of unknown subscription": (
        "invoices", [("x", "t1", "s0", 1, "open", "2025-02-01", None, _T)], "subscription_id_exists", "s0",
    ),
    "empty bucket": (
        "api_usage_events", [("x", "t1", "2025-05-01 09:00:00", "/a", 0)], "count_positive", "x|2025-05-01 09:00:00",
    ),
    "bucket off the hour": (
        "api_usage_events", [("x", "t1", "2025-05-01 09:30:00", "/a", 1)], "on_the_hour", "x|2025-05-01 09:30:00",
    ),
    "repeated bucket": (
        "api_usage_events",
        [("x", "t1", "2025-05-01 09:00:00", "/a", 1), ("y", "t1", "2025-05-01 09:00:00", "/a", 2)],
        "bucket_unique", "t1|2025-05-01 09:00:00|/a",
    ),
    "status change to itself": (
        "billing_audit_log", [("x", "invoices", "i1", "system", "open", "open", _T)], "status_differs", "x",
    ),
    "change to the same plan": (
        "plan_change_events", [("x", "t1", "s1", "p2", "p2", _T, 1, 30, 1, 2, 1, _T)], "plans_differ", "x",
    ),
    "net is not the difference": (
        "plan_change_events", [("x", "t1", "s1", "p2", "p3", _T, 1, 30, 1, 2, 5, _T)], "net_is_difference", "x",
    ),
}


@pytest.mark.parametrize("case", CASES)
def test_a_bad_row_breaks_its_rule(spark, t, case):
    table, bad, rule, key = CASES[case]
    assert set(broken(spark, t, table, *bad)) == {(rule, key)}


ACCEPTED = {
    "same e-mail in two tenants": (
        "users", [("x", "t1", "s@example.com", "admin", _T, None), ("y", "t2", "s@example.com", "admin", _T, None)],
    ),
    "second cancelled subscription": (
        "subscriptions", [("x", "t1", "p2", "cancelled", *_SUB[1:], "2025-02-01 00:00:00", _T)],
    ),
    "plan name in other case": ("plans", [("x", "STUDIO", 999, "monthly", None, True, _T)]),
}


@pytest.mark.parametrize("case", ACCEPTED)
def test_good_rows_are_accepted(spark, t, case):
    table, rows = ACCEPTED[case]
    assert broken(spark, t, table, *rows) == {}


def test_plan_names_may_be_compared_without_case(spark, t):
    df = t["plans"].union(frame(spark, "plans", [("x", "STUDIO", 999, "monthly", None, True, _T)]))
    assert [r["key"] for r in rules.validate("plans", df, ignore_name_case=True).collect()] == ["studio"]


def test_rollup_key(spark):
    rollup = spark.createDataFrame([("s1", "/a"), ("s1", "/b"), ("s1", "/a")], "subscription_id string, endpoint string")
    assert [(r["rule"], r["key"], r["rows"]) for r in rules.validate("usage_by_cycle", rollup).collect()] == [
        ("primary_key", "s1|/a", 2),
    ]


def test_a_slug_of_any_length_is_checked(spark, t):
    long = [("x", "Long", "-".join(["ab"] * 20_000), _T, None), ("y", "Long", "-".join(["ab"] * 20_000) + "-", _T, None)]
    assert set(broken(spark, t, "tenants", *long)) == {("slug_format", "y")}


def test_overlapping_periods(spark, t):
    found = lambda df: {(r["subscription_id"], str(r["busy_until"])) for r in rules.overlapping_periods(df).collect()}
    assert found(t["subscriptions"]) == set()
    more = frame(spark, "subscriptions", [
        ("x1", "t5", "p2", "trialing", "2025-09-29 00:00:00", "2025-10-05 00:00:00", None, _T),
        ("x2", "t5", "p2", "trialing", "2025-10-05 00:00:00", "2025-10-06 00:00:00", None, _T),
    ])
    assert found(t["subscriptions"].union(more)) == {("x1", "2025-09-30 23:59:59")}


def test_ledger_edits(spark, t):
    before = t["invoices"]
    settled = before.where("id <> 'i1'").selectExpr(
        "id", "tenant_id", "subscription_id", "IF(id = 'i2', 1, amount_cents) AS amount_cents",
        "IF(id = 'i6', 'void', status) AS status", "due_date", "paid_at", "created_at",
    )
    assert {(r["id"], r["edit"]) for r in rules.ledger_edits(before, settled).collect()} == {
        ("i1", "removed"), ("i2", "changed"),
    }


def test_new_subscriptions_on_a_retired_plan(spark, t):
    sub = frame(spark, "subscriptions", [("x", "t5", "p5", *_SUB, None, _T)])
    found = rules.retired_plan_subscriptions(t["subscriptions"].union(sub), t["plans"], "2025-01-01")
    assert [(r["subscription_id"], r["plan_name"]) for r in found.collect()] == [("x", "team-2019")]
