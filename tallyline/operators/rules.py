"""Data rules as data, checked over whole tables.

Row rules of a table share one scan. Its key and reference rules share another: all key tuples go
into one grouped count, and only distinct referring keys are looked up. Counts combine before they
shuffle, so a value that fills half a table costs no more than any other. A test that is NULL passes,
and keys with a NULL part are neither duplicates nor dangling.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.months import instant
from tallyline.plans import with_running_max
from tallyline.sources.schema import SCHEMAS, required_columns


class RowRule(NamedTuple):
    table: str
    name: str
    condition: str


class KeyRule(NamedTuple):
    table: str
    name: str
    columns: tuple[str, ...]
    where: str | None = None


class ReferenceRule(NamedTuple):
    table: str
    name: str
    column: str
    target: str


# The rules and the texts and words they allow.
ROW_RULES = [
    # Words of small letters and digits between single hyphens; written so that no length makes the matcher recurse.
    RowRule("tenants", "slug_format", r"slug <> '' AND NOT slug RLIKE r'[^a-z0-9-]|--|^-|-\z'"),
    RowRule("tenants", "deleted_after_created", "deleted_at IS NULL OR deleted_at > created_at"),
    RowRule("plans", "price_not_negative", "price_cents >= 0"),
    RowRule("plans", "billing_cycle_known", "billing_cycle IN ('monthly', 'annual')"),
    RowRule("plans", "api_limit_positive", "api_limit IS NULL OR api_limit > 0"),
    RowRule("users", "email_format", r"email RLIKE r'(?i)^[^@\s]+@[^@\s]+\.[^@\s]+\z'"),
    RowRule("users", "role_known", "role IN ('admin', 'member', 'viewer')"),
    RowRule("users", "deleted_after_created", "deleted_at IS NULL OR deleted_at > created_at"),
    RowRule("subscriptions", "status_known", "status IN ('active', 'cancelled', 'past_due', 'trialing')"),
    RowRule("subscriptions", "period_order", "current_period_end > current_period_start"),
    RowRule("subscriptions", "cancelled_has_date", "(status = 'cancelled') = (cancelled_at IS NOT NULL)"),
    RowRule("subscriptions", "cancelled_after_created", "cancelled_at IS NULL OR cancelled_at >= created_at"),
    RowRule("invoices", "amount_not_negative", "amount_cents >= 0"),
    RowRule("invoices", "status_known", "status IN ('draft', 'open', 'paid', 'void', 'uncollectible')"),
    RowRule("invoices", "paid_has_date", "(status = 'paid') = (paid_at IS NOT NULL)"),
    RowRule("invoices", "paid_after_created", "paid_at IS NULL OR paid_at >= created_at"),
    RowRule("invoices", "due_after_created", "due_date >= CAST(created_at AS DATE)"),
    RowRule("api_usage_events", "count_positive", "event_count > 0"),
    RowRule("api_usage_events", "on_the_hour", "recorded_at = date_trunc('HOUR', recorded_at)"),
    RowRule("billing_audit_log", "table_known", "table_name IN ('subscriptions', 'invoices')"),
    RowRule("billing_audit_log", "status_differs", "old_status <> new_status"),
    RowRule("plan_change_events", "plans_differ", "old_plan_id <> new_plan_id"),
    RowRule("plan_change_events", "days_in_range", "days_remaining > 0 AND days_remaining <= days_in_cycle"),
    RowRule("plan_change_events", "cycle_positive", "days_in_cycle > 0"),
    RowRule("plan_change_events", "credit_not_negative", "credit_cents >= 0"),
    RowRule("plan_change_events", "charge_not_negative", "charge_cents >= 0"),
    RowRule("plan_change_events", "net_is_difference", "net_cents = charge_cents - credit_cents"),
]
ROW_RULES += [
    RowRule(table, f"{column}_not_null", f"{column} IS NOT NULL")
    for table in SCHEMAS for column in required_columns(table)
]

# The month-partitioned facts are keyed by id and time; every other table by id.
PRIMARY_KEYS = {
    **{table: ("id",) for table in SCHEMAS},
    "invoices": ("id", "created_at"),
    "api_usage_events": ("id", "recorded_at"),
    "usage_by_cycle": ("subscription_id", "endpoint"),
}
KEY_RULES = [KeyRule(table, "primary_key", columns) for table, columns in PRIMARY_KEYS.items()]
KEY_RULES += [
    KeyRule("tenants", "slug_unique", ("slug",)),
    KeyRule("plans", "name_unique", ("name",)),
    KeyRule("users", "email_unique_in_tenant", ("tenant_id", "email")),
    KeyRule("subscriptions", "one_active_per_tenant", ("tenant_id",), "status = 'active'"),
    KeyRule("api_usage_events", "bucket_unique", ("tenant_id", "recorded_at", "endpoint")),
]

REFERENCE_RULES = [
    ReferenceRule(table, f"{column}_exists", column, target)
    for table, column, target in [
        ("users", "tenant_id", "tenants"),
        ("subscriptions", "tenant_id", "tenants"),
        ("subscriptions", "plan_id", "plans"),
        ("invoices", "tenant_id", "tenants"),
        ("invoices", "subscription_id", "subscriptions"),
        ("api_usage_events", "tenant_id", "tenants"),
        ("plan_change_events", "tenant_id", "tenants"),
        ("plan_change_events", "subscription_id", "subscriptions"),
        ("plan_change_events", "old_plan_id", "plans"),
        ("plan_change_events", "new_plan_id", "plans"),
    ]
]

RULE_COUNT = len(ROW_RULES) + len(KEY_RULES) + len(REFERENCE_RULES)


def _of(rules: Iterable, table: str) -> list:
    return [rule for rule in rules if rule.table == table]


def _fails(condition: str) -> Column:
    return ~F.coalesce(F.expr(condition), F.lit(True))


def _key_text(columns: Iterable[str]) -> Column:
    return F.concat_ws("|", *[F.col(c).cast("string") for c in columns])


def _tuples(table: str, rules: list[KeyRule], references: list[ReferenceRule], ignore_case: bool) -> Column:
    """What a row contributes to the key and reference rules of its table: (rule, target, key) each."""
    made = []
    for r in rules:
        parts = [F.col(c).cast("string") for c in r.columns]
        if ignore_case and r.name == "name_unique":
            parts[-1] = F.lower(parts[-1])
        counted = reduce(lambda x, y: x & y, [p.isNotNull() for p in parts])
        if r.where is not None:
            counted = counted & F.expr(r.where)
        entry = F.struct(F.lit(r.name).alias("rule"), F.lit(None).cast("string").alias("_target"), F.array(*parts).alias("_key"))
        made.append(F.when(counted, entry))
    for r in references:
        key = F.col(r.column).cast("string")
        entry = F.struct(F.lit(r.name).alias("rule"), F.lit(r.target).alias("_target"), F.array(key).alias("_key"))
        made.append(F.when(key.isNotNull(), entry))
    return F.array_compact(F.array(*made))


def _failing_rows(df: DataFrame, table: str, rules: list[RowRule]) -> DataFrame:
    failed = F.array_compact(F.array(*[F.when(_fails(r.condition), F.lit(r.name)) for r in rules]))
    return df.select(
        F.explode(failed).alias("rule"), _key_text(PRIMARY_KEYS[table]).alias("key"),
        F.lit(1).cast("bigint").alias("rows"),
    )


def _set_rules(
    table: str, df: DataFrame, refs: Mapping[str, DataFrame], ignore_case: bool,
) -> tuple[list[str], DataFrame]:
    """Names of the key and reference rules of a table, and their violations: repeated keys, keys that point nowhere."""
    keys, references = _of(KEY_RULES, table), [r for r in _of(REFERENCE_RULES, table) if r.target in refs]
    counted = df.select(F.inline(_tuples(table, keys, references, ignore_case))).groupBy("rule", "_target", "_key").agg(
        F.count("*").alias("rows"))
    names = [r.name for r in [*keys, *references]]
    if not references:
        found = counted.where(F.col("rows") > 1)
    else:
        known = reduce(DataFrame.unionByName, [
            refs[target].select(F.lit(target).alias("_in"), F.array(F.col("id").cast("string")).alias("_id"))
            for target in sorted({r.target for r in references})
        ]).distinct()
        at = (F.col("_target") == F.col("_in")) & (F.col("_key") == F.col("_id"))
        found = counted.join(known, at, "left").where(
            F.when(F.col("_target").isNull(), F.col("rows") > 1).otherwise(F.col("_in").isNull()))
    return names, found.select("rule", F.concat_ws("|", "_key").alias("key"), "rows")


def validate(
    table: str, df: DataFrame, refs: Mapping[str, DataFrame] | None = None, ignore_name_case: bool = False,
) -> DataFrame:
    """Violations of ``table``'s rules as ``table_name, rule, key, rows``.

    A row rule reports the row's key; a key rule the repeated key and a reference rule the
    dangling one, each with its number of rows. Reference rules run for the tables in
    ``refs``. Plan names are compared as written; ``ignore_name_case`` compares them lowered.
    """
    parts = [_set_rules(table, df, refs or {}, ignore_name_case)[1]]
    if rules := _of(ROW_RULES, table):
        parts.insert(0, _failing_rows(df, table, rules))
    return reduce(DataFrame.unionByName, parts).select(F.lit(table).alias("table_name"), "rule", "key", "rows")


def table_summary(
    table: str, df: DataFrame, refs: Mapping[str, DataFrame] | None = None, ignore_name_case: bool = False,
) -> DataFrame:
    """Number of violations per rule of ``table``, zeros included.

    All row rules are counted in one pass without producing violation rows.
    """
    parts = []
    if rules := _of(ROW_RULES, table):
        counts = df.agg(*[F.count_if(_fails(r.condition)).alias(r.name) for r in rules])
        pairs = F.array(*[
            F.struct(F.lit(r.name).alias("rule"), F.col(r.name).alias("violations")) for r in rules
        ])
        parts.append(counts.select(F.inline(pairs)))
    names, violations = _set_rules(table, df, refs or {}, ignore_name_case)
    counts = violations.agg(*[F.count_if(F.col("rule") == name).alias(name) for name in names])
    pairs = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in names])
    parts.append(counts.select(F.inline(pairs)))
    return reduce(DataFrame.unionByName, parts).select(F.lit(table).alias("table_name"), "rule", "violations")


def rule_summary(tables: Mapping[str, DataFrame], names: Iterable[str] | None = None) -> DataFrame:
    """``table_summary`` of every given table (or of ``names``), references checked among ``tables``."""
    wanted = list(names) if names is not None else list(tables)
    return reduce(DataFrame.unionByName, [table_summary(name, tables[name], tables) for name in wanted])


def ledger_edits(before: DataFrame, after: DataFrame) -> DataFrame:
    """Where a later snapshot of the ledger broke append-only: rows gone, or changed beyond
    their status and payment date. ``id, edit`` with edit ``removed`` or ``changed``.
    """
    fixed = [c for c in ("tenant_id", "subscription_id", "amount_cents", "due_date", "created_at")]
    old = before.select("id", F.struct(*fixed).alias("_old"))
    new = after.select("id", F.struct(*fixed).alias("_new"))
    edit = F.when(F.col("_new").isNull(), "removed").when(~F.col("_old").eqNullSafe(F.col("_new")), "changed")
    return old.join(new, "id", "left").select("id", edit.alias("edit")).where(F.col("edit").isNotNull())


def retired_plan_subscriptions(
    subscriptions: DataFrame, plans: DataFrame, since: datetime | str,
) -> DataFrame:
    """Subscriptions created at or after ``since`` on a plan that is no longer on sale."""
    retired = plans.where(~F.col("is_active")).select(F.col("id").alias("plan_id"), F.col("name").alias("plan_name"))
    return subscriptions.where(F.col("created_at") >= instant(since)).join(retired, "plan_id").select(
        F.col("id").alias("subscription_id"), "tenant_id", "plan_id", "plan_name", "created_at",
    )


def overlapping_periods(subscriptions: DataFrame) -> DataFrame:
    """Subscriptions whose period begins before an earlier one of their tenant has ended; such cycles count usage twice.

    ``tenant_id, subscription_id, period_start, period_end, busy_until``: the latest end among
    the tenant's periods that began before. Of equal beginnings the lesser id is the earlier one. A tenant with a large
    share of all subscriptions is sorted by months, and a crowded month in pieces.
    """
    periods = subscriptions.select(
        "tenant_id", F.col("id").alias("subscription_id"), F.col("current_period_start").alias("period_start"),
        F.col("current_period_end").alias("period_end"),
    ).where(F.col("period_end") > F.col("period_start"))
    month = F.date_trunc("month", "period_start")
    busy = with_running_max(periods, ["tenant_id"], ["period_start", "subscription_id"], "period_end", month, "busy_until")
    return busy.where(F.col("busy_until") > F.col("period_start"))
