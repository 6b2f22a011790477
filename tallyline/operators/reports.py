"""Billing reports.

Facts are combined per key before they are joined, so a tenant or subscription with a
large share of all rows reaches the joins as a handful of rows. Joins to dimensions carry
no hints: Catalyst and AQE broadcast a side whose measured size allows it, else shuffle.
Sorting is the last step, on reported rows, with unique tie-breakers; ``ordered=False``
leaves it out for exports.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.money import dollars, mrr_dollars, percent_of
from tallyline.functions.months import MONTH, day_of, instant, month_bounds, month_key, within
from tallyline.plans.joins import split_outer_join

CURRENT_STATUSES = ("active", "trialing")
METERED_STATUSES = ("active", "trialing", "past_due")
# The second one is no invoice status; the report asks for it all the same.
OWED_STATUSES = ("open", "past_due")


def active_tenants(tenants: DataFrame, *columns: str) -> DataFrame:
    """Tenants that are not soft-deleted, their columns prefixed with ``tenant_``."""
    picked = ("id", *columns)
    return tenants.where(F.col("deleted_at").isNull()).select(
        *[F.col(c).alias(f"tenant_{c}") for c in picked],
    )


def _plan_columns(plans: DataFrame, *columns: str) -> DataFrame:
    renamed = {"id": "plan_id", "name": "plan_name", "price_cents": "plan_price_cents"}
    return plans.select(*[F.col(c).alias(renamed.get(c, c)) for c in ("id", *columns)])


def _subscription_columns(subscriptions: DataFrame, **columns: str) -> DataFrame:
    return subscriptions.select(*[F.col(source).alias(out) for out, source in columns.items()])


def _sorted(df: DataFrame, ordered: bool, *order: Column) -> DataFrame:
    return df.orderBy(*order) if ordered else df


def _paid(invoices: DataFrame) -> DataFrame:
    return invoices.where(F.col("status") == "paid")


def _paid_per_subscription(invoices: DataFrame, *more_keys: Column) -> DataFrame:
    return _paid(invoices).groupBy("tenant_id", "subscription_id", *more_keys).agg(
        F.count("id").alias("_count"), F.sum("amount_cents").alias("_cents"),
    )


def _with_plan(per_subscription: DataFrame, subscriptions: DataFrame, plans: DataFrame) -> DataFrame:
    owners = _subscription_columns(subscriptions, subscription_id="id", plan_id="plan_id").join(
        _plan_columns(plans, "name", "billing_cycle"), "plan_id",
    )
    return per_subscription.join(owners, "subscription_id")


def revenue_by_month(
    invoices: DataFrame, subscriptions: DataFrame, plans: DataFrame, tenants: DataFrame,
    ordered: bool = True,
) -> DataFrame:
    """Paid revenue per tenant, plan and month of the invoice."""
    paid = _paid_per_subscription(invoices, F.date_trunc("month", "created_at").alias("billing_month"))
    report = (
        _with_plan(paid, subscriptions, plans)
        .join(active_tenants(tenants, "name", "slug"), "tenant_id")
        .groupBy("tenant_id", "tenant_name", "tenant_slug", "plan_name", "billing_cycle", "billing_month")
        .agg(F.sum("_count").alias("invoice_count"), F.sum("_cents").alias("total_cents"))
        .withColumn("total_dollars", dollars(F.col("total_cents")))
    )
    return _sorted(
        report, ordered, F.asc_nulls_last("tenant_name"), F.asc_nulls_last("billing_month"),
        F.asc_nulls_last("tenant_id"), F.asc_nulls_last("plan_name"), F.asc_nulls_last("billing_cycle"),
    )


def revenue_for_month(
    invoices: DataFrame, subscriptions: DataFrame, plans: DataFrame, tenants: DataFrame,
    month: str, ordered: bool = True,
) -> DataFrame:
    """Paid revenue of one month (``yyyy-MM``) per tenant name and plan name.

    The month is a range on the invoice's own timestamp, so it prunes folders and row groups.
    """
    paid = _paid_per_subscription(within(invoices, "created_at", *month_bounds(month)))
    report = (
        _with_plan(paid, subscriptions, plans)
        .join(active_tenants(tenants, "name"), "tenant_id")
        .groupBy("tenant_name", "plan_name")
        .agg(F.sum("_cents").alias("total_cents"))
        .withColumn("total_dollars", dollars(F.col("total_cents")))
    )
    return _sorted(
        report, ordered, F.desc_nulls_first("total_cents"), F.asc_nulls_last("tenant_name"), F.asc_nulls_last("plan_name"),
    )


def lifetime_revenue(invoices: DataFrame, tenants: DataFrame, ordered: bool = True) -> DataFrame:
    """Everything a tenant ever paid, with first and latest payment."""
    report = (
        _paid(invoices)
        .groupBy("tenant_id")
        .agg(
            F.count("id").alias("total_invoices_paid"),
            F.sum("amount_cents").alias("lifetime_cents"),
            F.min("paid_at").alias("first_payment_at"),
            F.max("paid_at").alias("most_recent_payment_at"),
        )
        .join(active_tenants(tenants, "name"), "tenant_id")
        .select(
            "tenant_id", "tenant_name", "total_invoices_paid", "lifetime_cents",
            dollars(F.col("lifetime_cents")).alias("lifetime_dollars"),
            "first_payment_at", "most_recent_payment_at",
        )
    )
    return _sorted(
        report, ordered, F.desc_nulls_first("lifetime_cents"), F.asc_nulls_last("tenant_name"), F.asc_nulls_last("tenant_id"),
    )


def outstanding_balance(
    tenants: DataFrame, subscriptions: DataFrame, plans: DataFrame, invoices: DataFrame,
    as_of: datetime | str | None = None, ordered: bool = True,
) -> DataFrame:
    """Current plan, days left and open balance of active and trialing subscriptions.

    Open invoices are summed per subscription first, which leaves unique keys for the
    outer join. The report groups by what it shows, not by subscription: two equal-looking
    subscriptions of a tenant become one row.
    """
    owed = invoices.where(F.col("status") == "open").groupBy("subscription_id").agg(
        F.sum("amount_cents").alias("_cents"), F.count("id").alias("_count"),
    )
    current = _subscription_columns(
        subscriptions.where(F.col("status").isin(*CURRENT_STATUSES)),
        subscription_id="id", tenant_id="tenant_id", plan_id="plan_id", subscription_status="status",
        period_start="current_period_start", period_end="current_period_end",
    )
    shown = [
        "tenant_id", "tenant_name", "tenant_slug", "tenant_since", "plan_name", "billing_cycle",
        "plan_price_cents", "api_limit", "subscription_status", "period_start", "period_end",
    ]
    report = (
        current
        .join(_plan_columns(plans, "name", "billing_cycle", "price_cents", "api_limit"), "plan_id")
        .join(
            active_tenants(tenants, "name", "slug", "created_at")
            .withColumnRenamed("tenant_created_at", "tenant_since"),
            "tenant_id",
        )
        .join(owed, "subscription_id", "left")
        .groupBy(*shown)
        .agg(
            F.coalesce(F.sum("_cents"), F.lit(0)).alias("outstanding_cents"),
            F.coalesce(F.sum("_count"), F.lit(0)).alias("open_invoice_count"),
        )
        .select(
            *shown[:7], dollars(F.col("plan_price_cents")).alias("plan_price_dollars"), *shown[7:],
            F.datediff(F.to_date("period_end"), day_of(as_of)).alias("days_remaining_in_period"),
            "outstanding_cents", dollars(F.col("outstanding_cents")).alias("outstanding_dollars"),
            "open_invoice_count",
        )
    )
    return _sorted(
        report, ordered, F.desc_nulls_first("outstanding_cents"), F.asc_nulls_last("tenant_name"),
        F.asc_nulls_last("tenant_id"), F.asc_nulls_last("plan_name"), F.asc_nulls_last("period_start"), F.asc_nulls_last("period_end"),
    )


def renewals_due(
    tenants: DataFrame, subscriptions: DataFrame, plans: DataFrame,
    as_of: datetime | str | None = None, days: int = 7, ordered: bool = True,
) -> DataFrame:
    """Active subscriptions whose period ends within ``days`` of ``as_of``, both ends included."""
    now = instant(as_of)
    due = subscriptions.where(
        (F.col("status") == "active")
        & F.col("current_period_end").between(now, now + F.make_dt_interval(F.lit(days))),
    )
    report = (
        _subscription_columns(due, tenant_id="tenant_id", plan_id="plan_id", renews_at="current_period_end")
        .join(_plan_columns(plans, "name", "price_cents"), "plan_id")
        .join(active_tenants(tenants, "name"), "tenant_id")
        .select(
            "tenant_name", "plan_name", F.col("plan_price_cents").alias("renewal_amount_cents"),
            dollars(F.col("plan_price_cents")).alias("renewal_amount_dollars"), "renews_at",
            F.datediff(F.to_date("renews_at"), day_of(as_of)).alias("days_until_renewal"),
        )
    )
    return _sorted(report, ordered, F.asc_nulls_last("renews_at"), F.asc_nulls_last("tenant_name"), F.asc_nulls_last("plan_name"))


def plan_mrr(subscriptions: DataFrame, plans: DataFrame, tenants: DataFrame, ordered: bool = True) -> DataFrame:
    """Active subscriptions per plan and the monthly recurring revenue they bring.

    Counted per plan before the plans are joined: a plan half of all tenants are on is one row.
    """
    per_plan = (
        _subscription_columns(
            subscriptions.where(F.col("status") == "active"),
            subscription_id="id", tenant_id="tenant_id", plan_id="plan_id",
        )
        .join(active_tenants(tenants), "tenant_id")
        .groupBy("plan_id")
        .agg(F.count("subscription_id").alias("active_tenant_count"))
    )
    price = F.col("plan_price_cents").cast("bigint")
    report = per_plan.join(_plan_columns(plans, "name", "billing_cycle", "price_cents"), "plan_id").select(
        "plan_name", "billing_cycle", dollars(price).alias("price_dollars"), "active_tenant_count",
        mrr_dollars(price * F.col("active_tenant_count"), F.col("billing_cycle"))
        .alias("mrr_contribution_dollars"),
    )
    return _sorted(report, ordered, F.desc_nulls_first("active_tenant_count"), F.asc_nulls_last("plan_name"))


_HISTORY = [
    "tenant_id", "tenant_name", "subscription_id", "subscription_status", "plan_name", "billing_cycle",
    "period_start", "period_end", "invoice_id", "amount_cents", "amount_dollars", "invoice_status",
    "due_date", "paid_at", "invoice_created_at",
]
_ONE_TENANT_HISTORY = [
    "subscription_id", "subscription_status", "plan_name", "invoice_id", "amount_dollars",
    "invoice_status", "due_date", "paid_at", "invoice_created_at",
]


def invoice_history(
    tenants: DataFrame, subscriptions: DataFrame, plans: DataFrame, invoices: DataFrame,
    tenant_id: object | None = None, ordered: bool = True,
) -> DataFrame:
    """Every invoice of every active tenant; tenants and subscriptions without one are kept.

    With ``tenant_id``: that tenant only, in the narrower single-tenant form.
    """
    if tenant_id is not None:
        tenants = tenants.where(F.col("id") == F.lit(tenant_id))
        subscriptions = subscriptions.where(F.col("tenant_id") == F.lit(tenant_id))

    owners = active_tenants(tenants, "name")
    enrolled = _subscription_columns(
        subscriptions, subscription_id="id", _owner="tenant_id", plan_id="plan_id",
        subscription_status="status", period_start="current_period_start",
        period_end="current_period_end", _subscribed_at="created_at",
    )
    billed = invoices.select(
        F.col("id").alias("invoice_id"), F.col("subscription_id").alias("_billed"), "amount_cents",
        F.col("status").alias("invoice_status"), "due_date", "paid_at",
        F.col("created_at").alias("invoice_created_at"),
    )
    subscribed = enrolled.join(owners, F.col("_owner") == F.col("tenant_id"))
    if tenant_id is None:
        with_invoices = split_outer_join(subscribed, billed, "subscription_id", "_billed")
    else:
        # The ledger is read once, down to what these subscriptions were billed; the outer join is between the rest.
        wanted = subscribed.select(F.col("subscription_id").alias("_wanted"))
        billed = billed.join(wanted, F.col("_billed") == F.col("_wanted"), "left_semi")
        with_invoices = subscribed.join(billed, F.col("subscription_id") == F.col("_billed"), "left")
    subscribers = enrolled.select("_owner").distinct()
    without_subscription = owners.join(subscribers, F.col("_owner") == F.col("tenant_id"), "left_anti")
    report = (
        with_invoices.unionByName(without_subscription, allowMissingColumns=True)
        .join(_plan_columns(plans, "name", "billing_cycle"), "plan_id", "left")
        .withColumn("amount_dollars", dollars(F.col("amount_cents")))
    )
    report = _sorted(
        report, ordered, F.asc_nulls_last("tenant_name"), F.asc_nulls_last("_subscribed_at"),
        F.asc_nulls_last("invoice_created_at"), F.asc_nulls_last("subscription_id"),
        F.asc_nulls_last("invoice_id"), F.asc_nulls_last("tenant_id"),
    )
    return report.select(*(_HISTORY if tenant_id is None else _ONE_TENANT_HISTORY))


def outstanding_invoices(
    invoices: DataFrame, subscriptions: DataFrame, plans: DataFrame, tenants: DataFrame,
    as_of: datetime | str | None = None, ordered: bool = True,
) -> DataFrame:
    """Invoices still owed, with days overdue (negative: not due yet)."""
    owed = invoices.where(F.col("status").isin(*OWED_STATUSES)).select(
        F.col("id").alias("invoice_id"), "tenant_id", "subscription_id", "amount_cents",
        F.col("status").alias("invoice_status"), "due_date",
    )
    report = (
        _with_plan(owed, subscriptions, plans)
        .join(active_tenants(tenants, "name"), "tenant_id")
        .select(
            "tenant_name", "plan_name", "invoice_id", dollars(F.col("amount_cents")).alias("amount_dollars"),
            "invoice_status", "due_date", F.datediff(day_of(as_of), "due_date").alias("days_overdue"),
        )
    )
    return _sorted(report, ordered, F.desc_nulls_first("days_overdue"), F.asc_nulls_last("tenant_name"), F.asc_nulls_last("invoice_id"))


def _by_month(periods: DataFrame, usage: DataFrame) -> DataFrame:
    """One row for every month a period touches and usage reaches; ``_month`` is its first instant.

    A period may be open-ended; the months to look at are those between the first and the last usage.
    """
    month = F.to_timestamp(F.concat(MONTH, F.lit("-01"))) if MONTH in usage.columns else F.date_trunc("month", "recorded_at")
    low, high = usage.select(F.min(month)).scalar(), usage.select(F.max(month)).scalar()
    first, last = F.greatest(F.date_trunc("month", "period_start"), low), F.least(F.date_trunc("month", "period_end"), high)
    clamped = periods.withColumn("_first", first).withColumn("_last", last).where(low.isNotNull() & (F.col("_first") <= F.col("_last")))
    months = F.explode(F.sequence("_first", "_last", F.expr("INTERVAL 1 MONTH")))
    return clamped.withColumn("_month", months).drop("_first", "_last")


#: What is counted of a cycle's usage: calls, buckets that give a number of calls, and all buckets.
CALLS = ["calls", "counted", "buckets"]


def metered_cycles(tenants: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """The cycle of every metered subscription of an active tenant, empty cycles left out."""
    return (
        _subscription_columns(
            subscriptions.where(F.col("status").isin(*METERED_STATUSES)),
            subscription_id="id", tenant_id="tenant_id", plan_id="plan_id",
            period_start="current_period_start", period_end="current_period_end",
        )
        .where(F.col("period_end") > F.col("period_start"))
        .join(active_tenants(tenants, "name"), "tenant_id")
    )


def cycle_calls(usage: DataFrame, cycles: DataFrame) -> DataFrame:
    """``CALLS`` of each cycle and endpoint that has usage.

    A cycle is split into the months it touches, so usage joins on (tenant, month) and
    only then on the half-open time range: a heavy tenant is spread over its months, and
    month folders outside every cycle are not read. Overlapping cycles count a call twice.
    """
    slices = _by_month(cycles.select(
        F.col("tenant_id").alias("_tenant"), "subscription_id", "period_start", "period_end",
    ), usage)
    if MONTH in usage.columns:
        # The calendar bounds this side whatever the data; it prunes month folders at run time.
        months = _by_month(cycles.select("period_start", "period_end"), usage).select(
            month_key(F.col("_month")).alias("_folder"),
        ).distinct()
        usage = usage.join(F.broadcast(months), F.col(MONTH) == F.col("_folder"), "left_semi")
    return (
        usage.select(
            "tenant_id", "recorded_at", "endpoint", "event_count",
            F.date_trunc("month", "recorded_at").alias("_usage_month"),
        )
        .join(
            slices,
            (F.col("tenant_id") == F.col("_tenant"))
            & (F.col("_usage_month") == F.col("_month"))
            & (F.col("recorded_at") >= F.col("period_start"))
            & (F.col("recorded_at") < F.col("period_end")),
        )
        .groupBy("subscription_id", "endpoint")
        .agg(F.sum(F.coalesce("event_count", F.lit(0))).alias("calls"), F.count("event_count").alias("counted"), F.count("*").alias("buckets"))
    )


def cycle_report(calls: DataFrame, cycles: DataFrame, plans: DataFrame, as_of: datetime | str | None = None) -> DataFrame:
    """Counted calls against the plan's limit."""
    counted = calls.select("subscription_id", "endpoint", F.when(F.col("counted") > 0, F.col("calls")).alias("total_calls"))
    limit, total = F.col("api_limit"), F.col("total_calls")
    return (
        counted.join(cycles, "subscription_id")
        .join(_plan_columns(plans, "name", "api_limit"), "plan_id")
        .select(
            "tenant_id", "tenant_name", "subscription_id", "plan_name", "api_limit", "endpoint",
            "period_start", "period_end", "total_calls", (limit - total).alias("calls_remaining"),
            percent_of(total, limit).alias("pct_limit_consumed"), instant(as_of).alias("last_refreshed_at"),
        )
    )


def usage_by_cycle(
    usage: DataFrame, tenants: DataFrame, subscriptions: DataFrame, plans: DataFrame,
    as_of: datetime | str | None = None,
) -> DataFrame:
    """Calls per subscription cycle and endpoint against the plan's limit."""
    cycles = metered_cycles(tenants, subscriptions)
    return cycle_report(cycle_calls(usage, cycles), cycles, plans, as_of)
