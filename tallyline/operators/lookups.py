"""The lookups people make every day. Each is a filter that reaches the scan."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.functions.months import instant, within

UNREPORTED_STATUSES = ("void", "draft")


def _equal(df: DataFrame, **wanted: object | None) -> DataFrame:
    for column, value in wanted.items():
        if value is not None:
            df = df.where(F.col(column) == F.lit(value))
    return df


def users_of(users: DataFrame, tenant_id: object, active_only: bool = False) -> DataFrame:
    """Users of a tenant; with ``active_only`` without the soft-deleted ones."""
    found = _equal(users, tenant_id=tenant_id)
    return found.where(F.col("deleted_at").isNull()) if active_only else found


def subscriptions_of(subscriptions: DataFrame, tenant_id: object, status: str | None = None) -> DataFrame:
    """Subscriptions of a tenant, of any status or of one."""
    return _equal(subscriptions, tenant_id=tenant_id, status=status)


def subscriptions_ending(
    subscriptions: DataFrame, start: str | datetime, end: str | datetime,
    statuses: tuple[str, ...] = ("active", "trialing"),
) -> DataFrame:
    """Subscriptions of the given statuses whose period ends in ``[start, end]``."""
    return subscriptions.where(
        F.col("status").isin(*statuses) & F.col("current_period_end").between(instant(start), instant(end)),
    )


def subscriptions_on(subscriptions: DataFrame, plan_id: object) -> DataFrame:
    """Subscriptions on a plan."""
    return _equal(subscriptions, plan_id=plan_id)


def plan_subscribers(plans: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """How many subscriptions each plan has, by status; shows who is left on a retired plan.

    Counted per plan before the join, so the row count of a plan does not matter.
    """
    counted = subscriptions.groupBy("plan_id", "status").agg(F.count("*").alias("subscriptions"))
    named = plans.select(F.col("id").alias("_id"), F.col("name").alias("plan_name"), "is_active")
    return named.join(counted, F.col("_id") == F.col("plan_id"), "left").select(
        F.col("_id").alias("plan_id"), "plan_name", "is_active", "status",
        F.coalesce("subscriptions", F.lit(0)).alias("subscriptions"),
    )


def invoices_of(
    invoices: DataFrame, tenant_id: object | None = None, subscription_id: object | None = None,
    status: str | None = None,
) -> DataFrame:
    """Invoices of a tenant or of a subscription, of any status or of one."""
    return _equal(invoices, tenant_id=tenant_id, subscription_id=subscription_id, status=status)


def reported_invoices_between(invoices: DataFrame, start: str | datetime, end: str | datetime) -> DataFrame:
    """Invoices created in ``[start, end)``, void and draft ones left out."""
    return within(invoices, "created_at", start, end).where(~F.col("status").isin(*UNREPORTED_STATUSES))


def plan_changes_of(
    events: DataFrame, tenant_id: object | None = None, subscription_id: object | None = None,
) -> DataFrame:
    """Plan changes of a tenant or of a subscription."""
    return _equal(events, tenant_id=tenant_id, subscription_id=subscription_id)
