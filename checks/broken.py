"""The billing tables with faults put in by rule, so that every data rule has work to do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx

_DAY = "INTERVAL 1 DAY"


def _alter(df: DataFrame, **changes: tuple[Column, Column] | list[tuple[Column, Column]]) -> DataFrame:
    """Replace columns where a condition holds; all conditions see the unaltered row."""
    altered = {}
    for column, cases in changes.items():
        value = F.col(column)
        for when, new in reversed(cases if isinstance(cases, list) else [cases]):
            value = F.when(when, new).otherwise(value)
        altered[column] = value.cast(df.schema[column].dataType)
    return df.withColumns(altered)


def broken_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    def digit(n: int, modulus: int) -> Column:
        return F.col("id") % modulus == n

    frames = dict(fx.tables(spark, sf_dir).items())
    extra_plans = fx.catalogue(
        spark, "(6, 'weekly', -1, 'weekly', 0, TRUE), (7, 'studio', 100, 'monthly', NULL, TRUE)",
    )
    old_sub = (F.col("id") % 2 == 1) & (F.col("tenant_id") % 30 == 0)
    hour = F.hour("recorded_at")
    return {
        **frames,
        "plans": frames["plans"].unionByName(extra_plans),
        "tenants": _alter(
            frames["tenants"],
            slug=[(digit(7, 50), F.upper("slug")), (digit(17, 50), F.lit("same-slug"))],
            name=(digit(11, 50), F.lit(None)),
            deleted_at=(digit(13, 50), F.col("created_at") - F.expr(_DAY)),
        ),
        "users": _alter(
            frames["users"],
            role=(digit(5, 40), F.lit("superuser")),
            email=[
                (digit(9, 40), F.translate("email", "@", "-")),
                (digit(12, 40) | digit(13, 40), F.concat(F.lit("same@"), F.col("tenant_id"), F.lit(".example"))),
            ],
            tenant_id=(digit(21, 40), F.lit(-1)),
        ),
        "subscriptions": _alter(
            frames["subscriptions"],
            status=[(digit(2, 40), F.lit("expired")), (old_sub, F.lit("active"))],
            current_period_end=(digit(6, 40), F.col("current_period_start") - F.expr(_DAY)),
            cancelled_at=[(digit(10, 40), F.col("created_at") - F.expr(_DAY)), (old_sub, F.lit(None))],
            plan_id=(digit(16, 40), F.lit(99)),
        ),
        "invoices": _alter(
            frames["invoices"],
            amount_cents=(digit(1, 100), F.lit(-1)),
            status=(digit(2, 100), F.lit("overdue")),
            paid_at=[
                (digit(3, 100), F.lit(None)), (digit(4, 100), F.col("created_at") - F.expr(_DAY)),
            ],
            due_date=(digit(6, 100), F.date_sub(F.to_date("created_at"), 1)),
            subscription_id=(digit(8, 100), F.lit(-5)),
            created_at=(digit(9, 100), F.lit(None)),
        ),
        "api_usage_events": _alter(
            frames["api_usage_events"],
            event_count=((F.col("tenant_id") % 20 == 3) & (hour == 5), F.lit(0)),
            recorded_at=((F.col("tenant_id") % 20 == 4) & (hour == 6), F.col("recorded_at") + F.expr("INTERVAL 1 MINUTE")),
            endpoint=((F.col("tenant_id") % 20 == 5) & (hour == 7), F.lit("/api/v1/same")),
        ),
        "billing_audit_log": _alter(
            frames["billing_audit_log"],
            table_name=(digit(6, 100), F.lit("users")),
            new_status=(digit(7, 100), F.col("old_status")),
        ),
        "plan_change_events": _alter(
            frames["plan_change_events"],
            new_plan_id=(F.col("tenant_id") % 45 == 12, F.col("old_plan_id")),
            days_remaining=(F.col("tenant_id") % 45 == 15, F.col("days_in_cycle") + 1),
            net_cents=(F.col("tenant_id") % 45 == 18, F.lit(0)),
            credit_cents=(F.col("tenant_id") % 45 == 21, F.lit(-1)),
        ),
    }
