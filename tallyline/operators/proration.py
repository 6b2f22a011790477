"""Proration of plan changes, as one set-based transform.

The daily rate divides by the real length of the cycle. The unused days of the old plan
are credited rounded down, the days on the new plan charged rounded up.
"""

from __future__ import annotations

from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.functions.money import daily_rate
from tallyline.functions.months import MONTH, month_key
from tallyline.sources.lake import month_folders, read_monthly, write_monthly
from tallyline.sources.schema import schema_of

OLD_PLAN_MISSING = "old plan not found"
NEW_PLAN_MISSING = "new plan not found"
PERIOD_INVALID = "period end is not after period start"
EFFECTIVE_TOO_EARLY = "effective before period start"
# What the record of a change does not admit.
INCOMPLETE = "incomplete request"
SAME_PLAN = "old and new plan are the same"


_REQUIRED = ["tenant_id", "subscription_id", "effective_at", "period_start", "period_end"]


class Prorated(NamedTuple):
    """Priced changes, and those refused with a ``reject_reason``."""

    ok: DataFrame
    rejected: DataFrame


class NetAmounts(NamedTuple):
    """Amounts to invoice (zero or more) and credits for the next invoice (positive cents)."""

    invoices: DataFrame
    credits: DataFrame


def _side(plans: DataFrame, side: str) -> DataFrame:
    return plans.select(
        F.col("id").alias(f"_{side}_id"), F.col("price_cents").alias(f"_{side}_price"),
        F.col("billing_cycle").alias(f"_{side}_cycle"),
    )


def _whole_quotient(amount: Column, cycle: Column) -> Column:
    """``amount / cycle`` rounded down, in whole numbers."""
    return F.call_function("div", amount, F.when(cycle > 0, cycle).cast("bigint"))


def prorate(changes: DataFrame, plans: DataFrame, exact: bool = False) -> Prorated:
    """Price each requested change: tenant, subscription, old and new plan, effective_at, period.

    By default amounts follow the rounded daily rate; ``exact=True`` uses whole-number
    arithmetic without an intermediate rounding. A change after the period end counts as
    one day. ``warn_cycle_mismatch`` marks changes between billing cycles, whose whole
    price is spread over the cycle at hand.
    """
    days_in_cycle = F.datediff(F.to_date("period_end"), F.to_date("period_start"))
    days_remaining = F.greatest(F.datediff(F.to_date("period_end"), F.to_date("effective_at")), F.lit(1))
    cycle, left = F.col("days_in_cycle"), F.col("days_remaining")
    old_price, new_price = F.col("_old_price"), F.col("_new_price")

    looked_up = (
        changes
        .join(_side(plans, "old"), F.col("old_plan_id") == F.col("_old_id"), "left")
        .join(_side(plans, "new"), F.col("new_plan_id") == F.col("_new_id"), "left")
        .withColumns({"days_in_cycle": days_in_cycle, "days_remaining": days_remaining})
        .withColumn("reject_reason", F.when(F.col("_old_id").isNull(), OLD_PLAN_MISSING)
                    .when(F.col("_new_id").isNull(), NEW_PLAN_MISSING)
                    .when(cycle <= 0, PERIOD_INVALID)
                    .when(left > cycle, EFFECTIVE_TOO_EARLY)
                    .when(reduce(or_, [F.col(c).isNull() for c in _REQUIRED]), INCOMPLETE)
                    .when(F.col("old_plan_id") == F.col("new_plan_id"), SAME_PLAN))
    )
    rejected = looked_up.where(F.col("reject_reason").isNotNull()).select(*changes.columns, "reject_reason")

    old_rate, new_rate = F.col("old_daily_rate"), F.col("new_daily_rate")
    days = left.cast("decimal(7,0)")
    if exact:
        credit = _whole_quotient(old_price.cast("bigint") * left, cycle)
        charge = _whole_quotient(new_price.cast("bigint") * left + cycle - 1, cycle)
    else:
        credit, charge = F.floor(old_rate * days), F.ceil(new_rate * days)
    ok = (
        looked_up.where(F.col("reject_reason").isNull())
        .withColumns({
            "old_daily_rate": daily_rate(old_price, cycle),
            "new_daily_rate": daily_rate(new_price, cycle),
        })
        .withColumns({"credit_cents": credit.cast("int"), "charge_cents": charge.cast("int")})
        .withColumn("net_cents", F.col("charge_cents") - F.col("credit_cents"))
        .withColumn("warn_cycle_mismatch", F.col("_old_cycle") != F.col("_new_cycle"))
        .select(
            *changes.columns, "days_remaining", "days_in_cycle", "old_daily_rate", "new_daily_rate",
            "credit_cents", "charge_cents", "net_cents", "warn_cycle_mismatch",
        )
    )
    return Prorated(ok, rejected)


_EVENT_INPUTS = [
    "tenant_id", "subscription_id", "old_plan_id", "new_plan_id", "effective_at", "days_remaining",
    "days_in_cycle",
]


def plan_change_events(ok: DataFrame) -> DataFrame:
    """One event row per priced change. The id is a digest of the inputs, so a re-run repeats it."""
    digest = F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in _EVENT_INPUTS]), 256)
    return ok.select(
        digest.alias("id"), *_EVENT_INPUTS, "credit_cents", "charge_cents", "net_cents",
        F.col("effective_at").alias("created_at"),
    )


def write_plan_changes(spark: SparkSession, ok: DataFrame, path: str, key_type: T.DataType | None = None) -> None:
    """Append one event per priced change to the month-partitioned log; known events are skipped."""
    schema = schema_of("plan_change_events", key_type)
    events = plan_change_events(ok).dropDuplicates(["id"]).withColumn(MONTH, month_key(F.col("effective_at")))
    if month_folders(spark, path):
        # Bounded by the calendar: one short text per touched month. A known event has the same month.
        touched = [r[MONTH] for r in events.select(MONTH).distinct().collect()]
        recorded = read_monthly(spark, path, schema).where(F.col(MONTH).isin(*touched)).select("id")
        events = events.join(recorded, "id", "left_anti")
    write_monthly(events.drop(MONTH), "effective_at", path)


def proration_invoices(ok: DataFrame) -> NetAmounts:
    """The one net amount of each change: an invoice when not negative, else a credit."""
    keys = ["tenant_id", "subscription_id", "effective_at"]
    return NetAmounts(
        ok.where(F.col("net_cents") >= 0).select(*keys, F.col("net_cents").alias("amount_cents")),
        ok.where(F.col("net_cents") < 0).select(*keys, (-F.col("net_cents")).alias("credit_cents")),
    )
