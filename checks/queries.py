"""The registered queries: each takes (spark, sf_dir) and works on the whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import fixtures as fx
from checks import fleet
from checks.broken import broken_tables
from checks.lake_queries import LAKE
from tallyline import configure, scratch_dir
from tallyline.functions.text import normalise_endpoint
from tallyline.operators import audit, kept_rules, ledger, lookups, proration, reports, rules, telemetry, usage
from tallyline.sources.lake import write_monthly

Query = Callable[[SparkSession, str], DataFrame]
AS_OF = fx.AS_OF


def zoneless(df: DataFrame) -> DataFrame:
    """Instants without their zone, as the SQL counterparts return them."""
    return df.select(*[
        F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType)
        else F.col(f.name)
        for f in df.schema
    ])


def _billing(report: Callable, *names: str, **options) -> Query:
    """A report over the billing tables named in the order the report takes them."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        frames = [fx.plans(spark) if n == "plans" else getattr(fx, n)(spark, sf_dir) for n in names]
        return report(*frames, **options)
    return run


_LEDGER = ("invoices", "subscriptions", "plans", "tenants")
_OWNERS = ("tenants", "subscriptions", "plans")

REPORTS: dict[str, Query] = {
    "revenue_by_month": _billing(reports.revenue_by_month, *_LEDGER),
    "revenue_for_month": _billing(reports.revenue_for_month, *_LEDGER, month="1997-05"),
    "lifetime_revenue": _billing(reports.lifetime_revenue, "invoices", "tenants"),
    "outstanding_balance": _billing(reports.outstanding_balance, *_OWNERS, "invoices", as_of=AS_OF),
    "renewals_due": _billing(reports.renewals_due, *_OWNERS, as_of=AS_OF),
    "plan_mrr": _billing(reports.plan_mrr, "subscriptions", "plans", "tenants"),
    "invoice_history": _billing(reports.invoice_history, *_OWNERS, "invoices"),
    "tenant_invoice_history": _billing(reports.invoice_history, *_OWNERS, "invoices", tenant_id=12),
    "outstanding_invoices": _billing(reports.outstanding_invoices, *_LEDGER, as_of=AS_OF),
    "usage_by_cycle": _billing(
        reports.usage_by_cycle, "usage", "tenants", "subscriptions", "plans", as_of=AS_OF,
    ),
}


def _normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.requests(spark, sf_dir).select("url", normalise_endpoint(F.col("url")).alias("endpoint"))


USAGE: dict[str, Query] = {
    "meter_hourly": _billing(usage.meter_hourly, "requests"),
    "normalise_endpoint": _normalised,
}


def _prorated(spark: SparkSession, sf_dir: str, **options) -> proration.Prorated:
    return proration.prorate(fx.plan_changes(spark, sf_dir), fx.plans(spark), **options)



def _prorate(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok = _prorated(spark, sf_dir).ok
    rates = {
        rate: F.expr(f"cast(cast({rate} as decimal(21,16)) * 10000000000000000BD as decimal(38,0))").cast("string")
        for rate in ("old_daily_rate", "new_daily_rate")
    }
    return ok.withColumns(rates).withColumnsRenamed(
        {"old_daily_rate": "old_rate_e16", "new_daily_rate": "new_rate_e16"},
    )


PRORATION: dict[str, Query] = {
    "prorate": _prorate,
    "prorate_exact": lambda spark, sf_dir: _prorated(spark, sf_dir, exact=True).ok.select(
        "tenant_id", "subscription_id", "credit_cents", "charge_cents",
    ),
    "prorate_rejects": lambda spark, sf_dir: _prorated(spark, sf_dir).rejected,
    "proration_invoices": lambda spark, sf_dir: proration.proration_invoices(_prorated(spark, sf_dir).ok).invoices,
    "proration_credits": lambda spark, sf_dir: proration.proration_invoices(_prorated(spark, sf_dir).ok).credits,
}


def _without_id(df: DataFrame) -> DataFrame:
    return df.drop("id")


def _from_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    after = fx.invoices(spark, sf_dir)
    return _without_id(audit.status_changes(
        fx.before_snapshot(after), after, "invoices", changed_at=AS_OF, changed_by="system",
    ))


def _from_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = fx.version_feed(spark, sf_dir).withColumn("app_user", F.lit("system"))
    return _without_id(audit.status_changes_from_feed(feed))


def _from_hot_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of all versions are of one row and one day, many of them of one instant."""
    hot = F.col("row_id") % 3 == 0
    at = F.expr("TIMESTAMP '1996-03-01 00:00:00' + make_dt_interval(0, 0, 0, row_id % 50)")
    feed = fx.version_feed(spark, sf_dir).withColumns({
        "app_user": F.lit("system"), "version_no": F.when(hot, F.col("row_id") * 3 + F.col("version_no")).otherwise(F.col("version_no")),
        "version_at": F.when(hot, at).otherwise(F.col("version_at")), "row_id": F.when(hot, 0).otherwise(F.col("row_id"))})
    return _without_id(audit.status_changes_from_feed(feed))


def _hot_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of all invoices as periods of one tenant, many of them of one month."""
    periods = fx.invoices(spark, sf_dir).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 0 ELSE tenant_id END AS tenant_id",
        "CASE WHEN id % 2 = 0 THEN created_at ELSE TIMESTAMP '1996-03-01 00:00:00' END AS current_period_start",
        "CASE WHEN id % 2 = 0 THEN created_at ELSE TIMESTAMP '1996-03-01 00:00:00' END + make_dt_interval(CAST(id % 9 AS INT)) AS current_period_end")
    return rules.overlapping_periods(periods)


def _log(select: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: select(fx.audit_log(spark, sf_dir))


AUDIT: dict[str, Query] = {
    "status_changes": _from_snapshots,
    "status_changes_from_feed": _from_feed,
    "status_changes_hot_row": _from_hot_feed,
    "audit_history": _log(lambda log: audit.audit_history(log, "subscriptions", 12)),
    "audit_between": _log(lambda log: audit.audit_between(log, "1997-03-01", "1997-05-15")),
    "audit_since": _log(lambda log: audit.audit_since(log, "1998-01-01 00:00:00")),
    "next_watermark": _log(lambda log: audit.next_watermark(
        audit.audit_since(log, "1998-01-01 00:00:00", ordered=False), "1998-01-01 00:00:00",
    )),
}


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.rule_summary(broken_tables(spark, sf_dir))


def _violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = broken_tables(spark, sf_dir)
    # The id of a change is a digest; what it is made of is easier to state in SQL.
    named = frames["plan_change_events"].withColumn("id", F.concat_ws("|", "tenant_id", "subscription_id"))
    frames = {**frames, "plan_change_events": named}
    return reduce(DataFrame.unionByName, [rules.validate(name, df, frames) for name, df in frames.items()])


def _kept_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faulty facts in folders, their rules kept up over three writes: some sound, then faulty, then the rest."""
    frames, root = broken_tables(spark, sf_dir), scratch_dir(spark, "kept-rules")
    sound = dict(fx.tables(spark, sf_dir).items())
    for step in range(3):
        write_monthly((sound if step == 0 else frames)["invoices"].where("month(created_at) % 2 = 0" if step < 2 else "month(created_at) % 2 = 1 OR created_at IS NULL"),
                      "created_at", f"{root}/invoices", mode="overwrite")
        kept_rules.refresh_months(spark, "invoices", f"{root}/invoices", f"{root}/kept/invoices", fx.KEY)
    return kept_rules.violations(spark, "invoices", f"{root}/kept/invoices", frames)


def _rollup_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rollup with the rows of every second cycle repeated."""
    rollup = REPORTS["usage_by_cycle"](spark, sf_dir)
    return rules.validate("usage_by_cycle", rollup.unionByName(rollup.where("subscription_id % 4 = 0")))


def _edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    later = broken_tables(spark, sf_dir)["invoices"].where("id % 100 <> 50")
    return rules.ledger_edits(fx.invoices(spark, sf_dir), later)


def _retired(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = fx.subscriptions(spark, sf_dir).withColumn("plan_id", F.col("plan_id") + 1)
    return rules.retired_plan_subscriptions(moved, fx.plans(spark), "1994-06-01")


RULES: dict[str, Query] = {
    "rule_summary": _summary,
    "rule_violations": _violations,
    "ledger_edits": _edits,
    "retired_plan_subscriptions": _retired,
    "rollup_violations": _rollup_violations,
    "rule_violations_kept": _kept_violations,
    "overlapping_periods_hot": _hot_periods,
    "overlapping_periods": lambda spark, sf_dir: rules.overlapping_periods(fx.subscriptions(spark, sf_dir)),
}


def _coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = {
        "invoices": (fx.invoices(spark, sf_dir), "created_at"),
        "api_usage_events": (fx.usage(spark, sf_dir), "recorded_at"),
    }
    return ledger.missing_months(facts, as_of=AS_OF, since="2001-01")


LEDGER: dict[str, Query] = {
    "out_of_range_rows": lambda spark, sf_dir: ledger.out_of_range_rows(
        fx.invoices(spark, sf_dir), "created_at", "1996-01", "2000-12",
    ).select("id", "created_at"),
    "missing_months": _coverage,
    "ledger_between": lambda spark, sf_dir: ledger.ledger_between(
        fx.invoices(spark, sf_dir), "1997-02-10", "1997-04-01",
    ),
}


def _found(table: str, look_up: Callable[[DataFrame], DataFrame], *columns: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = look_up(getattr(fx, table)(spark, sf_dir))
        return found.select(*columns) if columns else found
    return run


_INVOICE = ("id", "status", "amount_cents", "created_at")
_BUCKET = ("tenant_id", "recorded_at", "endpoint", "event_count")


def _with_leavers(users: DataFrame) -> DataFrame:
    return users.withColumn("deleted_at", F.when(F.col("id") % 2 == 0, F.col("created_at") + F.expr("INTERVAL 1 DAY")))


def _events_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = proration.plan_change_events(_prorated(spark, sf_dir).ok)
    return lookups.plan_changes_of(events, tenant_id=12).select(
        "tenant_id", "subscription_id", "days_remaining", "credit_cents", "charge_cents",
    )


LOOKUPS: dict[str, Query] = {
    "users_of": _found("users", lambda u: lookups.users_of(u, 12)),
    "active_users_of": _found(
        "users", lambda u: lookups.users_of(_with_leavers(u), 12, active_only=True), "id", "email", "role",
    ),
    "subscriptions_of": _found("subscriptions", lambda s: lookups.subscriptions_of(s, 12)),
    "active_subscriptions_of": _found("subscriptions", lambda s: lookups.subscriptions_of(s, 12, "active")),
    "subscriptions_ending": _found(
        "subscriptions", lambda s: lookups.subscriptions_ending(s, "2024-01-26", "2024-02-01"),
    ),
    "subscriptions_on": _found("subscriptions", lambda s: lookups.subscriptions_on(s, 3)),
    "plan_subscribers": _billing(lookups.plan_subscribers, "plans", "subscriptions"),
    "invoices_of": _found("invoices", lambda i: lookups.invoices_of(i, tenant_id=12), *_INVOICE),
    "open_invoices_of": _found("invoices", lambda i: lookups.invoices_of(i, tenant_id=12, status="open"), *_INVOICE),
    "subscription_invoices_of": _found(
        "invoices", lambda i: lookups.invoices_of(i, subscription_id=24), *_INVOICE,
    ),
    "reported_invoices_between": _found(
        "invoices", lambda i: lookups.reported_invoices_between(i, "1996-03-05", "1996-09-01"), *_INVOICE,
    ),
    "plan_changes_of": _events_of,
    "usage_between": _found("usage", lambda u: usage.usage_between(u, "2024-01-05", "2024-01-20", 12), *_BUCKET),
    "platform_usage_between": _found("usage", lambda u: usage.usage_between(u, "2024-01-05", "2024-01-20"), *_BUCKET),
}


def _fleet(report: Callable, *names: str, **options) -> Query:
    return lambda spark, sf_dir: report(*[getattr(fleet, n)(spark, sf_dir) for n in names], **options)


def _slowest(lines: DataFrame) -> DataFrame:
    return telemetry.slowest_statements(lines).select("logged_at", "pid", "duration_ms", "statement")


TELEMETRY: dict[str, Query] = {
    "statement_top_total": _fleet(telemetry.statement_top_total, "statement_stats"),
    "statement_top_mean": _fleet(telemetry.statement_top_mean, "statement_stats", min_calls=5),
    "statement_top_spread": _fleet(telemetry.statement_top_spread, "statement_stats", min_calls=3),
    "parse_slow_log": _fleet(telemetry.parse_slow_log, "log_lines"),
    "slowest_statements": _fleet(_slowest, "log_lines"),
    "unparsed_durations": _fleet(telemetry.unparsed_durations, "log_lines"),
    "longest_statements": _fleet(telemetry.longest_statements, "sessions"),
    "cache_hit_ratio": _fleet(telemetry.cache_hit_ratio, "table_io"),
    "cache_hit_by_table": _fleet(telemetry.cache_hit_by_table, "table_io"),
    "index_usage": _fleet(telemetry.index_usage, "table_stats"),
    "unused_indexes": _fleet(telemetry.unused_indexes, "index_stats"),
    "replication_health": _fleet(telemetry.replication_health, "replication"),
    "retained_log": _fleet(telemetry.retained_log, "slots"),
    "sessions_by_state": _fleet(telemetry.sessions_by_state, "sessions"),
    "idle_in_transaction": _fleet(telemetry.idle_in_transaction, "sessions"),
    "pool_pressure": _fleet(telemetry.pool_pressure, "sessions"),
    "dead_rows": _fleet(telemetry.dead_rows, "table_stats"),
    "health_check": _fleet(
        telemetry.health_check, "table_io", "replication", "sessions", "table_stats", partition="invoices_1997_05",
    ),
}


def _registered(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return zoneless(query(configure(spark), sf_dir))
    return run


def queries() -> dict[str, Query]:
    groups = (REPORTS, USAGE, PRORATION, AUDIT, RULES, LEDGER, LOOKUPS, TELEMETRY, LAKE)
    return {name: _registered(query) for group in groups for name, query in group.items()}
