"""Billing tables derived from the given Parquet tables, by whole-number rules only.

``checks.oracles`` states the same rules in SQL. ``k`` is the customer key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.sources.schema import Tables, schema_of

AS_OF = "2024-01-28 00:00:00"
KEY = T.LongType()

# An invented plan catalogue (id, name, price in cents, cycle, call limit, on sale).
PLANS = """
    (1, 'hobby', 0, 'monthly', 2500, TRUE),
    (2, 'team', 3750, 'monthly', 18000, TRUE),
    (3, 'studio', 11250, 'monthly', NULL, TRUE),
    (4, 'fleet', 71880, 'annual', NULL, TRUE),
    (5, 'team-2019', 2640, 'monthly', 7500, FALSE)"""


_GIVEN = {
    "customer": "c_custkey long, c_name string",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double",
}


def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(_GIVEN[table]).parquet(f"{sf_dir}/{table}.parquet")


def _build(df: DataFrame, table: str, **columns: str) -> DataFrame:
    """Columns given as SQL expressions, cast to the declared types of ``table``."""
    types = {f.name: f.dataType.simpleString() for f in schema_of(table, KEY)}
    return df.selectExpr(*[f"CAST({columns[name]} AS {kind}) AS {name}" for name, kind in types.items()])


def catalogue(spark: SparkSession, rows: str = PLANS) -> DataFrame:
    names = "id, name, price_cents, billing_cycle, api_limit, is_active"
    return _build(
        spark.sql(f"SELECT * FROM VALUES {rows} AS t({names})"), "plans",
        **{name: name for name in names.split(", ")}, created_at="TIMESTAMP '1994-01-01 00:00:00'",
    )


def plans(spark: SparkSession) -> DataFrame:
    return catalogue(spark)


_CREATED = "date_add(DATE '1994-01-01', CAST(c_custkey % 365 AS INT))"
_SLUG = "lower(translate(c_name, '#', '-'))"


def tenants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _build(
        given(spark, sf_dir, "customer"), "tenants", id="c_custkey", name="c_name", slug=_SLUG, created_at=_CREATED,
        deleted_at="CASE WHEN c_custkey % 10 = 9 THEN TIMESTAMP '1999-06-30 17:00:00' END",
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = given(spark, sf_dir, "customer").selectExpr("*", "explode(array(0, 1)) AS n")
    return _build(
        people, "users", id="2 * c_custkey + n", tenant_id="c_custkey",
        email=f"concat('user', n, '@', {_SLUG}, '.example')",
        role="element_at(array('admin', 'member', 'viewer'), CAST((c_custkey + n) % 3 AS INT) + 1)",
        created_at=_CREATED, deleted_at="NULL",
    )


def subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = given(spark, sf_dir, "customer").select("c_custkey")
    current = _build(
        customers, "subscriptions", id="2 * c_custkey", tenant_id="c_custkey", plan_id="1 + c_custkey % 4",
        status="CASE WHEN c_custkey % 8 <= 4 THEN 'active' WHEN c_custkey % 8 = 5 THEN 'trialing' "
               "WHEN c_custkey % 8 = 6 THEN 'past_due' ELSE 'cancelled' END",
        current_period_start="DATE '2024-01-01'",
        current_period_end="date_add(DATE '2024-01-25', CAST(c_custkey % 14 AS INT))",
        cancelled_at="CASE WHEN c_custkey % 8 = 7 THEN DATE '2024-01-20' END", created_at=_CREATED,
    )
    old = _build(
        customers.where("c_custkey % 3 = 0"), "subscriptions", id="2 * c_custkey + 1", tenant_id="c_custkey",
        plan_id="2", status="'cancelled'", current_period_start="DATE '1995-01-01'",
        current_period_end="DATE '1995-07-01'", cancelled_at="DATE '1995-06-15'", created_at=_CREATED,
    )
    # A second trial that looks like the first but for its key, and has no invoices.
    again = current.where("tenant_id % 24 = 5").withColumn("id", F.col("id") + 1)
    return current.unionByName(old).unionByName(again)


def invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _build(
        given(spark, sf_dir, "orders"), "invoices", id="o_orderkey", tenant_id="o_custkey",
        subscription_id="CASE WHEN o_custkey % 3 = 0 AND o_orderkey % 2 = 1 THEN 2 * o_custkey + 1 "
                        "ELSE 2 * o_custkey END",
        amount_cents="round(o_totalprice * 100)",
        status="CASE o_orderstatus WHEN 'F' THEN 'paid' WHEN 'O' THEN 'open' ELSE "
               "CASE o_orderkey % 3 WHEN 0 THEN 'void' WHEN 1 THEN 'uncollectible' ELSE 'draft' END END",
        due_date="date_add(CAST(o_orderdate AS DATE), 7)",
        paid_at="CASE WHEN o_orderstatus = 'F' THEN o_orderdate + make_dt_interval(CAST(1 + o_orderkey % 4 AS INT)) END",
        created_at="o_orderdate",
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "events").selectExpr(
        "user_id AS tenant_id", "CAST(ts AS TIMESTAMP) AS requested_at",
        "concat('/api/v1/', event_type, '?e=', event_id) AS url",
    )


def usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyline.operators.usage import meter_hourly

    return _build(
        meter_hourly(requests(spark, sf_dir)), "api_usage_events",
        id="(tenant_id * 1000 + (unix_seconds(recorded_at) - unix_seconds(TIMESTAMP '2024-01-01 00:00:00')) DIV 3600)"
           " * 1000 + ascii(substr(endpoint, 9, 1))",
        tenant_id="tenant_id", recorded_at="recorded_at", endpoint="endpoint", event_count="event_count",
    )


def audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    of_invoices = _build(
        invoices(spark, sf_dir).where("status IN ('paid', 'void', 'uncollectible')"), "billing_audit_log",
        id="id", table_name="'invoices'", row_id="id", changed_by="'system'", old_status="'open'",
        new_status="status", changed_at="coalesce(paid_at, created_at + INTERVAL 10 DAYS)",
    )
    of_subscriptions = _build(
        subscriptions(spark, sf_dir).where("id % 2 = 0 AND status IN ('past_due', 'cancelled')"),
        "billing_audit_log", id="id + 1000000000", table_name="'subscriptions'", row_id="id",
        changed_by="'system'", old_status="'active'", new_status="status",
        changed_at="coalesce(cancelled_at, TIMESTAMP '2024-01-15 00:00:00')",
    )
    return of_invoices.unionByName(of_subscriptions)


def plan_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "customer").where("c_custkey % 3 = 0").selectExpr(
        "c_custkey AS tenant_id", "2 * c_custkey + 1 AS subscription_id",
        "CASE WHEN c_custkey % 30 = 0 THEN 99L ELSE 2L END AS old_plan_id",
        "CASE WHEN c_custkey % 30 = 3 THEN 99L WHEN c_custkey % 4 = 1 THEN 5L ELSE 1L + c_custkey % 4 END AS new_plan_id",
        "CAST(CASE WHEN c_custkey % 30 = 9 THEN DATE '1995-05-25' "
        "ELSE date_add(DATE '1995-06-01', CAST(c_custkey % 29 AS INT)) END AS TIMESTAMP) AS effective_at",
        "TIMESTAMP '1995-06-01 00:00:00' AS period_start",
        "CAST(CASE WHEN c_custkey % 30 = 6 THEN DATE '1995-06-01' "
        "ELSE date_add(DATE '1995-06-28', CAST(c_custkey % 5 AS INT)) END AS TIMESTAMP) AS period_end",
    )


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    from tallyline.operators.proration import plan_change_events, prorate

    all_plans = plans(spark)
    return Tables(
        tenants=tenants(spark, sf_dir), plans=all_plans, users=users(spark, sf_dir),
        subscriptions=subscriptions(spark, sf_dir), invoices=invoices(spark, sf_dir),
        api_usage_events=usage(spark, sf_dir), billing_audit_log=audit_log(spark, sf_dir),
        plan_change_events=plan_change_events(prorate(plan_changes(spark, sf_dir), all_plans).ok),
    )


def before_snapshot(after: DataFrame) -> DataFrame:
    """The ledger before anything was settled: all but drafts open, nothing paid."""
    return after.withColumn(
        "status", F.when(F.col("status") == "draft", "draft").otherwise("open"),
    ).withColumn("paid_at", F.lit(None).cast("timestamp"))


def version_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row versions of the ledger: created, touched without a status change, settled."""
    opened = "CASE WHEN status = 'draft' THEN 'draft' ELSE 'open' END"
    versions = ", ".join([
        f"named_struct('version_no', 0, 'version_at', created_at, 'status', {opened})",
        f"named_struct('version_no', 1, 'version_at', created_at + INTERVAL 1 DAY, 'status', {opened})",
        "named_struct('version_no', 2, 'version_at', coalesce(paid_at, created_at + INTERVAL 10 DAYS), 'status', status)",
    ])
    return invoices(spark, sf_dir).selectExpr(
        "'invoices' AS table_name", "id AS row_id", f"inline(array({versions}))",
    ).selectExpr("*", "CAST(NULL AS STRING) AS app_user")
