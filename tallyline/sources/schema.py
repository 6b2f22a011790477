"""Declared table schemas. Nothing is inferred from files."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# One line per column: name, type, ``!`` = not null. ``key`` stands for the key type, text by
# default; frames with whole-number keys work with every operator.
_COLUMNS: dict[str, str] = {
    "tenants": """
        id key!, name string!, slug string!, created_at timestamp!, deleted_at timestamp""",
    "plans": """
        id key!, name string!, price_cents int!, billing_cycle string!, api_limit int,
        is_active boolean!, created_at timestamp!""",
    "users": """
        id key!, tenant_id key!, email string!, role string!, created_at timestamp!,
        deleted_at timestamp""",
    "subscriptions": """
        id key!, tenant_id key!, plan_id key!, status string!, current_period_start timestamp!,
        current_period_end timestamp!, cancelled_at timestamp, created_at timestamp!""",
    "invoices": """
        id key!, tenant_id key!, subscription_id key!, amount_cents int!, status string!,
        due_date date!, paid_at timestamp, created_at timestamp!""",
    "api_usage_events": """
        id key!, tenant_id key!, recorded_at timestamp!, endpoint string!, event_count int!""",
    "billing_audit_log": """
        id key!, table_name string!, row_id key!, changed_by string!, old_status string!,
        new_status string!, changed_at timestamp!""",
    "plan_change_events": """
        id string!, tenant_id key!, subscription_id key!, old_plan_id key!, new_plan_id key!,
        effective_at timestamp!, days_remaining int!, days_in_cycle int!, credit_cents int!,
        charge_cents int!, net_cents int!, created_at timestamp!""",
}

# Timestamp column that decides the month folder of each unbounded table.
MONTHLY = {
    "invoices": "created_at",
    "api_usage_events": "recorded_at",
    "billing_audit_log": "changed_at",
    "plan_change_events": "effective_at",
}

EVENT_FIELDS = (
    "audit_log_id", "table_name", "row_id", "old_status", "new_status", "changed_at", "changed_by",
)
EVENT_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in EVENT_FIELDS])

_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "boolean": T.BooleanType(),
    "date": T.DateType(), "timestamp": T.TimestampType(),
}


def schema_of(table: str, key_type: T.DataType | None = None) -> T.StructType:
    types = {**_TYPES, "key": key_type or T.StringType()}
    parsed = []
    for column in _COLUMNS[table].split(","):
        name, kind = column.split()
        parsed.append(T.StructField(name, types[kind.rstrip("!")], not kind.endswith("!")))
    return T.StructType(parsed)


SCHEMAS: dict[str, T.StructType] = {table: schema_of(table) for table in _COLUMNS}


def required_columns(table: str) -> list[str]:
    return [f.name for f in SCHEMAS[table] if not f.nullable]


@dataclass(frozen=True)
class Tables:
    """The eight base tables of one data set."""

    tenants: DataFrame
    plans: DataFrame
    users: DataFrame
    subscriptions: DataFrame
    invoices: DataFrame
    api_usage_events: DataFrame
    billing_audit_log: DataFrame
    plan_change_events: DataFrame

    def items(self) -> list[tuple[str, DataFrame]]:
        return [(f.name, getattr(self, f.name)) for f in fields(self)]


def load(spark: SparkSession, root: str, key_type: T.DataType | None = None) -> Tables:
    """Read ``root/<table>`` Parquet folders with their declared schemas.

    Tables written by month keep their ``month`` folder as a column, for pruning.
    """
    from tallyline.sources.lake import read_monthly, has_month_folders

    frames = {}
    for table in _COLUMNS:
        path = f"{root.rstrip('/')}/{table}"
        if table in MONTHLY and has_month_folders(spark, path):
            frames[table] = read_monthly(spark, path, schema_of(table, key_type))
        else:
            frames[table] = spark.read.schema(schema_of(table, key_type)).parquet(path)
    return Tables(**frames)
