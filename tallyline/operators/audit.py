"""Status-change audit: who moved which row from which status to which, and when."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.months import MONTH, instant, within
from tallyline.plans.windows import with_previous

AUDITED_TABLES = ("subscriptions", "invoices")

AUDIT_COLUMNS = ["id", "table_name", "row_id", "changed_by", "old_status", "new_status", "changed_at"]


def actor(app_user: Column | str | None = None) -> Column:
    """The application's user where it is known, else the session user."""
    if app_user is None:
        return F.current_user()
    return F.coalesce(app_user if isinstance(app_user, Column) else F.lit(app_user), F.current_user())


def _with_audit_id(changes: DataFrame) -> DataFrame:
    """The id is a digest of the change, so writing it again is recognised as a repeat."""
    parts = ["table_name", "row_id", "old_status", "new_status", "changed_at"]
    text = F.to_json(F.struct(*[F.col(p).cast("string").alias(p) for p in parts]))
    return changes.withColumn("id", F.sha2(text, 256)).select(*AUDIT_COLUMNS)


def status_changes(
    before: DataFrame, after: DataFrame, table_name: str,
    changed_at: Column | datetime | str | None = None, changed_by: Column | str | None = None,
) -> DataFrame:
    """One audit row per row whose status differs between two snapshots of a table.

    Rows found in one snapshot only (inserts, deletes) and changes to other columns are
    silent. Only key and status are read and shuffled.
    """
    old = before.select(F.col("id").alias("row_id"), F.col("status").alias("old_status"))
    new = after.select(F.col("id").alias("_id"), F.col("status").alias("new_status"))
    changed = old.join(new, F.col("row_id") == F.col("_id")).where(
        ~F.col("old_status").eqNullSafe(F.col("new_status")),
    )
    return _with_audit_id(changed.select(
        F.lit(table_name).alias("table_name"), "row_id", actor(changed_by).alias("changed_by"),
        "old_status", "new_status", instant(changed_at).alias("changed_at"),
    ))


def status_changes_from_feed(feed: DataFrame, cell: str = "day") -> DataFrame:
    """The same from row versions: ``table_name, row_id, status, version_at, version_no[, app_user]``.

    ``version_no`` orders versions of one instant. A row's versions are compared per ``cell``
    of time (hour, day, month) with one value carried over, so that a row with a large
    share of all versions is not sorted by a single task.
    """
    app_user = F.col("app_user") if "app_user" in feed.columns else F.lit(None).cast("string")
    versions = feed.select(
        "table_name", "row_id", "status", "version_at", "version_no", app_user.alias("_app_user"),
    )
    compared = with_previous(
        versions, ["table_name", "row_id"], ["version_at", "version_no"], "status",
        F.date_trunc(cell, "version_at"), "_previous",
    )
    changed = compared.where(
        F.col("_previous").isNotNull() & ~F.col("_previous.value").eqNullSafe(F.col("status")),
    )
    return _with_audit_id(changed.select(
        "table_name", "row_id", actor(F.col("_app_user")).alias("changed_by"),
        F.col("_previous.value").alias("old_status"), F.col("status").alias("new_status"),
        F.col("version_at").alias("changed_at"),
    ))


def audit_history(log: DataFrame, table_name: str, row_id: object, ordered: bool = True) -> DataFrame:
    """Every recorded change of one row, oldest first."""
    rows = log.where((F.col("table_name") == table_name) & (F.col("row_id") == F.lit(row_id)))
    return rows.orderBy("changed_at", "id") if ordered else rows


def audit_between(log: DataFrame, start: str | datetime, end: str | datetime) -> DataFrame:
    """Changes with ``start <= changed_at < end``, whatever the row."""
    return within(log, "changed_at", start, end)


def audit_since(
    log: DataFrame, watermark: datetime | str, tables: tuple[str, ...] = AUDITED_TABLES,
    overlap_seconds: int = 0, ordered: bool = True,
) -> DataFrame:
    """Changes after ``watermark``, oldest first: one batch of an incremental pull.

    A strict comparison misses rows that commit late or share the last instant. With
    ``overlap_seconds`` the pull reaches back that far; the reader then drops ids it has.
    """
    mark = instant(watermark)
    if overlap_seconds:
        mark = mark - F.make_dt_interval(secs=F.lit(overlap_seconds))
    rows = log.where((F.col("changed_at") > mark) & F.col("table_name").isin(*tables))
    if MONTH in log.columns:
        rows = rows.where(F.col(MONTH) >= F.date_format(mark, "yyyy-MM"))
    return rows.orderBy("changed_at", "id") if ordered else rows


def next_watermark(batch: DataFrame, watermark: datetime | str) -> DataFrame:
    """One row with the mark to store once ``batch`` is confirmed; unchanged for an empty batch."""
    return batch.agg(F.coalesce(F.max("changed_at"), instant(watermark)).alias("watermark"))
