"""Care of the month-partitioned facts: coverage, catch-all rows, re-layout, archive."""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.functions.months import MONTH, day_of, instant, month_bounds, month_key, within
from tallyline.sources.lake import (
    delete_path, empty_frame, is_complete, mark_complete, month_folders, read_monthly, replace_months, write_monthly,
)


def ledger_between(df: DataFrame, start: str | datetime, end: str | datetime, ts: str = "created_at") -> DataFrame:
    """Rows of ``[start, end)``, reading only the month folders the range touches."""
    return within(df, ts, start, end)


def out_of_range_rows(df: DataFrame, ts: str, first: str, last: str) -> DataFrame:
    """Rows outside the declared months ``first`` .. ``last``: what a catch-all would hold.

    Healthy is none. Months are contiguous, so this is a range test on the raw timestamp.
    """
    start, end = month_bounds(first)[0], month_bounds(last)[1]
    outside = df.where((F.col(ts) < instant(start)) | (F.col(ts) >= instant(end)) | F.col(ts).isNull())
    if MONTH not in df.columns:
        return outside
    # The declared months' folders hold none of these rows and need not be opened.
    return outside.where((F.col(MONTH) < first) | (F.col(MONTH) > last) | F.col(MONTH).isNull())


def missing_months(
    facts: dict[str, tuple[DataFrame, str]], as_of: date | datetime | str | None = None, ahead: int = 3,
    since: str | None = None, stored: dict[str, list[str]] | None = None,
) -> DataFrame:
    """Months without rows from ``since`` (default: this month) to ``ahead`` months from now.

    ``facts`` maps a table name to its frame and timestamp column. ``stored`` may give a table's
    months instead, as ``month_folders`` lists them; then no data is read. Months of a
    frame are taken from its ``month`` folder where there is one, combined before any shuffle.
    """
    stored = stored or {}
    reports = []
    for table, (df, ts) in facts.items():
        current = F.date_trunc("month", day_of(as_of))
        first = current if since is None else instant(month_bounds(since)[0])
        until = current + F.make_ym_interval(F.lit(0), F.lit(ahead))
        wanted = df.sparkSession.range(1).select(
            F.explode(F.sequence(first, until, F.expr("INTERVAL 1 MONTH"))).alias("_start"),
        ).select(F.lit(table).alias("table_name"), month_key(F.col("_start")).alias(MONTH))
        if table in stored:
            reports.append(wanted.where(~F.col(MONTH).isin(stored[table])))
            continue
        present = df.select((F.col(MONTH) if MONTH in df.columns else month_key(F.col(ts))).alias(MONTH)).distinct()
        reports.append(wanted.join(present, MONTH, "left_anti").select("table_name", MONTH))
    result = reports[0]
    for report in reports[1:]:
        result = result.unionByName(report)
    return result.orderBy("table_name", MONTH)


def write_declared(
    df: DataFrame, ts: str, path: str, quarantine: str, first: str, last: str, mode: str = "append",
) -> None:
    """Write rows of the declared months to ``path`` and all others to ``quarantine``."""
    start, end = month_bounds(first)[0], month_bounds(last)[1]
    write_monthly(within(df, ts, start, end), ts, path, mode)
    write_monthly(out_of_range_rows(df, ts, first, last), ts, quarantine, mode)


class Recovered(NamedTuple):
    """What ``recover_default`` did with a month: rows now in the table, rows that had to stay."""

    moved: int
    conflicts: int


def _same_row(left: DataFrame, right: DataFrame, columns: list[str]):
    """Equality of all columns, NULLs included."""
    return reduce(and_, [left[c].eqNullSafe(right[c]) for c in columns])


def recover_default(
    spark: SparkSession, path: str, quarantine: str, month: str, ts: str, schema: T.StructType,
) -> Recovered:
    """Move one month's rows from the quarantine into the table.

    A row goes if the table holds the same row, or nothing under its key ``(id, ts)``. A row whose key is
    taken by a different one, in the table or in the quarantine itself, stays where it is and
    is counted as a conflict. Nothing leaves the quarantine before the table is seen to
    hold it, and rows already moved by an interrupted run are not added twice.
    """
    stage = f"{quarantine.rstrip('/')}.stage"
    if is_complete(spark, stage):  # a run that died while it put the rest back
        replace_months(spark, stage, quarantine)
    delete_path(spark, stage)
    if month not in month_folders(spark, quarantine):
        return Recovered(0, 0)
    waiting = read_monthly(spark, quarantine, schema).where(F.col(MONTH) == month).drop(MONTH)
    columns, key = waiting.columns, ["id", ts]

    def stored() -> DataFrame:
        if month not in month_folders(spark, path):
            return empty_frame(spark, waiting.schema)
        return read_monthly(spark, path, schema).where(F.col(MONTH) == month).drop(MONTH)

    distinct = waiting.distinct()
    several = distinct.groupBy(*key).count().where("count > 1").select(*[F.col(k).alias(f"_{k}") for k in key])
    known = stored()
    taken = [distinct[k].eqNullSafe(known[k]) for k in key]
    fresh = distinct.join(known, taken, "left_anti")
    fresh = fresh.join(several, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key], "left_anti").select(*columns)
    write_monthly(fresh, ts, path)

    known = stored()
    left = waiting.join(known, _same_row(waiting, known, columns), "left_anti").select(*columns)
    conflicts, total = left.count(), waiting.count()
    if conflicts:
        write_monthly(left, ts, stage)
        mark_complete(spark, stage)
        replace_months(spark, stage, quarantine)
        delete_path(spark, stage)
    else:
        delete_path(spark, f"{quarantine.rstrip('/')}/{MONTH}={month}")
    return Recovered(total - conflicts, conflicts)


def row_hashes(columns: list[Column]) -> list[Column]:
    """128 bits of a row as two whole numbers. A NULL differs from every value, also from one in the next column."""
    parts = [part for c in columns for part in (c.isNull(), c)]
    return [F.xxhash64(*parts), F.xxhash64(F.lit(1), *parts)]


def _per_month(df: DataFrame, ts: str, amount: str, side: str, columns: list[Column]) -> DataFrame:
    """Rows, total and fingerprint of each month: sums and exclusive ors of row hashes, whatever the order of rows.

    Repeated rows cancel out of the exclusive or but not of the sums. All of it combines before the shuffle.
    """
    key = F.col(MONTH) if MONTH in df.columns else month_key(F.col(ts))
    first, second = row_hashes(columns)
    keyed = df.select(key.alias(MONTH), F.col(amount).cast("bigint").alias("_amount"), first.alias("_h1"), second.alias("_h2"))
    marks = [F.count("*"), *[f(F.col(h)) for h in ("_h1", "_h2") for f in (lambda c: F.sum(c.cast("decimal(20,0)")), F.bit_xor)]]
    return keyed.groupBy(MONTH).agg(
        F.count("*").alias(f"{side}_rows"), F.sum("_amount").alias(f"{side}_total"), F.struct(*marks).alias(f"_{side}_mark"),
    )


def reconcile(source: DataFrame, target: DataFrame, ts: str, amount: str) -> DataFrame:
    """Row count and total per month on both sides, and whether both hold the same rows, each as often.

    ``matches`` goes by the contents of all columns that both have, as ``target`` types them, not by the totals alone: amounts that
    have changed places are seen, and NULLs count as values. One pass over each side, no join of rows.
    """
    columns = [c for c in source.columns if c != MONTH and c in target.columns]
    same_type = [F.col(c).cast(target.schema[c].dataType) for c in columns]
    left = _per_month(source, ts, amount, "source", same_type)
    right = _per_month(target, ts, amount, "target", [F.col(c) for c in columns])
    both = left.join(right, left[MONTH].eqNullSafe(right[MONTH]), "full")
    return both.select(
        F.coalesce(left[MONTH], right[MONTH]).alias(MONTH), F.coalesce("source_rows", F.lit(0)).alias("source_rows"),
        F.coalesce("target_rows", F.lit(0)).alias("target_rows"), "source_total", "target_total",
        F.col("_source_mark").eqNullSafe(F.col("_target_mark")).alias("matches"),
    )


def migrate_to_monthly(
    spark: SparkSession, source: DataFrame, path: str, ts: str, amount: str, schema: T.StructType,
) -> DataFrame:
    """Re-lay a flat table by month, then reconcile what was read with what is stored.

    The source is left untouched. Months are replaced whole, so a repeated run is safe.
    """
    write_monthly(source, ts, path, mode="overwrite")
    return reconcile(source, read_monthly(spark, path, schema), ts, amount)


def archive_months(
    spark: SparkSession, path: str, archive: str, before: date | datetime | str, ts: str, amount: str,
    schema: T.StructType,
) -> DataFrame:
    """Add months earlier than ``before`` to the archive and verify the copy.

    The archive only grows: a month's new copy is what it held, with rows of the table added, or
    put in the place of an older state of the same ``(id, ts)``; a row without an id stays what it is. The copy is staged, seen to
    hold exactly that, row by row, and then swapped in. ``removable`` is true for a month whose every row the archive
    holds as it is. Nothing is deleted from the table here.
    """
    archive = archive.rstrip("/")
    stage = f"{archive}.stage"
    if is_complete(spark, stage):  # finish what a lost run had verified
        replace_months(spark, stage, archive)
    delete_path(spark, stage)

    limit = month_key(instant(before))
    old = read_monthly(spark, path, schema).where(F.col(MONTH) < limit)
    columns = [c for c in old.columns if c != MONTH]
    # One short text per month, from a listing of folders.
    months = sorted(set(month_folders(spark, path)) & set(month_folders(spark, archive)))

    def archived(wanted: Column | None = None) -> DataFrame:
        if not month_folders(spark, archive):
            return empty_frame(spark, old.schema)
        return read_monthly(spark, archive, schema).where(F.lit(True) if wanted is None else wanted)

    held = archived((F.col(MONTH) < limit) & F.col(MONTH).isin(months))
    whole = _grown(held.select(*columns), old.select(*columns), ts)
    write_monthly(whole, ts, stage)
    staged = read_monthly(spark, stage, schema) if month_folders(spark, stage) else empty_frame(spark, old.schema)
    if not reconcile(whole, staged, ts, amount).where("NOT matches").isEmpty() or not old.exceptAll(staged.select(*old.columns)).isEmpty():
        raise RuntimeError(f"the new copy below {stage} is not whole; archive left as it is")
    mark_complete(spark, stage)
    replace_months(spark, stage, archive)
    delete_path(spark, stage)

    stored = archived(F.col(MONTH) < limit)
    absent = (old.exceptAll(stored.select(*old.columns)).groupBy(F.col(MONTH).alias("_month")).agg(F.count("*").alias("_absent")))
    # Months archived and removed earlier are in the archive only; they are not up for a decision.
    checked = reconcile(old, stored, ts, amount).where(F.col("source_rows") > 0)
    checked = checked.join(absent, F.col(MONTH).eqNullSafe(F.col("_month")), "left")
    return checked.select(
        MONTH, F.col("source_rows").alias("rows"), F.col("target_rows").alias("archived_rows"),
        F.col("source_total").alias("total"), F.col("target_total").alias("archived_total"),
        (F.coalesce("_absent", F.lit(0)) == 0).alias("removable"),
    )


def _grown(held: DataFrame, old: DataFrame, ts: str) -> DataFrame:
    """What an archive holds and rows of the table added, a state of the same ``(id, ts)`` put in the place of an older one.

    A row without an id is no state of another. It stays as it is, as often as the side says that has it more often.
    """
    key = ["id", ts]
    named, states = held.where("id IS NOT NULL"), old.select(*[F.col(k).alias(f"_{k}") for k in key])
    kept = named.join(states, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key], "left_anti")
    sides = [df.where("id IS NULL").groupBy(*held.columns).agg(F.count("*").alias("_n")) for df in (held, old)]
    nameless = reduce(DataFrame.unionByName, sides).groupBy(*held.columns).agg(F.max("_n").alias("_n"))
    nameless = nameless.select(*held.columns, F.explode(F.array_repeat(F.lit(1), F.col("_n").cast("int"))))
    return reduce(DataFrame.unionByName, [kept, old.where("id IS NOT NULL"), nameless.select(*held.columns)])
