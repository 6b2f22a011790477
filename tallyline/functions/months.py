"""Calendar months: the partition key of both fact tables, and predicates that prune on it."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONTH = "month"


def month_key(ts: Column) -> Column:
    """``yyyy-MM`` of an instant: the partition folder it belongs to."""
    return F.date_format(ts, "yyyy-MM")


def _naive_utc(moment: date | datetime | str) -> str:
    if isinstance(moment, datetime) and moment.tzinfo is not None:
        moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
    return str(moment)


def month_of(moment: date | datetime | str) -> str:
    return _naive_utc(moment)[:7]


def shift_month(month: str, by: int) -> str:
    year, index = divmod(int(month[:4]) * 12 + int(month[5:7]) - 1 + by, 12)
    return f"{year:04d}-{index + 1:02d}"


def month_bounds(month: str) -> tuple[str, str]:
    """First instant of the month and of the next one, for a half-open range."""
    return f"{month}-01 00:00:00", f"{shift_month(month, 1)}-01 00:00:00"


def month_range(first: str, last: str) -> list[str]:
    """Every month from ``first`` to ``last``, both included."""
    months, month = [], first
    while month <= last:
        months.append(month)
        month = shift_month(month, 1)
    return months


def instant(moment: Column | datetime | date | str | None) -> Column:
    """A clock reading as a column; ``None`` means the current time of the query."""
    if moment is None:
        return F.current_timestamp()
    if isinstance(moment, Column):
        return moment
    return F.lit(_naive_utc(moment)).cast("timestamp")


def day_of(moment: Column | datetime | date | str | None) -> Column:
    return F.to_date(instant(moment))


def within(df: DataFrame, ts: str, start: str | datetime | None, end: str | datetime | None) -> DataFrame:
    """Rows with ``start <= ts < end``, pruning month folders where the frame has them.

    The engine does not derive a folder filter from a timestamp range, so both are stated. The
    folder bounds come from the same instants as the row bounds, whatever way these are
    written, and fold to literals. The last folder is that of the last instant before ``end``.
    """
    if start is not None:
        df = df.where(F.col(ts) >= instant(start))
        if MONTH in df.columns:
            df = df.where(F.col(MONTH) >= month_key(instant(start)))
    if end is not None:
        df = df.where(F.col(ts) < instant(end))
        if MONTH in df.columns:
            df = df.where(F.col(MONTH) <= month_key(instant(end) - F.expr("INTERVAL '0.000001' SECOND")))
    return df
