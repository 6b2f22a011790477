"""Status changes from a stream of row versions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tallyline.operators.audit import status_changes_from_feed

_ORDER = ["_at", "version_no"]
#: Parts of the rows, by a hash: state is kept and read by part, so that what a call costs is shared by many rows.
PARTS = 2_048
#: Stands for a NULL in the order, before all others. pandas has no whole numbers that may be missing.
_NONE = -(1 << 63)


def _last_status(keys: list[str]) -> Callable[[tuple, Iterator[pd.DataFrame], GroupState], Iterator[pd.DataFrame]]:
    """The function is local, so it travels with the job and workers need not have this package."""
    columns, order = [*keys, "status", *_ORDER], len(_ORDER)

    def steps(part: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        """Keeps the newest version of each row of a part and emits the steps between versions."""
        last = {tuple(v[:len(keys)]): v[len(keys):] for v in zip(*state.get)} if state.exists else {}
        rows: dict[tuple, list[tuple]] = {}
        for batch in batches:
            # Texts that are missing come as None or as NaN, which differs from itself.
            for version in zip(*[[None if v != v else v for v in batch[c].tolist()] for c in columns]):
                rows.setdefault(version[:len(keys)], []).append(version[len(keys):])
        out = []
        for row, versions in rows.items():
            newest = last.get(row)
            for version in sorted(versions, key=lambda v: v[-order:]):
                status, at = version[0], version[-order:]
                if newest is not None and at < tuple(newest[-order:]):
                    # Its place is among versions whose steps are out already.
                    out.append((*row, status, at[0], None, True))
                    continue
                # The first version ever seen of a row has no predecessor and makes no step.
                if newest is not None and status != newest[0]:
                    out.append((*row, status, at[0], newest[0], False))
                newest = version
            last[row] = newest
        state.update(tuple(zip(*[(*row, *version) for row, version in last.items()])))
        yield pd.DataFrame(out, columns=[*keys, "new_status", "_at", "old_status", "late"])

    return steps


def _plain(kind: T.DataType) -> bool:
    """Whether values of a type come back the same from their text."""
    return isinstance(kind, (T.NumericType, T.BooleanType, T.DateType))


def _rank(column: Column) -> Column:
    return F.coalesce(column.cast("long"), F.lit(_NONE))


def status_changes_stream(feed: DataFrame, parts: int = PARTS) -> DataFrame:
    """Status steps of each row: ``table_name, row_id, old_status, new_status, changed_at, late``.

    State is the newest version of each row, by ``parts`` of a hash of the row: a part that a micro-batch
    touches is read and written whole. Versions are ordered inside a micro-batch; one older than
    what an earlier batch has brought makes no step but comes out as ``late``, without an
    ``old_status``: the steps around it are to be taken again from the batch form, for that row only
    (``late_rows``). A row's versions of one micro-batch meet in one task, so limit the
    source (``maxFilesPerTrigger``, ``maxOffsetsPerTrigger``) where a row may change without bound; for a
    backlog use the batch form, which splits such rows.
    """
    keys = ["table_name", "row_id"]
    kinds = {c: feed.schema[c].dataType for c in (*keys, "version_no")}
    text = {k: T.StringType() if _plain(kinds[k]) else kinds[k] for k in keys}
    # Whole microseconds: what state gives back compares with what arrives.
    order = {"_at": _rank(F.unix_micros("version_at")), "version_no": F.col("version_no")}
    if isinstance(kinds["version_no"], T.IntegralType):
        order["version_no"], kinds["version_no"] = _rank(F.col("version_no")), T.LongType()
    rows = feed.select(
        F.pmod(F.xxhash64(*keys), F.lit(parts)).alias("_part"), *[F.col(k).cast(text[k]).alias(k) for k in keys], "status",
        *[order[c].alias(c) for c in _ORDER])
    kept = {**text, "status": T.StringType(), "_at": T.LongType(), "version_no": kinds["version_no"]}
    schema = T.StructType([
        *[T.StructField(k, text[k]) for k in keys], T.StructField("new_status", T.StringType()), T.StructField("_at", T.LongType()),
        T.StructField("old_status", T.StringType()), T.StructField("late", T.BooleanType()),
    ])
    found = rows.groupBy("_part").applyInPandasWithState(
        _last_status(keys), schema, T.StructType([T.StructField(c, T.ArrayType(kind)) for c, kind in kept.items()]),
        "append", GroupStateTimeout.NoTimeout)
    at = F.timestamp_micros(F.nullif("_at", F.lit(_NONE)))
    return found.select(*[F.col(k).cast(feed.schema[k].dataType).alias(k) for k in keys], "new_status", at.alias("changed_at"), "old_status", "late")


def with_late_versions(steps: DataFrame, feed: DataFrame) -> DataFrame:
    """Landed steps with those of rows that had late versions taken again, in order, from all their versions."""
    keys = ["table_name", "row_id"]
    rows = steps.where("late").select(*keys).distinct()
    sound = steps.join(rows, keys, "left_anti").select(*keys, "old_status", "new_status", "changed_at")
    again = status_changes_from_feed(feed.join(rows, keys, "left_semi"))
    return sound.unionByName(again.select(*sound.columns))
