"""Usage metering: hourly buckets, replacing upserts, range reads and the published rollup."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from datetime import datetime
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.functions.months import MONTH, within
from tallyline.functions.text import normalise_endpoint
from tallyline.operators.reports import CALLS, cycle_calls, cycle_report, metered_cycles
from tallyline.sources.lake import (
    current_version, delete_path, empty_frame, list_folders, move_path, path_exists, publish_version, read_text, write_text,
)
from tallyline.sources.schema import schema_of

DAY = "day"
#: Stands for the day of rows that have none.
UNDATED = "undated"
NATURAL_KEY = ["tenant_id", "recorded_at", "endpoint"]


def meter_hourly(requests: DataFrame) -> DataFrame:
    """One row per tenant, hour and endpoint with its number of requests.

    Counts are combined before the shuffle, so a tenant with most of the traffic sends one
    row per bucket and task.
    """
    return requests.groupBy(
        "tenant_id", F.date_trunc("hour", "requested_at").alias("recorded_at"),
        normalise_endpoint(F.col("url")).alias("endpoint"),
    ).agg(F.count("*").cast("int").alias("event_count"))


def with_bucket_id(buckets: DataFrame) -> DataFrame:
    """Buckets with an ``id`` made from their natural key: the same bucket always gets the same one."""
    if "id" in buckets.columns:
        return buckets
    if isinstance(buckets.schema["tenant_id"].dataType, T.StringType):
        key = F.sha2(F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in NATURAL_KEY])), 256)
    else:
        key = F.xxhash64(*NATURAL_KEY)
    return buckets.withColumn("id", key)


def usage_between(
    usage: DataFrame, start: str | datetime, end: str | datetime, tenant_id: object | None = None,
) -> DataFrame:
    """Usage in ``[start, end)``, of one tenant or of all."""
    rows = within(usage, "recorded_at", start, end)
    return rows if tenant_id is None else rows.where(F.col("tenant_id") == F.lit(tenant_id))


def newest_per_bucket(old: DataFrame, batch: DataFrame) -> DataFrame:
    """Old rows and a batch merged on the natural key; the batch's count wins.

    A grouped maximum, not a window: it combines before the shuffle and sorts nothing.
    """
    rest = [c for c in batch.columns if c not in (*NATURAL_KEY, MONTH)]
    ranked = old.select(*NATURAL_KEY, *rest, F.lit(0).alias("_rank")).unionByName(
        batch.select(*NATURAL_KEY, *rest, F.lit(1).alias("_rank")),
    )
    newest = F.max_by(F.struct(*rest), F.struct("_rank", *rest))
    return ranked.groupBy(*NATURAL_KEY).agg(newest.alias("_row")).select(*NATURAL_KEY, "_row.*")


def _manifest(spark: SparkSession, path: str) -> dict[str, str]:
    """Folder of each day that readers see and, under ``UNDATED``, that of the rows without a usable time."""
    current = current_version(spark, path)
    return {} if current is None else json.loads(read_text(spark, current))


def day_folders(spark: SparkSession, path: str) -> dict[str, str]:
    """The folder of each day that readers see, as the published manifest lists them."""
    return {day: folder for day, folder in _manifest(spark, path).items() if day != UNDATED}


def read_folders(spark: SparkSession, path: str, folders: list[str], schema: T.StructType) -> DataFrame:
    """Rows of day folders, with their ``month``."""
    if not folders:
        return empty_frame(spark, T.StructType([*schema.fields, T.StructField(MONTH, T.StringType())]))
    stored = T.StructType([*schema.fields, *[T.StructField(n, T.StringType()) for n in (MONTH, DAY, "version")]])
    files = spark.read.schema(stored).option("basePath", f"{path}/data").parquet(*[f"{path}/data/{f}" for f in folders])
    return files.drop(DAY, "version")


def read_usage(spark: SparkSession, path: str, key_type: T.DataType | None = None) -> DataFrame:
    """The usage table that ``upsert_usage`` and ``land_usage`` keep, with its ``month`` folder.

    A reader sees the table as it was published when the frame was made, whatever is written meanwhile.
    """
    path = path.rstrip("/")
    return read_folders(spark, path, sorted(day_folders(spark, path).values()), schema_of("api_usage_events", key_type))


def undated_usage(spark: SparkSession, path: str, key_type: T.DataType | None = None) -> DataFrame:
    """Rows that came without a time, or with one outside the years 1 to 9999: no day is theirs, and no report counts them."""
    path, schema = path.rstrip("/"), schema_of("api_usage_events", key_type)
    folder = _manifest(spark, path).get(UNDATED)
    return empty_frame(spark, schema) if folder is None else spark.read.schema(schema).parquet(f"{path}/{folder}")


class Upserted(NamedTuple):
    """What ``upsert_usage`` has published: days it has put in place, rows it has set aside without a time."""

    days: int
    undated: int


def upsert_usage(spark: SparkSession, path: str, batch: DataFrame, key_type: T.DataType | None = None) -> Upserted:
    """Replace-on-conflict write of ``batch`` into the usage table at ``path``.

    ``batch`` is what ``meter_hourly`` returns, or rows of the usage table. It is evaluated once, into a stage by day. Days that
    the table does not have yet are moved from there as they are; only those it has are merged with
    what they hold. Rows without a usable time are set aside, merged on the same key, for ``undated_usage`` to read. A manifest that names a
    folder for every day, each seen to exist, is then published in one rename. Readers therefore never meet a
    day half replaced, a run that dies publishes nothing, and repeating a batch changes nothing.
    ``vacuum_usage`` removes folders no longer named.
    """
    schema, path = schema_of("api_usage_events", key_type), path.rstrip("/")
    version, stage = uuid.uuid4().hex, f"{path}/stage-{uuid.uuid4().hex}"
    manifest = _manifest(spark, path)
    rows = with_bucket_id(batch).select(*[F.col(f.name).cast(f.dataType) for f in schema])
    _write_days(newest_per_bucket(empty_frame(spark, schema), rows), version, stage)
    # Bounded by the calendar, not by the data: one short text per touched day.
    touched = {name.split("=", 1)[1]: f"{month}/{name}" for month in list_folders(spark, stage, f"{MONTH}=")
               for name in list_folders(spark, f"{stage}/{month}", f"{DAY}=")}
    undated = touched.pop(UNDATED, None)
    known = [day for day in touched if day in manifest]
    for day in touched.keys() - set(known):
        move_path(spark, f"{stage}/{touched[day]}/version={version}", f"{path}/data/{touched[day]}/version={version}")
    if known:
        staged = _read_stage(spark, stage, [touched[day] for day in known], schema)
        _write_days(newest_per_bucket(read_folders(spark, path, [manifest[d] for d in known], schema), staged), version, f"{path}/data")
    aside = 0
    if undated:
        waiting = _read_stage(spark, stage, [undated], schema)
        aside = waiting.count()
        merged = newest_per_bucket(undated_usage(spark, path, key_type), waiting).select(*schema.names)
        merged.write.parquet(f"{path}/{UNDATED}/version={version}")
        manifest[UNDATED] = f"{UNDATED}/version={version}"
    if touched or undated:
        new = {day: f"{folder}/version={version}" for day, folder in touched.items()}
        if absent := [f for f in new.values() if not path_exists(spark, f"{path}/data/{f}")]:
            raise RuntimeError(f"not written, nothing published: {absent[:3]}")
        write_text(spark, f"{path}/manifest-{version}.json", json.dumps(manifest | new, sort_keys=True))
        publish_version(spark, path, f"manifest-{version}.json")
    delete_path(spark, stage)
    return Upserted(len(touched), aside)


def _write_days(rows: DataFrame, version: str, path: str) -> None:
    """Rows in folders by month, day and version; all without a usable time in those of one name."""
    at = F.col("recorded_at")
    dated = at.between(F.lit("0001-01-01").cast("timestamp"), F.lit("9999-12-31 23:59:59.999999").cast("timestamp"))
    folder = lambda text: F.when(dated, F.date_format(at, text)).otherwise(UNDATED)
    (
        rows.withColumn(MONTH, folder("yyyy-MM")).withColumn(DAY, folder("yyyy-MM-dd")).withColumn("version", F.lit(version))
        .hint("rebalance", F.col(DAY)).sortWithinPartitions(DAY, "tenant_id", "recorded_at")
        .write.mode("append").partitionBy(MONTH, DAY, "version").parquet(path)
    )


def _read_stage(spark: SparkSession, stage: str, folders: list[str], schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*[f"{stage}/{f}" for f in folders])


def remeter(
    spark: SparkSession, path: str, requests: DataFrame, start: str | datetime, end: str | datetime | None = None,
    key_type: T.DataType | None = None,
) -> None:
    """Meter the hours of ``[start, end)`` again from the raw requests and put them in the table.

    For hours a stream left open or closed before their last request came. Both bounds must be
    whole hours, since an hour's count is replaced.
    """
    upsert_usage(spark, path, meter_hourly(within(requests, "requested_at", start, end)), key_type)


def vacuum_usage(spark: SparkSession, path: str, rollups: Iterable[str] = ()) -> int:
    """Delete folders and manifests that are not published; returns how many folders went.

    ``rollups`` are paths of rollups kept by ``refresh_from_usage``: the days they were made from stay, so that their
    next refresh can tell what has changed. Not to be run while somebody reads an older state or writes a new one.
    """
    path = path.rstrip("/")
    manifest, gone = _manifest(spark, path), 0
    named = {f if day == UNDATED else f"data/{f}" for day, f in manifest.items()}
    for rollup in rollups:
        named |= {f"data/{f}" for f in _source(spark, current_version(spark, rollup.rstrip("/"))).values()}
    days = [f"data/{month}/{day}" for month in list_folders(spark, f"{path}/data", f"{MONTH}=")
            for day in list_folders(spark, f"{path}/data/{month}", f"{DAY}=")]
    for folder in [*days, UNDATED]:
        for version in list_folders(spark, f"{path}/{folder}", "version="):
            if f"{folder}/{version}" not in named:
                delete_path(spark, f"{path}/{folder}/{version}")
                gone += 1
    for stage in list_folders(spark, path, "stage-"):
        delete_path(spark, f"{path}/{stage}")
    return gone


def refresh_usage_by_cycle(spark: SparkSession, rollup: DataFrame, path: str, version: str) -> str:
    """Write ``rollup`` as a new version below ``path`` and point readers at it.

    Readers keep the previous version until the pointer moves, and it moves only if the
    stored copy is unique on (subscription, endpoint). A version that exists is never written again;
    that of a refused or lost refresh stays unpublished. Returns the new version's path.
    """
    target = f"{path.rstrip('/')}/{version}"
    if path_exists(spark, target):
        raise ValueError(f"rollup version {version} exists; versions are written once")
    rollup.write.parquet(target)
    repeated = (
        spark.read.parquet(target).groupBy("subscription_id", "endpoint").count().where("count > 1")
    )
    if not repeated.isEmpty():
        raise ValueError(f"rollup version {version} repeats a (subscription_id, endpoint)")
    publish_version(spark, path.rstrip("/"), version)
    return target


def _source(spark: SparkSession, version: str | None) -> dict[str, str]:
    """The folders of usage days that a rollup version was made from."""
    source = f"{version}.source.json"
    return json.loads(read_text(spark, source)) if version and path_exists(spark, source) else {}


def refresh_from_usage(
    spark: SparkSession, usage: str, path: str, version: str, tenants: DataFrame, subscriptions: DataFrame, plans: DataFrame,
    as_of: str | datetime | None = None, key_type: T.DataType | None = None,
) -> Refreshed:
    """Publish the rollup of the usage table at ``usage`` as a new version, from what has changed since the last one.

    The last version remembers its usage days by their folders, its cycles, and the calls of each. A cycle that is
    still the same takes its calls from there, less what the changed days held before, plus what they hold now. Cycles that are new or other
    than before are counted from the whole table, their months only. The first version, one that was made another way, and one whose days have been
    vacuumed are counted so for all cycles. The result is always that of ``reports.usage_by_cycle``.
    """
    usage, path = usage.rstrip("/"), path.rstrip("/")
    schema = schema_of("api_usage_events", key_type)
    target, last = f"{path}/{version}", current_version(spark, path)
    if path_exists(spark, target):
        raise ValueError(f"rollup version {version} exists; versions are written once")
    now, before = day_folders(spark, usage), _source(spark, last)
    changed = sorted(day for day in now.keys() | before.keys() if now.get(day) != before.get(day))
    stale = [before[day] for day in changed if day in before]
    usable = bool(last) and path_exists(spark, f"{last}.cycles") and path_exists(spark, f"{last}.source.json") and all(
        path_exists(spark, f"{usage}/data/{f}") for f in stale)

    metered_cycles(tenants, subscriptions).write.mode("overwrite").parquet(f"{target}.cycles")
    cycles = spark.read.parquet(f"{target}.cycles")
    whole, others = read_folders(spark, usage, sorted(now.values()), schema), cycles
    parts = []
    if usable:
        old = spark.read.schema(cycles.schema).parquet(f"{last}.cycles")
        shape = ["subscription_id", "tenant_id", "period_start", "period_end"]
        a, b = cycles.select(*shape), old.select(*shape)
        moved = a.exceptAll(b).unionByName(b.exceptAll(a)).select("subscription_id").distinct()
        same, others = cycles.join(moved, "subscription_id", "left_anti"), cycles.join(moved, "subscription_id", "left_semi")
        held = spark.read.parquet(f"{last}.calls")
        parts.append(held.join(same.select("subscription_id").distinct(), "subscription_id", "left_semi"))
        for folders, sign in ((stale, -1), ([now[day] for day in changed if day in now], 1)):
            if folders:
                calls = cycle_calls(read_folders(spark, usage, folders, schema), same)
                parts.append(calls.select("subscription_id", "endpoint", *[(F.col(c) * sign).alias(c) for c in CALLS]))
    if not usable or not others.isEmpty():
        parts.append(cycle_calls(whole, others))
    total = reduce(DataFrame.unionByName, parts).groupBy("subscription_id", "endpoint").agg(*[F.sum(c).alias(c) for c in CALLS])
    total.where("buckets > 0").write.mode("overwrite").parquet(f"{target}.calls")
    write_text(spark, f"{target}.source.json", json.dumps(now, sort_keys=True))
    calls = spark.read.parquet(f"{target}.calls")
    return Refreshed(refresh_usage_by_cycle(spark, cycle_report(calls, cycles, plans, as_of), path, version),
                     len(changed) if usable else len(now), usable)


class Refreshed(NamedTuple):
    """Path of a published rollup version, usage days read for cycles as before, whether the last version was of use."""

    path: str
    days: int
    incremental: bool


def read_usage_by_cycle(spark: SparkSession, path: str) -> DataFrame:
    """The published version of the rollup."""
    current = current_version(spark, path.rstrip("/"))
    if current is None:
        raise FileNotFoundError(f"no published rollup below {path}")
    return spark.read.parquet(current)
