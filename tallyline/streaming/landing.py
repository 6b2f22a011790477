"""The raw landing zone: JSON by topic and event date, each event once."""

from __future__ import annotations

import logging
import time

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyline.sources.lake import delete_path, path_exists, read_raw, write_text
from tallyline.streaming.events import parse_event

log = logging.getLogger(__name__)

FOLDERS = ["topic", "event_date"]
IDENTITY = [*FOLDERS, "audit_log_id"]
_REJECTED = "topic string, key string, value string, reason string, identity string, batch string, part string"


class Drain:
    """The time a run may take. It ends between batches, never inside one, and never before the first."""

    def __init__(self, seconds: float | None = None) -> None:
        self.seconds, self.begun, self.batches, self.paused = seconds, time.monotonic(), 0, False

    def over(self) -> bool:
        self.paused = self.seconds is not None and self.batches > 0 and time.monotonic() - self.begun > self.seconds
        return self.paused


class _Paused(Exception):
    """Raised before a batch is begun; the next run begins with it."""


def _beside(path: str, name: str) -> str:
    return f"{path.rstrip('/')}.{name}"


def _stored(spark: SparkSession, path: str, name: str, schema: str) -> DataFrame:
    """What is kept beside the landing, or no rows of it."""
    folder = _beside(path, name)
    return spark.read.schema(schema).parquet(folder) if path_exists(spark, folder) else spark.createDataFrame([], schema)


def landed_ids(spark: SparkSession, path: str) -> DataFrame:
    """Topic, day and id of what has landed: an index by month beside the landing, a few bytes an event."""
    return _stored(spark, path, "ids", "topic string, event_date string, audit_log_id string, event_month string")


def _index(events: DataFrame, path: str, mode: str) -> None:
    """The numbers of each day, and the ids of events, each file of them sorted by day and id.

    In this order: ``events`` may have been found by the ids, and what is cached of them ends when these are written.
    """
    _per_day(events).write.mode(mode).parquet(_beside(path, "days"))
    (
        events.select(*IDENTITY, F.substring("event_date", 1, 7).alias("event_month")).hint("rebalance", F.col("event_month"))
        .sortWithinPartitions("event_month", "event_date", "audit_log_id")
        .write.mode(mode).partitionBy("event_month").parquet(_beside(path, "ids"))
    )


def _indexed(spark: SparkSession, path: str) -> bool:
    """Whether the index is whole: no run has died between events and index, and there is one if there are events."""
    if path_exists(spark, _beside(path, "ids.pending")):
        return False
    return path_exists(spark, _beside(path, "days")) or not path_exists(spark, path)


def _per_day(events: DataFrame) -> DataFrame:
    """What a check of the landing wants to know of each day."""
    return events.groupBy("event_date").agg(F.count("*").alias("events"), F.max("changed_at").alias("newest_changed_at"))


def _reject(wrong: DataFrame, path: str, batch: str) -> None:
    """Append rejected events not kept yet. An event is known by all it came with, whatever batch or stream brings it."""
    spark = wrong.sparkSession
    content = F.to_json(F.struct("topic", "key", "value"), {"ignoreNullFields": "false"})
    found = (
        wrong.withColumn("identity", F.sha2(content, 256)).withColumn("part", F.substring("identity", 1, 1))
        .dropDuplicates(["identity"]).persist()
    )
    try:
        parts = [r[0] for r in found.select("part").distinct().collect()]  # 16 at most
        if parts:
            known = _stored(spark, path, "rejected", _REJECTED).where(F.col("part").isin(parts)).select("identity")
            fresh = found.join(known, "identity", "left_anti").withColumn("batch", F.lit(batch))
            fresh.hint("rebalance", F.col("part")).write.mode("append").partitionBy("part").parquet(_beside(path, "rejected"))
    finally:
        found.unpersist()


def _known(good: DataFrame, path: str) -> DataFrame:
    """Identities that have landed, of the days and in the range of ids that ``good`` has."""
    # Bounded by the calendar, since every date exists: one row per day of the batch.
    days = good.groupBy("event_date").agg(F.min("audit_log_id").alias("low"), F.max("audit_log_id").alias("high")).collect()
    known = landed_ids(good.sparkSession, path).where(F.col("event_month").isin(sorted({d.event_date[:7] for d in days})))
    if days:
        known = known.where(F.col("event_date").isin([d.event_date for d in days])).where(
            F.col("audit_log_id").between(min(d.low for d in days), max(d.high for d in days)))
    return known.select(*IDENTITY)


def land_batch(events: DataFrame, path: str, batch: str = "") -> None:
    """Append the events not yet landed. Repeating a batch, whole or in part, adds nothing.

    An event's topic, date and id never change, so only the index folders of the batch's months are searched for it, and in
    their sorted files only row groups that may hold its days and ids. Events without an id or a date that exists do not land; they go, as
    they came and once each, to the table beside the landing that ``rejected`` reads, with the name of the first ``batch`` that had them.
    """
    spark = events.sparkSession
    if not _indexed(spark, path):  # one reading of the landing
        _index(read_raw(spark, path), path, "overwrite")
        delete_path(spark, _beside(path, "ids.pending"))
    sound = parse_event(events).persist()
    try:
        _reject(sound.where("reason is not null").select("topic", "key", "value", "reason"), path, batch)
        good = sound.where("reason is null").drop("key", "value", "reason")
        fresh = good.dropDuplicates(IDENTITY).join(_known(good, path), IDENTITY, "left_anti").persist()
        try:
            write_text(spark, _beside(path, "ids.pending"), batch)
            (
                fresh.hint("rebalance", *[F.col(c) for c in FOLDERS])
                .write.mode("append").partitionBy(*FOLDERS).option("ignoreNullFields", "false").json(path)
            )
            _index(fresh, path, "append")
            delete_path(spark, _beside(path, "ids.pending"))
        finally:
            fresh.unpersist()
    finally:
        sound.unpersist()


def rejected(spark: SparkSession, path: str) -> DataFrame:
    """Events that could not land, once each, with the reason and the batch that first brought them."""
    return _stored(spark, path, "rejected", _REJECTED).drop("identity", "part")


def land_raw(events: DataFrame, path: str, checkpoint: str, drain: Drain | None = None) -> StreamingQuery:
    """Start landing a stream of ``topic, key, value`` events; stops once it has caught up.

    Progress lives in the checkpoint and moves only after a batch is written. A batch
    repeated after a failure lands nothing twice. ``drain`` may end the run before some later batch.
    """
    drain = drain or Drain()

    def land(batch: DataFrame, number: int) -> None:
        if drain.over():
            raise _Paused
        land_batch(batch, path, str(number))
        drain.batches += 1

    return (
        events.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def caught_up(query: StreamingQuery, drain: Drain) -> bool:
    """Wait for a query to end; false if its drain ended it with batches still to come."""
    try:
        query.awaitTermination()
    except StreamingQueryException:
        if not drain.paused:
            raise
    return not drain.paused


def verify_landing(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    """One row: number of landed events and the newest change among them. Warns when empty.

    ``since`` (a day) limits the check to later days. No event is read, since every batch leaves its numbers of each day beside the
    landing; only while a run has not come to that, or died before, are the events themselves counted.
    """
    days = (_stored(spark, path, "days", "event_date string, events long, newest_changed_at string") if _indexed(spark, path)
            else _per_day(read_raw(spark, path)))
    if since is not None:
        days = days.where(F.col("event_date") >= since)
    summary = days.agg(F.coalesce(F.sum("events"), F.lit(0)).alias("events"), F.max("newest_changed_at").alias("newest_changed_at"))
    if summary.first().events == 0:
        log.warning("no events below %s; fine if nothing changed since the last run", path)
    return summary
