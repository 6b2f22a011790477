"""Audit rows as events. Everything here works on batch and streaming frames alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.functions.text import iso_instant
from tallyline.sources.schema import EVENT_FIELDS, EVENT_SCHEMA

# The topic of each routed table. The first one carries status changes of
# invoices too; the name is kept because readers subscribe to it.
TOPICS = {
    "invoices": "billing.invoice.created",
    "subscriptions": "billing.subscription.changed",
}


def route(log: DataFrame) -> DataFrame:
    """Audit rows with their ``topic``; rows of tables without one are left out."""
    topic = F.when(F.lit(False), "")
    for table, name in TOPICS.items():
        topic = topic.when(F.col("table_name") == table, name)
    return log.where(F.col("table_name").isin(*TOPICS)).withColumn("topic", topic)


def to_event(routed: DataFrame) -> DataFrame:
    """Routed rows as ``topic, key, value, changed_at``: a flat JSON object of text fields.

    The key is the audit id, the identity under which repeats are recognised.
    ``changed_at`` stays beside it as the event time.
    """
    text = {
        "audit_log_id": F.col("id").cast("string"),
        "row_id": F.col("row_id").cast("string"),
        "changed_at": iso_instant(F.col("changed_at")),
    }
    fields = [(text[name] if name in text else F.col(name)).alias(name) for name in EVENT_FIELDS]
    return routed.select(
        "topic", F.col("id").cast("string").alias("key"),
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"), "changed_at",
    )


def parse_event(events: DataFrame) -> DataFrame:
    """Events as ``topic``, the payload's fields, ``event_date``, and ``key``, ``value`` and ``reason``.

    The date is the first ten characters of the text, in the writer's zone as written. ``reason``
    says why an event cannot be used: no JSON object, no id, or no date that exists. It is NULL for
    all others. A bad event never stops its batch.
    """
    payload = F.from_json("value", EVENT_SCHEMA, {"mode": "PERMISSIVE"})
    day = F.substring("_payload.changed_at", 1, 10)
    dated = day.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & F.try_to_date(day, "yyyy-MM-dd").isNotNull()
    nothing = F.coalesce(*[F.col(f"_payload.{f.name}").cast("string") for f in EVENT_SCHEMA]).isNull()
    reason = (
        F.when(nothing, "unreadable").when(F.col("_payload.audit_log_id").isNull(), "no id")
        .when(~F.coalesce(dated, F.lit(False)), "no date")
    )
    return events.select("topic", "key", "value", payload.alias("_payload")).select(
        "topic", "_payload.*", day.alias("event_date"), "key", "value", reason.alias("reason"),
    )


def dedupe_events(events: DataFrame, delay: str = "1 day") -> DataFrame:
    """Drop repeats of an event key that arrive within ``delay`` of event time.

    State is bounded by the delay. Later repeats are stopped at the landing, which knows
    every event it holds.
    """
    return events.withWatermark("changed_at", delay).dropDuplicatesWithinWatermark(["topic", "key"])
