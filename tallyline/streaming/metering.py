"""Hourly usage buckets from a stream of raw requests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyline.functions.text import normalise_endpoint
from tallyline.operators.usage import upsert_usage


def meter_hourly_stream(requests: DataFrame, delay: str = "1 hour") -> DataFrame:
    """One row per tenant, hour and endpoint, emitted once the hour is ``delay`` in the past.

    Counts are combined before the shuffle and state holds open hours only. Requests later
    than ``delay`` are beyond the stream; ``usage.remeter`` brings their hours, and those
    still open, into the same table.
    """
    buckets = (
        requests.withWatermark("requested_at", delay)
        .groupBy(
            F.window("requested_at", "1 hour").alias("_hour"), "tenant_id",
            normalise_endpoint(F.col("url")).alias("endpoint"),
        )
        .agg(F.count("*").cast("int").alias("event_count"))
    )
    return buckets.select("tenant_id", F.col("_hour.start").alias("recorded_at"), "endpoint", "event_count")


def land_usage(buckets: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Start putting closed buckets into the usage table at ``path``, until caught up.

    The table is that of ``usage.upsert_usage``, so that late hours may be upserted and readers see
    either all of a batch or nothing. A batch repeated after a failure changes nothing.
    """
    key_type = buckets.schema["tenant_id"].dataType
    return (
        buckets.writeStream.foreachBatch(lambda batch, _: upsert_usage(batch.sparkSession, path, batch, key_type))
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
