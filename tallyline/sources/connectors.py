"""Network sources and sinks. They need a driver or connector jar on the cluster's class path."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter


def read_jdbc(
    spark: SparkSession, url: str, table: str, *, column: str = "changed_at",
    lower: datetime | str, upper: datetime | str, partitions: int, fetch_size: int = 10_000,
    **options: str,
) -> DataFrame:
    """A relational table read in ``partitions`` ranges of ``column`` at once.

    Bounds only steer the ranges; rows outside them are read too. Filters and column
    lists reach the database.
    """
    return (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("partitionColumn", column)
        .option("lowerBound", str(lower))
        .option("upperBound", str(upper))
        .option("numPartitions", partitions)
        .option("fetchsize", fetch_size)
        .options(**options)
        .load()
    )


def kafka_source(
    spark: SparkSession, servers: str, topics: list[str], *, max_per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """Events of the given topics from the earliest offset, as ``topic, key, value`` text."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", "earliest")
        .options(**options)
    )
    if max_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.load().selectExpr("topic", "CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value")


def kafka_sink(events: DataFrame, servers: str, checkpoint: str, **options: str) -> DataStreamWriter:
    """A writer for ``topic, key, value`` rows. Progress moves on only after a confirmed batch."""
    return (
        events.select("topic", "key", "value")
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("checkpointLocation", checkpoint)
        .options(**options)
    )
