"""Extract, land, verify: the whole audit-event pipeline as one restartable call."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.sources.schema import schema_of
from tallyline.streaming.events import route, to_event
from tallyline.streaming.landing import Drain, caught_up, land_raw, verify_landing

FILES_PER_BATCH = 64


def audit_stream(
    spark: SparkSession, path: str, key_type: T.DataType | None = None, max_files: int = FILES_PER_BATCH,
) -> DataFrame:
    """The audit log's files as a stream: each file is read once, whenever its rows were committed.

    A backlog is taken ``max_files`` at a time, so that a run may end between batches.
    """
    reader = spark.readStream.schema(schema_of("billing_audit_log", key_type))
    return reader.option("maxFilesPerTrigger", max_files).parquet(path)


def run_pipeline(
    spark: SparkSession, source: str, landing: str, checkpoint: str, key_type: T.DataType | None = None,
    seconds: float | None = 60, max_files: int = FILES_PER_BATCH, verify_since: str | None = None,
) -> DataFrame:
    """Land audit events of ``source`` not landed yet; returns the landing's summary row.

    After ``seconds`` no further batch is begun (None: no bound). ``caught_up`` in the summary says whether
    anything was left for the next run; every run lands one batch at least. Each step may be
    repeated at any time. ``verify_since`` limits the summary to later days.
    """
    events, drain = to_event(route(audit_stream(spark, source, key_type, max_files))), Drain(seconds)
    done = caught_up(land_raw(events, landing, checkpoint, drain), drain)
    return verify_landing(spark, landing, verify_since).withColumn("caught_up", F.lit(done))
