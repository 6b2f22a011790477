"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings. Sizes stay at Spark's own defaults unless they change a plan we care about:
# AQE picks join strategies from measured sizes, splits skewed join partitions and merges small ones.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even if that costs one more exchange further up.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Listing thousands of day folders as one task each costs more than the listing.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "256",
    # State of streams lies on disk, not in executor heaps.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# Only settable before the session starts.
START_CONF = {
    # Recording a Python call site for every column function doubles the time to build a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "tallyline", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or get) a session. Extra settings come as ``spark__sql__x="y"``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**START_CONF, **RUNTIME_CONF, **{k.replace("__", "."): v for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unused path below the cluster's shared checkpoint folder.

    The folder is the one named in ``spark.checkpoint.dir`` (or already set on the
    context). Only where neither is set, as in local tests, a temporary one is made.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="tallyline-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir()
    return f"{root.rstrip('/')}/tallyline/{purpose}-{uuid.uuid4().hex[:12]}"
