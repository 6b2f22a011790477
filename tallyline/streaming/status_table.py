"""Status steps kept in a table by a stream of row versions, late versions included.

Every batch is one commit below ``path``: its versions, the steps they make, and the newest version of each row it touches, by
parts of a hash of the row. What is published is a list of commits, replaced in one rename. All work is joins and windows in the JVM.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce
from operator import and_

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallyline.plans.windows import piece_begins, with_previous
from tallyline.sources.lake import current_version, delete_path, empty_frame, list_folders, publish_version, read_text, write_text

KEYS, ORDER = ["table_name", "row_id"], ["version_at", "version_no"]
PLACE = [*KEYS, *ORDER]
STEP = [*KEYS, "old_status", "new_status", "changed_at"]
#: Parts of the rows, and commits whose newest versions are looked through before they are merged.
PARTS, RUNS = 32, 12


def _state(spark: SparkSession, path: str) -> dict:
    """What is published: the number of the last commit, and the commits whose files of each kind count."""
    current = current_version(spark, path)
    empty = {"number": 0, "versions": [], "newest": [], "steps": [], "again": []}
    return empty if current is None else json.loads(read_text(spark, current))


def _read(spark: SparkSession, path: str, kind: str, commits: list[str], schema: T.StructType) -> DataFrame:
    """Files of one kind, with the ``commit`` they belong to; later commits have greater names."""
    whole = T.StructType([*schema.fields, T.StructField("commit", T.StringType())])
    if not commits:
        return empty_frame(spark, whole)
    return spark.read.schema(whole).option("basePath", f"{path}/{kind}").parquet(*[f"{path}/{kind}/commit={c}" for c in commits])


def _equal(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    return reduce(and_, [left[c].eqNullSafe(right[c]) for c in columns])


def _by_part(rows: DataFrame, path: str) -> None:
    rows.hint("rebalance", F.col("part")).sortWithinPartitions("part", *KEYS).write.partitionBy("part").parquet(path)


def _newest(rows: DataFrame) -> DataFrame:
    """The newest of the versions of each row."""
    top = F.max_by("status", F.struct(*ORDER))
    return rows.groupBy("part", *KEYS).agg(F.max(F.struct(*ORDER)).alias("_top"), top.alias("status")).select("part", *KEYS, "_top.*", "status")


def _steps(versions: DataFrame, begins: DataFrame | None = None) -> DataFrame:
    """Steps between versions; the first of a row comes from its ``_last`` version, where there is one."""
    compared = with_previous(versions, KEYS, ORDER, "status", None, "_previous", begins=begins)
    if "_last" in versions.columns:
        last = F.when(F.col("_last").isNotNull(), F.struct(F.col("_last_status").alias("value")))
        compared = compared.withColumn("_previous", F.coalesce("_previous", last))
    changed = compared.where(F.col("_previous").isNotNull() & ~F.col("_previous.value").eqNullSafe(F.col("status")))
    return changed.select(*KEYS, F.col("_previous.value").alias("old_status"), F.col("status").alias("new_status"), F.col("version_at").alias("changed_at"))


def land_versions(batch: DataFrame, path: str) -> None:
    """Add row versions to the table of status steps at ``path``: ``table_name, row_id, status, version_at, version_no``.

    A version after the newest of its row makes a step from that one; the first of a row makes none. Where one comes that is older, the
    steps of its row are taken again from all its versions, in the same commit, and replace what was there. Only such rows' versions are read
    again; of all others the newest is enough. A version that is there already, by row, time and number, changes nothing, so that a batch may be
    repeated. Of several with one place in a batch the least status counts. A run that dies publishes nothing.
    """
    spark, path = batch.sparkSession, path.rstrip("/")
    state = _state(spark, path)
    commit = f"{state['number'] + 1:010d}-{uuid.uuid4().hex}"
    into = lambda kind: f"{path}/{kind}/commit={commit}"
    part = F.pmod(F.xxhash64(*KEYS), F.lit(PARTS)).cast("int").alias("part")
    _by_part(batch.groupBy(*PLACE).agg(F.min("status").alias("status")).select("*", part), into("versions"))
    touched = [int(f.split("=")[1]) for f in list_folders(spark, into("versions"), "part=")]  # PARTS at most
    if not touched:
        return
    keys = T.StructType([batch.schema[c] for c in KEYS])
    schema = T.StructType([*[batch.schema[c] for c in PLACE], T.StructField("status", T.StringType()), T.StructField("part", T.IntegerType())])

    def own(kind: str, commits: list[str]) -> DataFrame:
        return _read(spark, path, kind, commits, schema).where(F.col("part").isin(touched)).select(*schema.names)

    begun: list[DataFrame] = []

    def stepped(rows: DataFrame) -> DataFrame:
        begun.append(piece_begins(rows, KEYS, ORDER, F.lit(0)).persist(StorageLevel.DISK_ONLY))
        begun[-1].count()  # Their size is known then, and most often that of nothing.
        return _steps(rows, begun[-1])

    try:
        new, known = own("versions", [commit]), own("newest", state["newest"])
        known = _newest(known) if len(state["newest"]) > 1 else known
        last = known.select(*[F.col(k).alias(f"_{k}") for k in KEYS], F.struct(*ORDER).alias("_last"), F.col("status").alias("_last_status"))
        matched = new.join(last, reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in KEYS]), "left").drop(*[f"_{k}" for k in KEYS])
        # Looked at several times, but made once.
        matched.where(F.col("_last").isNull() | (F.struct(*ORDER) != F.col("_last"))).write.parquet(into("matched"))
        matched = spark.read.schema(matched.schema).parquet(into("matched"))
        behind = matched.where(F.struct(*ORDER) < F.col("_last")).select(*PLACE)
        ahead = matched.where(F.col("_last").isNull() | (F.struct(*ORDER) > F.col("_last")))
        parts, line = [], ahead
        if not behind.isEmpty():
            history = own("versions", state["versions"])
            behind.join(history, _equal(behind, history, PLACE), "left_anti").select(*KEYS).distinct().write.parquet(into("again"))
            late = _read(spark, path, "again", [commit], keys).select(*KEYS)
            if not late.isEmpty():
                whole = own("versions", [*state["versions"], commit])
                whole = whole.join(late, _equal(whole, late, KEYS), "left_semi").groupBy(*PLACE).agg(F.min("status").alias("status"))
                parts.append(stepped(whole))
                line = ahead.join(late, _equal(ahead, late, KEYS), "left_anti")
                state["again"].append(commit)
        parts.append(stepped(line))
        reduce(DataFrame.unionByName, parts).write.parquet(into("steps"))

        # Rows that came no further have their newest version in an earlier run. Up to RUNS runs of newest versions, then one.
        merge = len(state["newest"]) >= RUNS
        top = ahead.select(*schema.names)
        _by_part(_newest(top.unionByName(_read(spark, path, "newest", state["newest"], schema).select(*schema.names)) if merge else top), into("newest"))
    finally:
        for rows in begun:
            rows.unpersist()
        delete_path(spark, into("matched"))
    state |= {"number": state["number"] + 1, "versions": [*state["versions"], commit], "steps": [*state["steps"], commit]}
    if list_folders(spark, into("newest"), "part="):
        state["newest"] = [commit] if merge else [*state["newest"], commit]
    write_text(spark, f"{path}/{commit}.json", json.dumps(state))
    publish_version(spark, path, f"{commit}.json")


def read_status_changes(spark: SparkSession, path: str, key_type: T.DataType | None = None) -> DataFrame:
    """The steps as published: ``table_name, row_id, old_status, new_status, changed_at``; of rows taken again only what came since."""
    path, text = path.rstrip("/"), T.StringType()
    state, keys = _state(spark, path), [T.StructField("table_name", text), T.StructField("row_id", key_type or text)]
    schema = T.StructType([*keys, T.StructField("old_status", text), T.StructField("new_status", text), T.StructField("changed_at", T.TimestampType())])
    again = _read(spark, path, "again", state["again"], T.StructType(keys))
    again = again.groupBy(*[F.col(k).alias(f"_{k}") for k in KEYS]).agg(F.max("commit").alias("_again"))
    steps = _read(spark, path, "steps", state["steps"], schema)
    found = steps.join(again, reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in KEYS]), "left")
    return found.where(F.col("_again").isNull() | (F.col("commit") >= F.col("_again"))).select(*STEP)


def land_status_changes(feed: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Start keeping the table of status steps of a stream of row versions, until caught up."""
    return (
        feed.writeStream.foreachBatch(lambda batch, _: land_versions(batch, path))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
