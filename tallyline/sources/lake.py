"""Files of the lake: month-partitioned facts, the raw JSON landing, published versions."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.functions.months import MONTH, month_key
from tallyline.sources.schema import EVENT_SCHEMA

_POINTER = "CURRENT"
_COMPLETE = "_COMPLETE"


def _path(spark: SparkSession, path: str):
    """Hadoop path and its file system, so that any cluster file system works."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows of ``schema``, known to be empty when plans are made."""
    return spark.range(0).where(F.lit(False)).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema],
    )


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop, fs = _path(spark, path)
    return fs.exists(hadoop)


def list_folders(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """Names of the folders directly below ``path`` that start with ``prefix``, sorted."""
    hadoop, fs = _path(spark, path)
    if not fs.exists(hadoop):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(hadoop) if s.isDirectory()]
    return sorted(n for n in names if n.startswith(prefix))


def folder_signature(spark: SparkSession, path: str) -> str:
    """Names and lengths of the files of a folder, digested: no data read. Written files have names of their own."""
    hadoop, fs = _path(spark, path)
    files = sorted(f"{s.getPath().getName()} {s.getLen()}" for s in fs.listStatus(hadoop) if s.isFile())
    return hashlib.sha256("\n".join(files).encode()).hexdigest()


def delete_path(spark: SparkSession, path: str) -> None:
    hadoop, fs = _path(spark, path)
    fs.delete(hadoop, True)


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder to where nothing is yet: no data read."""
    old, fs = _path(spark, source)
    new, _ = _path(spark, target)
    fs.mkdirs(new.getParent())
    if not fs.rename(old, new):
        raise RuntimeError(f"could not move {source} to {target}")


def replace_months(spark: SparkSession, stage: str, path: str) -> None:
    """Put the staged month folders in the place of those of ``path``: renames, no data read.

    A run that dies in between may simply be repeated: a month still staged is moved
    again, a month no longer staged is in place.
    """
    _, fs = _path(spark, path)
    for month in month_folders(spark, stage):
        source, _ = _path(spark, f"{stage}/{MONTH}={month}")
        target, _ = _path(spark, f"{path}/{MONTH}={month}")
        fs.mkdirs(target.getParent())
        fs.delete(target, True)
        if not fs.rename(source, target):
            raise RuntimeError(f"could not move {source} to {target}")


def mark_complete(spark: SparkSession, path: str) -> None:
    """Leave a marker that everything below ``path`` is written."""
    hadoop, fs = _path(spark, f"{path}/{_COMPLETE}")
    fs.create(hadoop, True).close()


def is_complete(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path}/{_COMPLETE}")


def has_month_folders(spark: SparkSession, path: str) -> bool:
    return bool(list_folders(spark, path, f"{MONTH}="))


def month_folders(spark: SparkSession, path: str) -> list[str]:
    """Months that have a folder: one listing, no data read."""
    return [name.split("=", 1)[1] for name in list_folders(spark, path, f"{MONTH}=")]


def write_monthly(
    df: DataFrame, ts: str, path: str, mode: str = "append", sort_by: tuple[str, ...] = ("tenant_id",),
) -> None:
    """Write ``df`` into one folder per month of ``ts``.

    REBALANCE gathers a month into few files and splits a month that is too big for one
    task. Rows are sorted inside a file so that row-group statistics serve tenant lookups
    and partial aggregation meets a tenant's rows together. ``mode="overwrite"`` replaces
    only the months present in ``df``.
    """
    keyed = df.withColumn(MONTH, month_key(F.col(ts)))
    order = [c for c in (*sort_by, ts) if c in keyed.columns]
    (
        keyed.hint("rebalance", F.col(MONTH))
        .sortWithinPartitions(MONTH, *order)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(MONTH)
        .parquet(path)
    )


def read_monthly(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a month-partitioned table with its declared schema plus the ``month`` folder."""
    declared = T.StructType([f for f in schema.fields if f.name != MONTH])
    return spark.read.schema(declared.add(MONTH, T.StringType())).parquet(path)


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """The raw landing as a typed table: the seven payload fields, ``topic`` and ``event_date``.

    Both are folders; a filter on them leaves the other folders' files unread.
    """
    folders = [T.StructField(name, T.StringType()) for name in ("topic", "event_date")]
    schema = T.StructType([*EVENT_SCHEMA.fields, *folders])
    return spark.read.schema(schema).json(path) if path_exists(spark, path) else empty_frame(spark, schema)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    hadoop, fs = _path(spark, path)
    out = fs.create(hadoop, True)
    out.write(bytearray(text, "utf-8"))
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    hadoop, fs = _path(spark, path)
    stream = fs.open(hadoop)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_version(spark: SparkSession, root: str, version: str) -> None:
    """Point readers at ``root/version``. The pointer is replaced in one rename."""
    jvm = spark._jvm
    target, _ = _path(spark, f"{root}/{_POINTER}")
    write_text(spark, f"{root}/.{_POINTER}.{version}", version)
    draft = jvm.org.apache.hadoop.fs.Path(f"{root}/.{_POINTER}.{version}")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(context.makeQualified(draft), context.makeQualified(target), options)


def current_version(spark: SparkSession, root: str) -> str | None:
    """Path of the version readers should use, or None before the first one."""
    pointer = f"{root}/{_POINTER}"
    return f"{root}/{read_text(spark, pointer)}" if path_exists(spark, pointer) else None
