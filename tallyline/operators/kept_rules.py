"""Data rules of the large facts kept up to date: only folders that have changed are read again.

A fact lies in folders by month (or, for usage, by day). For each the outcome of the row rules is kept, the keys that repeat in it, and how often
it points to each row of other tables. What a folder had when it was read is remembered by its signature. Rules that span folders, references
above all, are put together from what is kept and from the tables as they are now.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.functions.months import MONTH
from tallyline.operators import rules, usage
from tallyline.sources.lake import (
    current_version, empty_frame, folder_signature, month_folders, publish_version, read_monthly, read_text, write_text,
)
from tallyline.sources.schema import MONTHLY, schema_of

#: The folder of rows without a time, as Spark names it.
_NO_MONTH = "__HIVE_DEFAULT_PARTITION__"
_KEPT = "folder string, rule string, target string, key array<string>, rows bigint"


def _state(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Signature of each folder as it was read, and the commit that has its outcome."""
    current = current_version(spark, path)
    return {} if current is None else json.loads(read_text(spark, current))


def _outcome(table: str, df: DataFrame, time: str) -> DataFrame:
    """What is kept of rows with their ``folder``: failing rows, repeated keys, keys of rules that span folders, references."""
    failed = F.array_compact(F.array(*[F.when(rules._fails(r.condition), F.lit(r.name)) for r in rules._of(rules.ROW_RULES, table)]))
    rows = df.select(
        "folder", F.explode(failed).alias("rule"), F.lit("").alias("target"), F.array(rules._key_text(rules.PRIMARY_KEYS[table])).alias("key"),
        F.lit(1).cast("bigint").alias("rows"))
    keys, references = rules._of(rules.KEY_RULES, table), rules._of(rules.REFERENCE_RULES, table)
    counted = df.select("folder", F.inline(rules._tuples(table, keys, references, False))).groupBy("folder", "rule", "_target", "_key").agg(
        F.count("*").alias("rows"))
    # A key that has the folder's time in it repeats in its folder or nowhere.
    inside = [r.name for r in keys if time in r.columns]
    sets = counted.where(~F.col("rule").isin(inside) | (F.col("rows") > 1)).select(
        "folder", "rule", F.col("_target").alias("target"), F.col("_key").alias("key"), "rows")
    return rows.unionByName(sets)


def _keep_up(
    spark: SparkSession, table: str, path: str, signatures: dict[str, str], read: Callable[[list[str]], DataFrame], time: str,
) -> list[str]:
    """Take changed folders again and publish; returns their names."""
    state = _state(spark, path)
    changed = sorted(f for f, mark in signatures.items() if state.get(f, [None])[0] != mark)
    if changed or state.keys() - signatures.keys():
        commit = uuid.uuid4().hex
        if changed:
            _outcome(table, read(changed), time).write.parquet(f"{path}/kept/commit={commit}")
        new = {f: [mark, commit if f in changed else state[f][1]] for f, mark in signatures.items()}
        write_text(spark, f"{path}/{commit}.json", json.dumps(new, sort_keys=True))
        publish_version(spark, path, f"{commit}.json")
    return changed


def refresh_months(spark: SparkSession, table: str, source: str, path: str, key_type: T.DataType | None = None) -> list[str]:
    """Keep up the outcome of ``table``, written by ``write_monthly`` at ``source``, at ``path``; returns the months read."""
    source, path, time = source.rstrip("/"), path.rstrip("/"), MONTHLY[table]
    marks = {m: folder_signature(spark, f"{source}/{MONTH}={m}") for m in month_folders(spark, source)}
    folder = F.coalesce(MONTH, F.lit(_NO_MONTH))
    read = lambda months: read_monthly(spark, source, schema_of(table, key_type)).where(folder.isin(months)).withColumn("folder", folder)
    return _keep_up(spark, table, path, marks, read, time)


def refresh_usage(spark: SparkSession, source: str, path: str, key_type: T.DataType | None = None) -> list[str]:
    """Keep up the outcome of the usage table at ``source``, whose manifest names what each day has; returns the days read."""
    source, schema = source.rstrip("/"), schema_of("api_usage_events", key_type)
    marks = usage.day_folders(spark, source)
    day = F.date_format("recorded_at", "yyyy-MM-dd").alias("folder")
    read = lambda days: usage.read_folders(spark, source, [marks[d] for d in days], schema).select("*", day)
    return _keep_up(spark, "api_usage_events", path.rstrip("/"), marks, read, "recorded_at")


def violations(spark: SparkSession, table: str, path: str, refs: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """What ``rules.validate`` says of the table as it was at the last refresh, references held against ``refs`` as they are now."""
    path, refs = path.rstrip("/"), refs or {}
    state = _state(spark, path)
    schema = T.StructType([*T._parse_datatype_string(_KEPT), T.StructField("commit", T.StringType())])
    commits = sorted({commit for _, commit in state.values()})
    kept = empty_frame(spark, schema) if not commits else spark.read.schema(schema).option("basePath", f"{path}/kept").parquet(
        *[f"{path}/kept/commit={c}" for c in commits])
    # One short row for each month or day: bounded by the calendar.
    current = spark.createDataFrame([(f, commit) for f, (_, commit) in state.items()], "folder string, commit string")
    kept = kept.join(F.broadcast(current), ["folder", "commit"], "left_semi")

    rows = kept.where("target = ''").select("rule", F.col("key")[0].alias("text"), "rows")
    sets = kept.where("target IS NULL OR target <> ''").groupBy("rule", "target", "key").agg(F.sum("rows").alias("rows"))
    parts = [rows, sets.where("target IS NULL AND rows > 1").select("rule", F.concat_ws("|", "key").alias("text"), "rows")]
    for target in sorted({r.target for r in rules._of(rules.REFERENCE_RULES, table) if r.target in refs}):
        known = refs[target].select(F.array(F.col("id").cast("string")).alias("key"))
        lost = sets.where(F.col("target") == target).join(known, "key", "left_anti")
        parts.append(lost.select("rule", F.concat_ws("|", "key").alias("text"), "rows"))
    return reduce(DataFrame.unionByName, parts).select(F.lit(table).alias("table_name"), "rule", F.col("text").alias("key"), "rows")
