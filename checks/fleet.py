"""Telemetry snapshots derived from the given tables. ``checks.oracles`` states the same in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.fixtures import given


def _stamp(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    event, user = F.col("event_id"), F.col("user_id")
    return given(spark, sf_dir, "events").select(
        F.concat(F.lit("db-"), user % 4).alias("instance"), F.col("ts").cast("timestamp").alias("ts"),
        "event_id", "user_id", "event_type", F.round(F.col("value") * 100).cast("long").alias("cents"),
        F.date_trunc("week", F.col("ts").cast("timestamp")).alias("snapshot_ts"),
        F.when(event % 4 == 1, "idle").when(event % 4 == 2, "idle in transaction").otherwise("active").alias("state"),
    )


def statement_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    query = F.concat(F.lit("SELECT "), "event_type", F.lit(" "), F.col("event_id") % 20)
    grouped = _events(spark, sf_dir).groupBy("instance", "snapshot_ts", query.alias("query")).agg(
        F.count("*").alias("calls"), F.sum("cents").alias("cents"), F.max("cents").alias("top"),
    )
    mean = F.call_function("div", F.col("cents") * 100, F.col("calls"))
    return grouped.select(
        "instance", "snapshot_ts", "query", "calls", (F.col("cents") / 100).alias("total_exec_time"),
        (mean / 10000).alias("mean_exec_time"), (F.col("top") / 100).alias("max_exec_time"),
    )


def log_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(instance, entry): log entries of up to a dozen lines, with a tab before each further line of every second one."""
    e, n = _events(spark, sf_dir).where("event_id % 100 <> 8"), F.col("event_id")
    more = F.concat(F.lit("\n"), F.when(n % 2 == 0, "\t").otherwise(""), F.lit("AND n = "), n)
    again = F.when(n % 10 == 9, F.lit("\n\tduration: 9.0 ms of nothing")).when(n % 10 == 5, "").otherwise(F.repeat(more, (n % 12).cast("int")))
    return e.select("instance", F.concat(_log_line(), again).alias("entry"))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    unknown = F.when(F.col("event_id") % 100 == 8, F.lit("duration: unknown"))
    return _events(spark, sf_dir).select(F.coalesce(unknown, _log_line()).alias("line"))


def _log_line() -> Column:
    line = F.concat(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC ["), F.col("event_id"), F.lit("]: user=u"),
        F.col("user_id"), F.lit(",db=billing,app=api,client=10.0.1.4 LOG:  duration: "),
        F.call_function("div", F.col("cents"), F.lit(100)), F.lit("."),
        F.lpad((F.col("cents") % 100).cast("string"), 2, "0"), F.lit("0 ms"),
        F.when(F.col("event_id") % 10 == 5, "").when(F.col("event_id") % 10 == 7, "  execute q1: ").otherwise("  statement: "),
        F.when(F.col("event_id") % 10 == 5, "").otherwise(F.concat(F.lit("SELECT "), "event_type")),
    )
    noise = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC [1]: LOG:  checkpoint starting"))
    return F.when(F.col("event_id") % 10 == 9, noise).otherwise(line)


def table_io(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).groupBy(
        "instance", "snapshot_ts", F.concat(F.lit("t_"), F.col("event_id") % 12).alias("relname"),
    ).agg(F.sum("cents").alias("heap_blks_hit"), F.sum(F.col("event_id") % 500).alias("heap_blks_read"))


def table_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed, o = F.col("o_orderdate").cast("timestamp"), F.col("o_orderkey")
    name = F.when(o % 11 == 0, F.lit("tenants")).otherwise(
        F.concat(F.lit("invoices_"), F.date_format(placed, "yyyy_MM")),
    )
    return given(spark, sf_dir, "orders").groupBy(
        F.concat(F.lit("db-"), F.col("o_custkey") % 4).alias("instance"),
        _stamp("2024-01-28 00:00:00").alias("snapshot_ts"), name.alias("relname"),
    ).agg(
        F.count_if(F.col("o_orderstatus") != "P").alias("n_live_tup"),
        F.count_if((F.col("o_orderstatus") == "P") & (o % 3 == 0)).alias("n_dead_tup"),
        F.min(placed).alias("last_autovacuum"), F.max(placed).alias("last_vacuum"), F.lit("public").alias("schemaname"),
        F.sum(o % 7).alias("idx_scan"), F.sum(F.when(o % 5 == 0, 1).otherwise(0)).alias("seq_scan"),
    )


def index_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c_custkey")
    return given(spark, sf_dir, "customer").select(
        F.concat(F.lit("db-"), c % 4).alias("instance"), _stamp("2024-01-28 00:00:00").alias("snapshot_ts"),
        F.concat(F.lit("t_"), c % 12).alias("relname"), F.concat(F.lit("ix_"), c).alias("indexrelname"),
        (c % 3).alias("idx_scan"), (c * 8192).alias("index_bytes"),
    )


def replication(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c_custkey")
    return given(spark, sf_dir, "customer").select(
        F.concat(F.lit("db-"), c % 4).alias("instance"), _stamp("2024-01-28 00:00:00").alias("snapshot_ts"),
        F.concat(F.lit("standby_"), c).alias("application_name"),
        F.when(c % 17 == 0, "catchup").otherwise("streaming").alias("state"),
        F.when(c % 13 == 0, "async").otherwise("sync").alias("sync_state"),
        (c * 11 % 3000).alias("write_lag_ms"), (c * 23 % 5000).alias("flush_lag_ms"),
        F.when(c % 5 > 0, c * 37 % 8000).alias("replay_lag_ms"),
        (c * 1000 + 5000).alias("current_lsn"), (c * 1000 + c % 5000).alias("replay_lsn"),
    )


def slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c_custkey")
    return given(spark, sf_dir, "customer").select(
        F.concat(F.lit("db-"), c % 4).alias("instance"), _stamp("2024-01-28 00:00:00").alias("snapshot_ts"),
        F.concat(F.lit("slot_"), c).alias("slot_name"), (c % 6 > 0).alias("active"),
        (c * 1000 + 5000).alias("current_lsn"), (c * 1000 + c % 5001).alias("restart_lsn"),
    )


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select(
        "instance", _stamp("2024-02-01 00:00:00").alias("snapshot_ts"), F.col("event_id").alias("pid"),
        F.concat(F.lit("u"), F.col("user_id")).alias("usename"), F.lit("api").alias("application_name"), "state",
        F.col("ts").alias("state_change"), F.col("ts").alias("query_start"), F.col("event_type").alias("query"),
    )
