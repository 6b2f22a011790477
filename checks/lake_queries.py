"""Registered queries that write to the lake or run a stream, and read the outcome back.

Every run works in new folders below the session's shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from checks import fleet
from tallyline import scratch_dir
from tallyline.functions.months import MONTH
from tallyline.operators import ledger, proration, reports, telemetry, usage
from tallyline.sources.lake import delete_path, month_folders, read_monthly, read_raw, write_monthly
from tallyline.sources.schema import MONTHLY, load, schema_of
from tallyline.streaming import (
    audit_stream, dedupe_events, land_raw, land_usage, meter_hourly_stream, parse_event, route,
    rejected, run_pipeline, status_changes_stream, to_event,
)
from tallyline.streaming.landing import land_batch
from tallyline.streaming.status import with_late_versions
from tallyline.streaming.status_table import land_status_changes, read_status_changes

Query = Callable[[SparkSession, str], DataFrame]

_USAGE = ("tenant_id", "recorded_at", "endpoint", "event_count")
#: Rows of the audit log in one of its files, at most but for chance.
_FILE_ROWS = 2_000_000


def _usage_schema():
    return schema_of("api_usage_events", fx.KEY)


def _upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A wrong count for every bucket, then the right ones for half of them, twice over."""
    path = f"{scratch_dir(spark, 'upsert')}/usage"
    buckets = fx.usage(spark, sf_dir)
    usage.upsert_usage(spark, path, buckets.withColumn("event_count", F.col("event_count") + 1), fx.KEY)
    for _ in range(2):
        usage.upsert_usage(spark, path, buckets.where(F.col("tenant_id") % 2 == 0), fx.KEY)
    usage.vacuum_usage(spark, path)
    return usage.read_usage(spark, path, fx.KEY).select(*_USAGE)


def _upsert_undated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of every seventh bucket the hour is unknown; the same rows come twice, then half of them with other counts."""
    path = f"{scratch_dir(spark, 'undated')}/usage"
    buckets = fx.usage(spark, sf_dir)
    spoilt = buckets.withColumns({
        "recorded_at": F.when(F.col("id") % 7 > 0, F.col("recorded_at")), "endpoint": F.concat("endpoint", F.lit("#"), F.col("id").cast("string"))})
    for _ in range(2):
        usage.upsert_usage(spark, path, spoilt, fx.KEY)
    usage.upsert_usage(spark, path, spoilt.where("id % 2 = 0").withColumn("event_count", F.col("event_count") + 1), fx.KEY)
    usage.vacuum_usage(spark, path)
    parts = {"table": usage.read_usage(spark, path, fx.KEY), "undated": usage.undated_usage(spark, path, fx.KEY)}
    return reduce(DataFrame.unionByName, [df.select(F.lit(place).alias("place"), *_USAGE) for place, df in parts.items()])


def _refresh_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rollup kept up while usage comes in three waves, a cycle moves and a tenant goes; the last version is what readers see."""
    root = scratch_dir(spark, "increments")
    path, table = f"{root}/usage_by_cycle", f"{root}/usage"
    buckets, tenants, subs = fx.usage(spark, sf_dir), fx.tenants(spark, sf_dir), fx.subscriptions(spark, sf_dir)
    moved = subs.withColumn("current_period_start", F.when(F.col("id") % 5 == 0, F.expr("current_period_start - INTERVAL 9 DAYS"))
                            .otherwise(F.col("current_period_start")))
    waves = [
        (buckets.where("tenant_id % 3 > 0").withColumn("event_count", F.col("event_count") * 3), tenants.withColumn("deleted_at", F.lit(None).cast("timestamp")), moved),
        (buckets.where("tenant_id % 3 = 0 AND day(recorded_at) <= 15"), tenants, moved),
        (buckets.where("tenant_id % 3 > 0 OR day(recorded_at) > 15"), tenants, subs),
    ]
    for version, (rows, owners, cycles) in enumerate(waves):
        usage.upsert_usage(spark, table, rows, fx.KEY)
        usage.refresh_from_usage(spark, table, path, f"v{version}", owners, cycles, fx.plans(spark), as_of=fx.AS_OF, key_type=fx.KEY)
        usage.vacuum_usage(spark, table, rollups=[path])
    return usage.read_usage_by_cycle(spark, path)


def _refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two refreshes of the rollup; readers see the second."""
    path = f"{scratch_dir(spark, 'rollup')}/usage_by_cycle"
    rollup = reports.usage_by_cycle(
        fx.usage(spark, sf_dir), fx.tenants(spark, sf_dir), fx.subscriptions(spark, sf_dir), fx.plans(spark),
        as_of=fx.AS_OF,
    )
    usage.refresh_usage_by_cycle(spark, rollup.where(F.col("api_limit").isNull()), path, "v1")
    usage.refresh_usage_by_cycle(spark, rollup, path, "v2")
    return usage.read_usage_by_cycle(spark, path)


def _pruned_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rollup over usage stored by month, whose folders the cycles prune."""
    path = f"{scratch_dir(spark, 'cycles')}/usage"
    write_monthly(fx.usage(spark, sf_dir), "recorded_at", path)
    return reports.usage_by_cycle(
        read_monthly(spark, path, _usage_schema()), fx.tenants(spark, sf_dir), fx.subscriptions(spark, sf_dir),
        fx.plans(spark), as_of=fx.AS_OF,
    )


def _loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All eight tables written and loaded again with their declared schemas."""
    root = scratch_dir(spark, "tables")
    for table, df in fx.tables(spark, sf_dir).items():
        if table in MONTHLY:
            write_monthly(df, MONTHLY[table], f"{root}/{table}")
        else:
            df.write.parquet(f"{root}/{table}")
    day = lambda c: F.coalesce(F.date_format(c, "yyyy-MM-dd"), F.lit("-"))
    shown = {
        "tenants": ["id", "name", "slug"],
        "plans": ["id", "name", "price_cents", F.coalesce(F.col("api_limit").cast("string"), F.lit("-"))],
        "users": ["id", "tenant_id", "email", "role"],
        "subscriptions": ["id", "tenant_id", "plan_id", "status", day("current_period_end"), day("cancelled_at")],
        "invoices": ["id", "tenant_id", "subscription_id", "amount_cents", "status", day("due_date"), day("paid_at"), day("created_at")],
        "api_usage_events": ["tenant_id", F.date_format("recorded_at", "yyyy-MM-dd HH"), "endpoint", "event_count"],
        "billing_audit_log": ["id", "table_name", "row_id", "old_status", "new_status", day("changed_at")],
        "plan_change_events": ["tenant_id", "subscription_id", "credit_cents", "charge_cents"],
    }
    loaded = load(spark, root, fx.KEY)
    return reduce(DataFrame.unionByName, [
        df.select(F.lit(table).alias("table_name"), F.concat_ws("|", *shown[table]).alias("content")) for table, df in loaded.items()
    ])


def _monthly_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month folders written, then a pruned range of them."""
    path = f"{scratch_dir(spark, 'monthly')}/invoices"
    write_monthly(fx.invoices(spark, sf_dir), "created_at", path)
    stored = read_monthly(spark, path, schema_of("invoices", fx.KEY))
    return ledger.ledger_between(stored, "1996-02-10", "1996-05-01").select("id", "amount_cents", "created_at", MONTH)


def _recovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger declared for 1996..1998; two months of the quarantine moved back, one of them twice."""
    root = scratch_dir(spark, "recover")
    schema = schema_of("invoices", fx.KEY)
    path, quarantine = f"{root}/invoices", f"{root}/invoices_default"
    ledger.write_declared(fx.invoices(spark, sf_dir), "created_at", path, quarantine, "1996-01", "1998-12")
    for month in ("1999-01", "1999-02", "1999-01"):
        ledger.recover_default(spark, path, quarantine, month, "created_at", schema)
    stored = read_monthly(spark, path, schema).select("id", MONTH, F.lit("ledger").alias("place"))
    waiting = read_monthly(spark, quarantine, schema).select("id", MONTH, F.lit("quarantine").alias("place"))
    return stored.unionByName(waiting)


def _migrated(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_dir(spark, 'migrate')}/invoices"
    return ledger.migrate_to_monthly(
        spark, fx.invoices(spark, sf_dir), path, "created_at", "amount_cents", schema_of("invoices", fx.KEY),
    )


def _archived(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "archive")
    write_monthly(fx.invoices(spark, sf_dir), "created_at", f"{root}/invoices")
    return ledger.archive_months(
        spark, f"{root}/invoices", f"{root}/archive", "1997-01-01", "created_at", "amount_cents",
        schema_of("invoices", fx.KEY),
    )


def _recorded_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every priced change recorded, and recorded again."""
    path = f"{scratch_dir(spark, 'changes')}/plan_change_events"
    ok = proration.prorate(fx.plan_changes(spark, sf_dir), fx.plans(spark)).ok
    for _ in range(2):
        proration.write_plan_changes(spark, ok, path, fx.KEY)
    events = read_monthly(spark, path, schema_of("plan_change_events", fx.KEY))
    return events.select("tenant_id", "subscription_id", "days_remaining", "credit_cents", "charge_cents", "net_cents")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_event(route(fx.audit_log(spark, sf_dir)))


def _route_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = fx.audit_log(spark, sf_dir)
    other = log.where(F.col("id") % 10 == 3).withColumn("table_name", F.lit("users"))
    return route(log.unionByName(other)).select("id", "table_name", "topic")


def _pipeline(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """Two runs: part of the log, then all of it again, so that most events arrive twice."""
    root = scratch_dir(spark, "pipeline")
    log = fx.audit_log(spark, sf_dir)
    summary = None
    for wave in (log.where(F.col("id") % 3 > 0), log):
        wave.write.mode("append").parquet(f"{root}/log")
        summary = run_pipeline(
            spark, f"{root}/log", f"{root}/raw", f"{root}/checkpoint", fx.KEY, seconds=None, max_files=16,
        )
    return summary, f"{root}/raw"


def _in_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs without any time beyond their first batch, until one has caught up."""
    root, entries = scratch_dir(spark, "slices"), fx.audit_log(spark, sf_dir)
    entries.repartition(max(4, -(-entries.count() // _FILE_ROWS))).write.parquet(f"{root}/log")
    while True:
        summary = run_pipeline(spark, f"{root}/log", f"{root}/raw", f"{root}/checkpoint", fx.KEY, seconds=0, max_files=2)
        if summary.first()["caught_up"]:
            return read_raw(spark, f"{root}/raw")


def _with_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of which three in seven are spoilt, landed twice; every one is accounted for."""
    path = f"{scratch_dir(spark, 'rejects')}/raw"
    k = F.col("key").cast("long") % 7
    value = (
        F.when(k == 0, F.lit('{"audit_log_id": ')).when(k == 1, F.regexp_replace("value", '"changed_at":"[^"]*"', '"changed_at":"soon"'))
        .when(k == 2, F.regexp_replace("value", '"audit_log_id":"[^"]*"', '"audit_log_id":null')).otherwise(F.col("value"))
    )
    events = _events(spark, sf_dir).withColumn("value", value)
    for _ in range(2):
        land_batch(events, path, "7")
    landed = read_raw(spark, path).select("topic", F.col("audit_log_id").alias("key"), F.lit("landed").alias("outcome"))
    return landed.unionByName(rejected(spark, path).select("topic", "key", F.col("reason").alias("outcome")))


def _rejects_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spoilt events in one batch, then in two overlapping ones of another stream that numbers its batches alike."""
    path = f"{scratch_dir(spark, 'rejects')}/raw"
    events = _events(spark, sf_dir).withColumn("value", F.when(F.col("key").cast("long") % 3 == 0, F.lit("{")).otherwise(F.col("value")))
    for batch, part in (("0", "TRUE"), ("0", "CAST(key AS LONG) % 2 = 0"), ("1", "CAST(key AS LONG) % 2 = 1 OR CAST(key AS LONG) % 5 = 0")):
        land_batch(events.where(part), path, batch)
    return rejected(spark, path)


def _deduped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log twice in one stream; the watermark spans its whole time range."""
    root = scratch_dir(spark, "dedupe")
    log = fx.audit_log(spark, sf_dir)
    log.unionByName(log).write.parquet(f"{root}/log")
    events = dedupe_events(to_event(route(audit_stream(spark, f"{root}/log", fx.KEY))), delay="20000 days")
    query = (
        events.drop("changed_at").writeStream.format("parquet").option("path", f"{root}/events")
        .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema("topic string, key string, value string").parquet(f"{root}/events")


def _landed_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same stream landed under two checkpoints, as after a lost one: nothing doubles."""
    root = scratch_dir(spark, "replay")
    fx.audit_log(spark, sf_dir).write.parquet(f"{root}/log")
    for run in range(2):
        events = to_event(route(audit_stream(spark, f"{root}/log", fx.KEY)))
        land_raw(events, f"{root}/raw", f"{root}/checkpoint-{run}").awaitTermination()
    return read_raw(spark, f"{root}/raw").groupBy("topic", "event_date").agg(F.count("*").alias("events"))


def _metered(spark: SparkSession, sf_dir: str) -> str:
    """The usage table after a stream of all requests: hours it has closed."""
    root = scratch_dir(spark, "metering")
    fx.requests(spark, sf_dir).write.parquet(f"{root}/requests")
    requests = spark.readStream.schema("tenant_id long, requested_at timestamp, url string").parquet(f"{root}/requests")
    land_usage(meter_hourly_stream(requests), f"{root}/usage", f"{root}/checkpoint").awaitTermination()
    return f"{root}/usage"


def _metered_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usage.read_usage(spark, _metered(spark, sf_dir), fx.KEY).select(*_USAGE)


def _completed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After the stream, the hours from the newest closed one on are metered again from the requests."""
    path = _metered(spark, sf_dir)
    newest = usage.read_usage(spark, path, fx.KEY).agg(F.max("recorded_at")).first()[0]
    usage.remeter(spark, path, fx.requests(spark, sf_dir), newest, key_type=fx.KEY)
    return usage.read_usage(spark, path, fx.KEY).select(*_USAGE)


def _landed_steps(spark: SparkSession, feed: DataFrame, *waves: str) -> DataFrame:
    root, steps = scratch_dir(spark, "status"), None
    for wave in map(feed.where, waves):
        wave.write.mode("append").parquet(f"{root}/feed")
        versions = spark.readStream.schema(feed.schema).parquet(f"{root}/feed")
        steps = status_changes_stream(versions)
        query = (
            steps.writeStream.format("parquet").option("path", f"{root}/steps")
            .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
        )
        query.awaitTermination()
    return spark.read.schema(steps.schema).parquet(f"{root}/steps")


def _status_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row versions in two waves, so that steps cross the boundary between runs."""
    feed = fx.version_feed(spark, sf_dir).drop("app_user")
    return _landed_steps(spark, feed, "version_no < 2", "version_no = 2").where("NOT late").drop("late")


def _late_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest versions of a third of the rows arrive first; their steps are taken again."""
    feed = fx.version_feed(spark, sf_dir).drop("app_user")
    steps = _landed_steps(spark, feed, "version_no < 2 AND row_id % 3 > 0 OR version_no = 2 AND row_id % 3 = 0",
                          "version_no < 2 AND row_id % 3 = 0 OR version_no = 2 AND row_id % 3 > 0")
    return with_late_versions(steps, feed)


def _status_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions in three waves: the newest of a third of the rows come first, and the second wave once more under another checkpoint."""
    root, feed = scratch_dir(spark, "status-table"), fx.version_feed(spark, sf_dir).drop("app_user")
    late = "row_id % 3 = 0"
    for run, wave in enumerate([f"version_no = 2 AND {late} OR version_no = 0 AND NOT {late}", f"version_no = 1 OR version_no = 0 AND {late}", f"version_no = 2 AND NOT {late}"]):
        feed.where(wave).write.parquet(f"{root}/feed-{run}")
        for checkpoint in ("a", "b")[: 2 if run == 1 else 1]:
            versions = spark.readStream.schema(feed.schema).parquet(f"{root}/feed-{run}")
            land_status_changes(versions, f"{root}/steps", f"{root}/checkpoint-{run}{checkpoint}").awaitTermination()
    return read_status_changes(spark, f"{root}/steps", fx.KEY)


def _late_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive, retire what may be, let more rows of the same months arrive, archive again."""
    root, rows = scratch_dir(spark, "late"), fx.invoices(spark, sf_dir)
    path, archive, schema = f"{root}/invoices", f"{root}/archive", schema_of("invoices", fx.KEY)
    for wave in ("id % 6 <> 1", "id % 6 = 1"):
        write_monthly(rows.where(wave), "created_at", path)
        report = ledger.archive_months(spark, path, archive, "1997-01-01", "created_at", "amount_cents", schema)
        for month in [r["month"] for r in report.where("removable").select("month").collect()]:
            delete_path(spark, f"{path}/{MONTH}={month}")
    return read_monthly(spark, archive, schema).select("id", "amount_cents", MONTH)


def _nameless_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth row has no id, some stand twice; archived, retired, more rows of the same months come, archived again, and again."""
    root, schema = scratch_dir(spark, "nameless"), schema_of("invoices", fx.KEY)
    path, archive = f"{root}/invoices", f"{root}/archive"
    rows = fx.invoices(spark, sf_dir).withColumn("n", F.when(F.col("id") % 15 == 0, 2).otherwise(1))
    rows = rows.select("id", F.when(F.col("id") % 5 > 0, F.col("id")).alias("named"), *[c for c in rows.columns if c not in ("id", "n")],
                       F.explode(F.array_repeat(F.lit(1), F.col("n"))).alias("once"))
    for wave in ("id % 6 <> 1", "id % 6 = 1", "FALSE"):
        part = rows.where(wave).select(F.col("named").alias("id"), *[c for c in rows.columns if c not in ("id", "named", "once")])
        write_monthly(part, "created_at", path)
        report = ledger.archive_months(spark, path, archive, "1997-01-01", "created_at", "amount_cents", schema)
        if wave == "id % 6 <> 1":
            for month in [r["month"] for r in report.where("removable").select("month").collect()]:
                delete_path(spark, f"{path}/{MONTH}={month}")
    return read_monthly(spark, archive, schema).select("id", "tenant_id", "amount_cents", MONTH)


def _swapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months of which two rows have changed their amounts: counts and totals agree, the rows do not."""
    rows = fx.invoices(spark, sf_dir)
    pairs = rows.groupBy(F.date_format("created_at", "yyyy-MM").alias("m")).agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a % 2 = 0 AND a < b")
    ends = pairs.join(rows.select(F.col("id").alias("a"), F.col("amount_cents").alias("of_a")), "a").join(
        rows.select(F.col("id").alias("b"), F.col("amount_cents").alias("of_b")), "b")
    changes = ends.select(F.explode(F.array(F.struct(F.col("a").alias("id"), F.col("of_b").alias("new")), F.struct(F.col("b").alias("id"), F.col("of_a").alias("new")))).alias("c")).select("c.*")
    swapped = rows.join(changes, "id", "left").withColumn("amount_cents", F.coalesce("new", "amount_cents")).select(*rows.columns)
    return ledger.reconcile(rows, swapped, "created_at", "amount_cents")


def _slow_log_over_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of several lines in log files that are read in splits of 64 KB, so that many entries lie across two."""
    root, key = scratch_dir(spark, "logs"), "spark.sql.files.maxPartitionBytes"
    # Files of an instance are as many as its entries need; a task writes one, of bounded size.
    fleet.log_entries(spark, sf_dir).hint("rebalance", F.col("instance")).write.partitionBy("instance").text(root)
    usual = spark.conf.get(key)
    spark.conf.set(key, "64k")
    try:
        return telemetry.parse_slow_log(telemetry.read_log_entries(spark, root))
    finally:
        spark.conf.set(key, usual)


def _conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month waits in the quarantine; of every fifth row the table has it, and the quarantine holds another amount.

    All other months stand in both places. What recovery has changed of them comes out as well: no row, if it is right.
    """
    root, schema = scratch_dir(spark, "conflicts"), schema_of("invoices", fx.KEY)
    path, quarantine = f"{root}/invoices", f"{root}/invoices_default"
    rows = fx.invoices(spark, sf_dir)
    at_hand = F.coalesce(F.date_format("created_at", "yyyy-MM") == "1996-03", F.lit(False))
    waiting = rows.withColumn("amount_cents", F.col("amount_cents") + F.when(F.col("id") % 5 == 0, 1).otherwise(0))
    write_monthly(rows.where(~at_hand | (F.col("id") % 5 == 0)), "created_at", path)
    write_monthly(waiting, "created_at", quarantine)
    for _ in range(2):
        ledger.recover_default(spark, path, quarantine, "1996-03", "created_at", schema)
    parts = []
    for p, place, before in [(path, "ledger", rows), (quarantine, "quarantine", waiting)]:
        held, before = read_monthly(spark, p, schema).select(*rows.columns), before.where(~at_hand)
        others = held.where(~at_hand)
        for df in (held.where(at_hand), others.exceptAll(before), before.exceptAll(others)):
            parts.append(df.select("id", "amount_cents", F.lit(place).alias("place")))
    return reduce(DataFrame.unionByName, parts)


def _month_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges over month folders: an end with an offset and a day without zeros, one whole month, the undeclared months."""
    path = f"{scratch_dir(spark, 'ranges')}/invoices"
    write_monthly(fx.invoices(spark, sf_dir), "created_at", path)
    stored = read_monthly(spark, path, schema_of("invoices", fx.KEY))
    found = {
        "offset end": ledger.ledger_between(stored, "1997-1-5", "1997-01-31T23:00:00-05:00"),
        "one month": ledger.ledger_between(stored, "1996-01-01", "1996-02-01"),
        "outside": ledger.out_of_range_rows(stored, "created_at", "1993-01", "1997-12"),
    }
    return reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("range"), "id", MONTH) for name, df in found.items()])


def _stored_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage from a listing of folders."""
    path = f"{scratch_dir(spark, 'coverage')}/invoices"
    write_monthly(fx.invoices(spark, sf_dir), "created_at", path)
    stored = read_monthly(spark, path, schema_of("invoices", fx.KEY))
    return ledger.missing_months({"invoices": (stored, "created_at")}, as_of=fx.AS_OF, since="1990-01",
                                 stored={"invoices": month_folders(spark, path)})


LAKE: dict[str, Query] = {
    "load_tables": _loaded,
    "usage_by_cycle_months": _pruned_cycles,
    "upsert_usage": _upsert,
    "upsert_usage_undated": _upsert_undated,
    "refresh_usage_by_cycle": _refresh,
    "refresh_from_usage": _refresh_changed,
    "ledger_between_months": _monthly_read,
    "recover_default": _recovered,
    "migrate_to_monthly": _migrated,
    "archive_months": _archived,
    "write_plan_changes": _recorded_changes,
    "route_events": _route_events,
    "to_event": lambda spark, sf_dir: _events(spark, sf_dir).select("topic", "key", "value"),
    "parse_event": lambda spark, sf_dir: parse_event(_events(spark, sf_dir)).drop("key", "value", "reason"),
    "land_raw": lambda spark, sf_dir: read_raw(spark, _pipeline(spark, sf_dir)[1]),
    "verify_landing": lambda spark, sf_dir: _pipeline(spark, sf_dir)[0],
    "land_raw_replayed": _landed_twice,
    "dedupe_events": _deduped,
    "meter_hourly_stream": _metered_stream,
    "status_changes_stream": _status_stream,
    "pipeline_in_slices": _in_slices,
    "land_raw_rejects": _with_rejects,
    "land_raw_rejects_replayed": _rejects_replayed,
    "parse_slow_log_over_lines": _slow_log_over_lines,
    "archive_late_rows": _late_archive,
    "archive_null_ids": _nameless_archive,
    "reconcile_swapped": _swapped,
    "recover_default_conflicts": _conflicts,
    "ranges_by_month": _month_ranges,
    "missing_months_stored": _stored_coverage,
    "meter_stream_completed": _completed_stream,
    "status_changes_late": _late_versions,
    "status_changes_table": _status_table,
}
