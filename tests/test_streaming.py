"""The event pipeline, run and run again; streams across restarts."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyline import scratch_dir
from tallyline.sources.lake import read_raw
from tallyline.operators.audit import status_changes_from_feed
from tallyline.streaming import landing
from tallyline.streaming import (
    audit_stream, dedupe_events, land_batch, land_raw, meter_hourly_stream, parse_event, rejected, route, run_pipeline,
    status_changes_stream, to_event, verify_landing,
)
from tallyline.sources.lake import write_text
from tallyline.streaming.status import with_late_versions
from tests.seed import frame, seed_tables


@pytest.fixture(scope="module")
def log(spark):
    return seed_tables(spark).billing_audit_log


def landed(spark, path):
    return sorted((r["topic"], r["event_date"], r["audit_log_id"]) for r in read_raw(spark, path).collect())


SEED_LANDING = [
    ("billing.invoice.created", "2025-05-21", "a4"), ("billing.invoice.created", "2025-09-12", "a5"),
    ("billing.subscription.changed", "2024-09-27", "a3"), ("billing.subscription.changed", "2025-05-21", "a1"),
    ("billing.subscription.changed", "2025-08-19", "a2"),
]


def test_routing_drops_other_tables(spark, log):
    other = frame(spark, "billing_audit_log", [("a9", "users", "u1", "system", "x", "y", "2025-01-01 00:00:00")])
    topics = {r["id"]: r["topic"] for r in route(log.union(other)).collect()}
    assert topics == {audit_id: topic for topic, _, audit_id in SEED_LANDING}


def test_payload(spark):
    rows = frame(spark, "billing_audit_log", [
        ("a1", "invoices", "i1", 'o"brien', "open", "paid", "2025-01-01 10:00:00"),
        ("a2", "invoices", "i2", None, "open", "paid", "2025-01-01 10:00:00.123400"),
    ])
    events = {r["key"]: json.loads(r["value"]) for r in to_event(route(rows)).collect()}
    assert events["a1"] == {
        "audit_log_id": "a1", "table_name": "invoices", "row_id": "i1", "old_status": "open", "new_status": "paid",
        "changed_at": "2025-01-01T10:00:00+00:00", "changed_by": 'o"brien',
    }
    assert events["a2"]["changed_at"] == "2025-01-01T10:00:00.123400+00:00" and events["a2"]["changed_by"] is None


def test_pipeline_runs_again_without_landing_twice(spark, log):
    root = scratch_dir(spark, "test")
    log.write.parquet(f"{root}/log")
    for _ in range(2):
        summary = run_pipeline(spark, f"{root}/log", f"{root}/raw", f"{root}/checkpoint").first()
        assert summary["caught_up"] and summary["events"] == 5 and summary["newest_changed_at"] == "2025-09-12T18:00:00+00:00"
        assert landed(spark, f"{root}/raw") == SEED_LANDING

    # The same rows again, plus one of the last instant that committed late.
    late = frame(spark, "billing_audit_log", [("a6", "invoices", "i7", "system", "open", "paid", "2025-09-12 18:00:00")])
    log.union(late).write.mode("append").parquet(f"{root}/log")
    run_pipeline(spark, f"{root}/log", f"{root}/raw", f"{root}/checkpoint")
    assert landed(spark, f"{root}/raw") == sorted([*SEED_LANDING, ("billing.invoice.created", "2025-09-12", "a6")])


def test_a_lost_checkpoint_lands_nothing_twice(spark, log):
    root = scratch_dir(spark, "test")
    log.write.parquet(f"{root}/log")
    for run in range(2):
        events = to_event(route(audit_stream(spark, f"{root}/log")))
        land_raw(events, f"{root}/raw", f"{root}/checkpoint{run}").awaitTermination()
    assert landed(spark, f"{root}/raw") == SEED_LANDING


def test_a_backlog_is_landed_in_runs_that_end_between_batches(spark, log):
    root = scratch_dir(spark, "test")
    log.repartition(5).write.parquet(f"{root}/log")
    summaries = []
    while not summaries or not summaries[-1]["caught_up"]:
        summaries.append(run_pipeline(spark, f"{root}/log", f"{root}/raw", f"{root}/checkpoint", seconds=0, max_files=1).first())
        assert len(summaries) < 12
    assert len(summaries) > 1 and summaries[0]["events"] < 5 and not summaries[0]["caught_up"]
    assert landed(spark, f"{root}/raw") == SEED_LANDING


def test_bad_events_are_set_aside_and_stop_nothing(spark):
    path = f"{scratch_dir(spark, 'test')}/raw"
    values = ['{"audit_log_id":"1","changed_at":"2025-01-01T00"}', "{broken", '{"audit_log_id":"2"}', '{"changed_at":"2025-01-01T00"}',
              '{"audit_log_id":"3","changed_at":"2025-13-01T00"}', None]
    events = spark.createDataFrame([("billing.invoice.created", str(k), v) for k, v in enumerate(values)], "topic string, key string, value string")
    for _ in range(2):
        land_batch(events, path, "0")
    assert landed(spark, path) == [("billing.invoice.created", "2025-01-01", "1")]
    reasons = sorted((r["key"], r["reason"]) for r in rejected(spark, path).collect())
    assert reasons == [("1", "unreadable"), ("2", "no date"), ("3", "no id"), ("4", "no date"), ("5", "unreadable")]


def test_a_run_that_died_between_events_and_index_lands_nothing_twice(spark):
    path = f"{scratch_dir(spark, 'test')}/raw"
    value = '{"audit_log_id":"1","changed_at":"2025-01-01T00"}'
    events = spark.createDataFrame([("billing.invoice.created", "1", value)], "topic string, key string, value string")
    land_batch(events, path)
    spark.createDataFrame([], "topic string, event_date string, audit_log_id string, event_month string").write.mode("overwrite").parquet(f"{path}.ids")
    write_text(spark, f"{path}.ids.pending", "")
    land_batch(events, path)
    assert read_raw(spark, path).count() == 1


def audit_event(number, day="2025-01-01", topic="billing.invoice.created"):
    return (topic, str(number), f'{{"audit_log_id":"{number}","changed_at":"{day}T0{number % 10}"}}')


def test_every_rejected_event_is_kept_once_whatever_brings_it(spark):
    path, schema = f"{scratch_dir(spark, 'test')}/raw", "topic string, key string, value string"
    bad = [("t", "1", "{"), ("t", "2", "{"), ("u", "1", "{"), ("t", None, "{"), (None, "t", "{"), ("t", "3", None), (None, None, None)]
    batches = [("0", bad[:3]), ("0", bad[2:5]), ("1", bad), ("1", [*bad, bad[0], bad[0]]), ("7", [audit_event(1)])]
    for name, rows in batches:
        land_batch(spark.createDataFrame(rows, schema), path, name)
    found = rejected(spark, path).collect()
    assert sorted((tuple(r)[:3] for r in found), key=str) == sorted(bad, key=str)
    assert {r["batch"] for r in found if r["key"] in ("1", "2")} == {"0"} and {r["reason"] for r in found} == {"unreadable"}
    assert read_raw(spark, path).count() == 1


def test_two_streams_with_checkpoints_of_their_own_keep_all_rejects(spark):
    root, schema = scratch_dir(spark, "test"), "topic string, key string, value string"
    for name, rows in (("a", [("t", "1", "x"), audit_event(1)]), ("b", [("t", "2", "y"), audit_event(2)])):
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}")
        for checkpoint in ("first", "lost"):
            land_raw(spark.readStream.schema(schema).parquet(f"{root}/{name}"), f"{root}/raw", f"{root}/{name}-{checkpoint}").awaitTermination()
    assert sorted(r["key"] for r in rejected(spark, f"{root}/raw").collect()) == ["1", "2"]
    assert read_raw(spark, f"{root}/raw").count() == 2


def test_a_batch_looks_up_its_own_days_and_ids(spark):
    path, schema = f"{scratch_dir(spark, 'test')}/raw", "topic string, key string, value string"
    for day in ("2025-01-01", "2025-01-02", "2025-02-01"):
        land_batch(spark.createDataFrame([audit_event(100 + k, day) for k in range(5)], schema), path)
    good = parse_event(spark.createDataFrame([audit_event(103, "2025-01-02"), audit_event(200, "2025-01-02")], schema))
    known = landing._known(good, path)
    scan = known._jdf.queryExecution().executedPlan().toString()
    assert "event_month" in scan.split("PartitionFilters: [")[1].split("]")[0]
    assert "EqualTo(event_date,2025-01-02), GreaterThanOrEqu" in scan.split("PushedFilters: [")[1]
    assert sorted(r["audit_log_id"] for r in known.collect()) == ["103", "104"]


def test_the_check_of_a_landing_reads_no_events(spark):
    path, schema = f"{scratch_dir(spark, 'test')}/raw", "topic string, key string, value string"
    for number, day in ((1, "2025-01-01"), (2, "2025-01-01"), (2, "2025-01-01"), (3, "2025-02-01")):
        land_batch(spark.createDataFrame([audit_event(number, day)], schema), path)
    summary = verify_landing(spark, path)
    assert tuple(summary.first()) == (3, "2025-02-01T03")
    assert all(".days/" in f for f in summary.inputFiles())
    assert tuple(verify_landing(spark, path, "2025-01-02").first()) == (1, "2025-02-01T03")
    # While a run is between events and index, or has died there, the events themselves are counted.
    write_text(spark, f"{path}.ids.pending", "")
    assert tuple(verify_landing(spark, path).first()) == (3, "2025-02-01T03")
    land_batch(spark.createDataFrame([audit_event(1), audit_event(4)], schema), path)
    assert tuple(verify_landing(spark, path).first()) == (4, "2025-02-01T03") and read_raw(spark, path).count() == 4


def test_late_versions_are_set_aside_and_their_rows_taken_again(spark):
    root, start = scratch_dir(spark, "test"), datetime(2025, 1, 1)
    schema = "table_name string, row_id string, status string, version_at timestamp, version_no int"
    for wave in ([("open", 0), ("void", 4)], [("paid", 2)]):
        rows = [("invoices", "i1", status, start + timedelta(days=n), n) for status, n in wave]
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{root}/feed")
        steps = status_changes_stream(spark.readStream.schema(schema).parquet(f"{root}/feed"))
        steps.writeStream.format("parquet").option("path", f"{root}/out").option(
            "checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    out = spark.read.schema(steps.schema).parquet(f"{root}/out")
    assert sorted((r["late"], r["old_status"], r["new_status"]) for r in out.collect()) == [(False, "open", "void"), (True, None, "paid")]
    whole = with_late_versions(out, spark.read.schema(schema).parquet(f"{root}/feed")).collect()
    assert sorted((r["changed_at"].day, r["old_status"], r["new_status"]) for r in whole) == [(3, "open", "paid"), (5, "paid", "void")]


def test_a_crowded_day_is_kept_whole(spark):
    path = f"{scratch_dir(spark, 'test')}/raw"
    crowd = spark.range(400).select(
        F.lit("billing.invoice.created").alias("topic"), F.col("id").cast("string").alias("key"),
        F.format_string(
            '{"audit_log_id":"%d","changed_at":"2025-01-%s"}', "id", F.when(F.col("id") < 380, "01T00").otherwise("02T00"),
        ).alias("value"),
    )
    land_batch(crowd, path)
    land_batch(crowd, path)
    per_day = {r["event_date"]: r["count"] for r in read_raw(spark, path).groupBy("event_date").count().collect()}
    assert per_day == {"2025-01-01": 380, "2025-01-02": 20}


def test_an_empty_landing_warns_and_does_not_fail(spark, caplog):
    summary = verify_landing(spark, f"{scratch_dir(spark, 'test')}/nothing").first()
    assert summary["events"] == 0 and summary["newest_changed_at"] is None
    assert "no events" in caplog.text


def test_dedupe_within_the_watermark(spark, log):
    root = scratch_dir(spark, "test")
    log.union(log).write.parquet(f"{root}/log")
    events = dedupe_events(to_event(route(audit_stream(spark, f"{root}/log"))), "1000 days")
    query = (
        events.select("key").writeStream.format("parquet").option("path", f"{root}/out")
        .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert sorted(r["key"] for r in spark.read.parquet(f"{root}/out").collect()) == ["a1", "a2", "a3", "a4", "a5"]


def test_status_steps_cross_restarts(spark):
    root, start = scratch_dir(spark, "test"), datetime(2025, 1, 1)
    schema = "table_name string, row_id string, status string, version_at timestamp, version_no int"
    waves = [
        [("i1", "draft", 0), ("i1", "open", 1), ("i2", "open", 0), ("i3", None, 0)],
        [("i1", "open", 2), ("i2", "paid", 1), ("i3", None, 1), ("i4", "open", 0)],
        [("i1", "void", 3), ("i3", "open", 2)],
    ]
    for wave in waves:
        rows = [("invoices", row, status, start + timedelta(days=n), n) for row, status, n in wave]
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{root}/feed")
        query = (
            status_changes_stream(spark.readStream.schema(schema).parquet(f"{root}/feed"))
            .writeStream.format("parquet").option("path", f"{root}/out")
            .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
        )
        query.awaitTermination()
    steps = {(r["row_id"], r["old_status"], r["new_status"], r["changed_at"].day) for r in spark.read.parquet(f"{root}/out").collect()}
    assert steps == {("i1", "draft", "open", 2), ("i2", "open", "paid", 2), ("i1", "open", "void", 4), ("i3", None, "open", 3)}


def test_metering_emits_closed_hours(spark):
    root, start = scratch_dir(spark, "test"), datetime(2025, 1, 1)
    rows = [("t1", start + timedelta(minutes=m), "/a?x") for m in (0, 59, 60, 200)]
    spark.createDataFrame(rows, "tenant_id string, requested_at timestamp, url string").write.parquet(f"{root}/in")
    stream = spark.readStream.schema("tenant_id string, requested_at timestamp, url string").parquet(f"{root}/in")
    query = (
        meter_hourly_stream(stream).writeStream.format("parquet").option("path", f"{root}/out")
        .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    found = {(r["recorded_at"].hour, r["event_count"]) for r in spark.read.parquet(f"{root}/out").collect()}
    assert found == {(0, 2), (1, 1)}


def test_status_state_is_kept_by_part(spark):
    """As many entries as parts at most, however many rows; instants that are missing come first, as in the batch form."""
    root, schema = scratch_dir(spark, "test"), "table_name string, row_id long, status string, version_at timestamp, version_no int"
    feed = spark.range(5000).selectExpr("'t' AS table_name", "nullif(9007199254740993 + id, 9007199254740994) AS row_id", """inline(array(
        named_struct('status', 'a', 'version_at', CAST(NULL AS TIMESTAMP), 'version_no', 0),
        named_struct('status', 'b', 'version_at', TIMESTAMP '2025-01-01 00:00:00.000001' + make_interval(0, 0, 0, CAST(id AS INT)), 'version_no', 1),
        named_struct('status', IF(id % 2 = 0, 'b', NULL), 'version_at', TIMESTAMP '2125-01-01', 'version_no', CAST(NULL AS INT))))""")
    for wave in ("version_no IS NOT NULL", "version_no IS NULL"):
        feed.where(wave).write.mode("append").parquet(f"{root}/feed")
        steps = status_changes_stream(spark.readStream.schema(schema).parquet(f"{root}/feed"))
        query = (steps.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint")
                 .trigger(availableNow=True).start())
        query.awaitTermination()
        assert sum(p["stateOperators"][0]["numRowsUpdated"] for p in query.recentProgress) <= 2048
    out = spark.read.schema(steps.schema).parquet(f"{root}/out")
    whole = status_changes_from_feed(feed).select(*[c for c in out.columns if c != "late"])
    assert out.where("late").count() == 0 and whole.count() == 7500
    assert out.drop("late").exceptAll(whole).count() == 0 == whole.exceptAll(out.drop("late")).count()
