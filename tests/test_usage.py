"""Metering, replacing upserts, the published rollup."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyline import scratch_dir
from tallyline.operators import reports, rules, usage
from tests.seed import frame, seed_tables

def bucket(number, tenant, at, endpoint, count):
    return (f"e{number}", tenant, at, endpoint, count)


def stored(spark, path):
    rows = usage.read_usage(spark, path).collect()
    return sorted((r["tenant_id"], str(r["recorded_at"]), r["endpoint"], r["event_count"], r["month"]) for r in rows)


def test_metering_truncates_and_normalises(spark):
    requests = spark.createDataFrame([
        ("t1", datetime(2025, 4, 1, 9, 0, 0), "/api/v1/invoices?page=2"),
        ("t1", datetime(2025, 4, 1, 9, 59, 59), "/api/v1/invoices"),
        ("t1", datetime(2025, 4, 1, 9, 30), "/api/v1/invoices#top?x"),
        ("t1", datetime(2025, 4, 1, 10, 0, 0), "/api/v1/invoices?a?b#c"),
        ("t2", datetime(2025, 4, 1, 9, 0, 0), "/"),
    ], "tenant_id string, requested_at timestamp, url string")
    found = {(r["tenant_id"], r["recorded_at"].hour, r["endpoint"], r["event_count"]) for r in usage.meter_hourly(requests).collect()}
    assert found == {("t1", 9, "/api/v1/invoices", 3), ("t1", 10, "/api/v1/invoices", 1), ("t2", 9, "/", 1)}


def test_upsert_replaces_counts_and_leaves_other_months(spark):
    path = f"{scratch_dir(spark, 'test')}/usage"
    first = [
        bucket(1, "t1", "2025-03-01 09:00:00", "/a", 1), bucket(2, "t1", "2025-04-01 09:00:00", "/a", 2),
        bucket(3, "t2", "2025-04-01 09:00:00", "/a", 3),
    ]
    second = [bucket(4, "t1", "2025-04-01 09:00:00", "/a", 20), bucket(5, "t1", "2025-05-01 00:00:00", "/a", 5)]
    usage.upsert_usage(spark, path, frame(spark, "api_usage_events", first))
    for _ in range(2):
        usage.upsert_usage(spark, path, frame(spark, "api_usage_events", second))
        assert stored(spark, path) == [
            ("t1", "2025-03-01 09:00:00", "/a", 1, "2025-03"), ("t1", "2025-04-01 09:00:00", "/a", 20, "2025-04"),
            ("t1", "2025-05-01 00:00:00", "/a", 5, "2025-05"), ("t2", "2025-04-01 09:00:00", "/a", 3, "2025-04"),
        ]


def test_metered_buckets_can_be_upserted_as_they_are(spark):
    path = f"{scratch_dir(spark, 'test')}/usage"
    requests = spark.createDataFrame(
        [("t1", datetime(2025, 4, 1, 9, minute), "/a") for minute in range(3)],
        "tenant_id string, requested_at timestamp, url string",
    )
    for _ in range(2):
        usage.upsert_usage(spark, path, usage.meter_hourly(requests))
    assert stored(spark, path) == [("t1", "2025-04-01 09:00:00", "/a", 3, "2025-04")]
    assert rules.validate("api_usage_events", usage.read_usage(spark, path)).count() == 0


def test_readers_see_whole_states_and_lost_runs_leave_no_trace(spark):
    path = f"{scratch_dir(spark, 'test')}/usage"
    usage.upsert_usage(spark, path, frame(spark, "api_usage_events", [bucket(1, "t1", "2025-03-01 09:00:00", "/a", 1)]))
    before = usage.read_usage(spark, path)
    usage.upsert_usage(spark, path, frame(spark, "api_usage_events", [bucket(1, "t1", "2025-03-01 09:00:00", "/a", 7)]))
    assert [r["event_count"] for r in before.collect()] == [1]
    # A run that died before it published: its folder is there, and nobody reads it.
    day = f"{path}/data/month=2025-03/day=2025-03-02/version=lost"
    frame(spark, "api_usage_events", [bucket(9, "t9", "2025-03-02 09:00:00", "/a", 9)]).write.parquet(day)
    assert [row[3] for row in stored(spark, path)] == [7]
    assert usage.vacuum_usage(spark, path) == 2
    assert [row[3] for row in stored(spark, path)] == [7]


def test_rows_without_a_usable_time_are_set_aside_and_the_table_stays_readable(spark):
    path = f"{scratch_dir(spark, 'test')}/usage"
    first = [bucket(1, "t1", "2025-03-01 09:00:00", "/a", 1), bucket(2, "t1", None, "/a", 2), bucket(3, None, None, "/b", 3)]
    assert usage.upsert_usage(spark, path, frame(spark, "api_usage_events", first[:1])) == (1, 0)
    far = frame(spark, "api_usage_events", [bucket(4, "t2", "2025-03-01 09:00:00", "/a", 4)]).withColumn(
        "recorded_at", F.expr("timestamp_seconds(253402300800 + 86400 * 400)"))
    for _ in range(2):
        assert usage.upsert_usage(spark, path, frame(spark, "api_usage_events", first[1:]).unionByName(far)) == (0, 3)
        assert stored(spark, path) == [("t1", "2025-03-01 09:00:00", "/a", 1, "2025-03")]
        waiting = usage.undated_usage(spark, path).select("tenant_id", "endpoint", "event_count").collect()
        assert sorted(map(tuple, waiting), key=str) == sorted([("t1", "/a", 2), (None, "/b", 3), ("t2", "/a", 4)], key=str)
    usage.upsert_usage(spark, path, frame(spark, "api_usage_events", [bucket(5, "t1", None, "/a", 20), bucket(6, "t1", "2025-03-02 00:00:00", "/a", 6)]))
    waiting = usage.undated_usage(spark, path).select("tenant_id", "event_count").collect()
    assert {tuple(r) for r in waiting} == {("t1", 20), (None, 3), ("t2", 4)}
    assert len(stored(spark, path)) == 2
    assert usage.vacuum_usage(spark, path) == 2
    assert usage.undated_usage(spark, path).count() == 3 and len(stored(spark, path)) == 2
    assert usage.undated_usage(spark, f"{path}-none").count() == 0


def test_a_batch_of_nothing_but_undated_rows_makes_a_table(spark):
    path = f"{scratch_dir(spark, 'test')}/usage"
    assert usage.upsert_usage(spark, path, frame(spark, "api_usage_events", [bucket(1, "t1", None, "/a", 1)])) == (0, 1)
    assert stored(spark, path) == [] and usage.undated_usage(spark, path).count() == 1
    assert usage.upsert_usage(spark, path, frame(spark, "api_usage_events", [])) == (0, 0)
    assert usage.undated_usage(spark, path).count() == 1


def test_nothing_is_published_that_is_not_there(spark, monkeypatch):
    path = f"{scratch_dir(spark, 'test')}/usage"
    rows = frame(spark, "api_usage_events", [bucket(1, "t1", "2025-03-01 09:00:00", "/a", 1)])
    usage.upsert_usage(spark, path, rows)
    monkeypatch.setattr(usage, "move_path", lambda *_: None)
    with pytest.raises(RuntimeError):
        usage.upsert_usage(spark, path, frame(spark, "api_usage_events", [bucket(1, "t1", "2025-03-02 09:00:00", "/a", 7)]))
    assert [row[3] for row in stored(spark, path)] == [1]


def test_new_days_are_moved_and_only_known_ones_merged(spark, monkeypatch):
    path = f"{scratch_dir(spark, 'test')}/usage"
    writes = []
    write = usage._write_days
    monkeypatch.setattr(usage, "_write_days", lambda rows, version, to: (writes.append(to), write(rows, version, to)))
    twice = [bucket(1, "t1", "2025-03-01 09:00:00", "/a", 1), bucket(2, "t2", "2025-03-02 09:00:00", "/a", 2)]
    usage.upsert_usage(spark, path, frame(spark, "api_usage_events", twice))
    assert len(writes) == 1
    usage.upsert_usage(spark, path, frame(spark, "api_usage_events", [*twice[1:], bucket(3, "t3", "2025-03-03 09:00:00", "/a", 3)]))
    assert len(writes) == 3 and writes[2].endswith("/data")
    assert [row[3] for row in stored(spark, path)] == [1, 2, 3]


# --- the rollup kept up ------------------------------------------------------------------------------


def calls(df):
    return sorted((r["subscription_id"], r["endpoint"], r["total_calls"], str(r["period_start"]), r["tenant_name"], str(r["pct_limit_consumed"])) for r in df.collect())


@pytest.fixture()
def kept(spark):
    """Seed usage in a table and its first rollup; ``again`` refreshes it and holds it against the whole computation."""
    t, root = seed_tables(spark), scratch_dir(spark, "test")
    table, path, state = f"{root}/usage", f"{root}/rollup", {"n": 0}
    usage.upsert_usage(spark, table, t.api_usage_events)

    def again(tenants=t.tenants, subs=t.subscriptions, plans=t.plans):
        state["n"] += 1
        done = usage.refresh_from_usage(spark, table, path, f"v{state['n']}", tenants, subs, plans, as_of="2025-10-18")
        whole = reports.usage_by_cycle(usage.read_usage(spark, table), tenants, subs, plans, as_of="2025-10-18")
        assert calls(usage.read_usage_by_cycle(spark, path)) == calls(whole) and whole.count() > 0
        return done

    assert not again().incremental
    return t, table, path, again


def test_a_refresh_reads_changed_days_only(spark, kept, monkeypatch):
    t, table, path, again = kept
    read = []
    days = usage.read_folders
    monkeypatch.setattr(usage, "read_folders", lambda spark, where, folders, schema: (read.append(len(folders)), days(spark, where, folders, schema))[1])
    seen = []
    counted = usage.cycle_calls
    monkeypatch.setattr(usage, "cycle_calls", lambda rows, cycles: (seen.append(len(rows.inputFiles())), counted(rows, cycles))[1])
    assert again()[1:] == (0, True) and seen == []
    usage.upsert_usage(spark, table, t.api_usage_events.where("day(recorded_at) = 4").withColumn("event_count", F.col("event_count") + 100))
    seen.clear()
    done = again()
    assert done.incremental and done.days == 1 and len(seen) == 2 and max(seen) <= 2


def test_a_refresh_follows_cycles_tenants_and_plans(spark, kept):
    t, table, path, again = kept
    moved = t.subscriptions.withColumn("current_period_start", F.when(F.col("id") == "s1", F.expr("current_period_start - INTERVAL 40 DAYS"))
                                       .otherwise(F.col("current_period_start")))
    assert again(subs=moved).incremental
    assert again(subs=moved.where("id <> 's5'"), tenants=t.tenants.withColumn("name", F.upper("name"))).incremental
    assert again(plans=t.plans.withColumn("api_limit", F.col("api_limit") * 2)).incremental
    gone = t.tenants.withColumn("deleted_at", F.when(F.col("id") == "t1", F.current_timestamp()).otherwise(F.col("deleted_at")))
    assert again(tenants=gone).incremental and again().incremental


def test_a_refresh_starts_anew_where_the_old_days_are_gone(spark, kept):
    t, table, path, again = kept
    usage.upsert_usage(spark, table, t.api_usage_events.withColumn("event_count", F.col("event_count") + 1))
    usage.vacuum_usage(spark, table, rollups=[path])
    assert again().incremental
    usage.upsert_usage(spark, table, t.api_usage_events)
    usage.vacuum_usage(spark, table)
    assert not again().incremental and again().incremental
    rollup = usage.read_usage_by_cycle(spark, path)
    usage.refresh_usage_by_cycle(spark, rollup, path, "by-hand")
    assert not again().incremental


def test_hours_metered_again_replace_what_the_stream_left(spark):
    path = f"{scratch_dir(spark, 'test')}/usage"
    requests = spark.createDataFrame(
        [("t1", datetime(2025, 4, 1, hour, 5), "/a") for hour in (8, 8, 9)], "tenant_id string, requested_at timestamp, url string")
    usage.upsert_usage(spark, path, usage.meter_hourly(requests.limit(1)))
    usage.remeter(spark, path, requests, "2025-04-01 09:00:00")
    assert [row[3] for row in stored(spark, path)][1:] == [1]
    usage.remeter(spark, path, requests, "2025-04-01 08:00:00", "2025-04-01 09:00:00")
    assert [row[3] for row in stored(spark, path)] == [2, 1]


def test_an_existing_rollup_version_is_never_written_again(spark):
    path = f"{scratch_dir(spark, 'test')}/rollup"
    good = spark.createDataFrame([("s1", "/a", 1)], "subscription_id string, endpoint string, total_calls int")
    usage.refresh_usage_by_cycle(spark, good, path, "v1")
    with pytest.raises(ValueError):
        usage.refresh_usage_by_cycle(spark, good.union(good), path, "v1")
    assert usage.read_usage_by_cycle(spark, path).count() == 1


def test_usage_between(spark):
    t = seed_tables(spark)
    assert usage.usage_between(t.api_usage_events, "2025-10-04", "2025-10-05").count() == 5
    assert usage.usage_between(t.api_usage_events, "2025-10-04", "2025-10-05", "t2").count() == 1


def test_readers_keep_the_old_rollup_until_the_new_one_is_sound(spark):
    t = seed_tables(spark)
    path = f"{scratch_dir(spark, 'test')}/rollup"
    with pytest.raises(FileNotFoundError):
        usage.read_usage_by_cycle(spark, path)
    rollup = reports.usage_by_cycle(t.api_usage_events, t.tenants, t.subscriptions, t.plans, as_of="2025-10-18")
    usage.refresh_usage_by_cycle(spark, rollup.where("tenant_id = 't1'"), path, "v1")
    assert usage.read_usage_by_cycle(spark, path).count() == 2
    with pytest.raises(ValueError):
        usage.refresh_usage_by_cycle(spark, rollup.union(rollup), path, "v2")
    assert usage.read_usage_by_cycle(spark, path).count() == 2
    usage.refresh_usage_by_cycle(spark, rollup, path, "v3")
    assert usage.read_usage_by_cycle(spark, path).count() == 7
