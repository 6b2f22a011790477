"""Log parsing and health bands."""

from datetime import datetime
from decimal import Decimal

import pytest

from tallyline.operators import telemetry

_AT = datetime(2025, 4, 15)


def test_slow_log(spark):
    lines = spark.createDataFrame([
        ("2025-04-15 07:41:03 UTC [932]: user=web,db=shop,app=cart,client=192.0.2.9 LOG:  duration: 871.250 ms  "
         "statement: UPDATE baskets SET total = total + 1",),
        ("2025-04-15 09:15:00 UTC [7]: user=u,db=d,app=,client=[local] LOG:  duration: 1000.000 ms  statement: SELECT 1",),
        ("2025-04-15 09:16:00 UTC [7]: user=u,db=d,app=a,client=c LOG:  duration: 200.000 ms  statement: SELECT 2",),
        ("2025-04-15 09:17:00 UTC [7]: LOG:  checkpoint starting",),
        ("duration: nonsense",),
    ], "line string")
    found = telemetry.slowest_statements(lines).collect()
    assert [(r["duration_ms"], r["pid"], r["app"]) for r in found] == [
        (Decimal("1000.000"), 7, ""), (Decimal("871.250"), 932, "cart"),
    ]
    assert found[1]["statement"] == "UPDATE baskets SET total = total + 1"
    assert found[1]["logged_at"] == datetime(2025, 4, 15, 7, 41, 3)
    assert len(telemetry.slowest_statements(lines, n=1).collect()) == 1


def test_every_duration_entry_is_kept_or_counted(spark):
    lines = spark.createDataFrame([(x,) for x in (
        "2025-03-02 10:00:00 UTC [1]: user=a,db=b,app=c,client=d LOG:  duration: 300 ms  statement: SELECT 1: x",
        "2025-03-02 10:00:00.250 UTC [2]: user=a,db=b,app=c,client=d LOG:  duration: 301.5 ms  execute s_7/p: SELECT $1",
        "2025-03-02 10:00:00 CET [3]: user=a,db=b,app=c,client=d LOG:  duration: 302 ms",
        "2025-03-02 10:00:00 UTC [4]: LOG:  duration: 303 ms  bind <unnamed>: SELECT 2",
        "2025-03-02 10:00:00 UTC [5]: LOG:  duration: about 5 s", "duration: ?", "duration: ?", "checkpoint",
    )], "line string")
    found = {r["pid"]: (r["logged_at"], r["kind"], r["statement"], r["user"]) for r in telemetry.parse_slow_log(lines).collect()}
    assert found == {
        1: (datetime(2025, 3, 2, 10), "statement", "SELECT 1: x", "a"),
        2: (datetime(2025, 3, 2, 10, 0, 0, 250000), "execute s_7/p", "SELECT $1", "a"),
        3: (datetime(2025, 3, 2, 9), None, None, "a"),
        4: (datetime(2025, 3, 2, 10), "bind <unnamed>", "SELECT 2", ""),
    }
    assert sorted(r["lines"] for r in telemetry.unparsed_durations(lines).collect()) == [1, 2]


def test_longest_statements(spark):
    sessions = spark.createDataFrame(
        [("a", _AT, 1, "active", datetime(2025, 4, 14, 23), "q1"), ("a", _AT, 2, "active", datetime(2025, 4, 14, 20), "q2"),
         ("a", _AT, 3, "idle", datetime(2025, 4, 1), "q3")],
        "instance string, snapshot_ts timestamp, pid int, state string, query_start timestamp, query string",
    )
    assert [(r["pid"], r["running_micros"]) for r in telemetry.longest_statements(sessions).collect()] == [
        (2, 4 * 3_600_000_000), (1, 3_600_000_000)]


def test_share_of_total_covers_all_statements(spark):
    stats = spark.createDataFrame(
        [("db", _AT, f"q{n:02}", 1, float(n), float(n), float(n)) for n in range(1, 21)],
        "instance string, snapshot_ts timestamp, query string, calls long, total_exec_time double, "
        "mean_exec_time double, max_exec_time double",
    )
    top = telemetry.statement_top_total(stats).orderBy("rank").collect()
    assert [r["query"] for r in top][:2] == ["q20", "q19"] and len(top) == 10
    assert top[0]["pct_of_total"] == Decimal("9.52")  # 20 of 210


def test_bands(spark):
    io = spark.createDataFrame(
        [("a", _AT, "t", 9950, 50), ("b", _AT, "t", 95, 5), ("c", _AT, "t", 90, 10), ("d", _AT, "t", 0, 0)],
        "instance string, snapshot_ts timestamp, relname string, heap_blks_hit long, heap_blks_read long",
    )
    assert {r["instance"]: r["status"] for r in telemetry.cache_hit_ratio(io).collect()} == {
        "a": "healthy", "b": "acceptable", "c": "investigate", "d": "no reads",
    }
    tables = spark.createDataFrame(
        [("a", _AT, "invoices_1", 95, 5), ("a", _AT, "invoices_2", 85, 15), ("a", _AT, "invoices_3", 70, 30),
         ("a", _AT, "invoices_4", 0, 0), ("a", _AT, "users", 0, 9)],
        "instance string, snapshot_ts timestamp, relname string, n_live_tup long, n_dead_tup long",
    ).selectExpr("*", "'public' AS schemaname", "snapshot_ts AS last_vacuum", "CAST(NULL AS TIMESTAMP) AS last_autovacuum")
    assert {r["relname"]: r["status"] for r in telemetry.dead_rows(tables).collect()} == {
        "invoices_1": "healthy", "invoices_2": "monitor", "invoices_3": "investigate", "invoices_4": "healthy",
    }
    standbys = spark.createDataFrame(
        [("s1", "streaming", "sync", None), ("s2", "streaming", "sync", 3000), ("s3", "streaming", "sync", 9000),
         ("s4", "streaming", "async", None), ("s5", "catchup", "sync", None)],
        "application_name string, state string, sync_state string, replay_lag_ms long",
    ).selectExpr("'a' AS instance", "current_timestamp() AS snapshot_ts", "*", "10L AS current_lsn", "4L AS replay_lsn", "1L AS write_lag_ms", "2L AS flush_lag_ms")
    assert {r["application_name"]: r["status"] for r in telemetry.replication_health(standbys).collect()} == {
        "s1": "healthy", "s2": "watch", "s3": "investigate", "s4": "not synchronous", "s5": "not streaming",
    }


def test_latest_snapshot(spark):
    stats = spark.createDataFrame(
        [("a", datetime(2025, 1, 1), 1), ("a", datetime(2025, 1, 2), 2), ("a", datetime(2025, 1, 9), 3)],
        "instance string, snapshot_ts timestamp, n int",
    )
    assert [r["n"] for r in telemetry.latest_snapshot(stats, "2025-01-05").collect()] == [2]


@pytest.mark.parametrize("size", [37, 200, 1000, 1 << 20])
def test_statements_of_many_lines_come_out_whole_however_files_are_split(spark, tmp_path, size):
    head = "2025-01-01 10:00:{:02d} UTC [{}]: user=u,db=d,app=a,client=c LOG:  duration: 900.5 ms  statement: "
    want, files = set(), {"instance=a/1.log": [], "instance=a/2.log": [], "instance=b/1.log": []}
    for f, (name, lines) in enumerate(files.items()):
        lines += ["\tgoes on from an older file", "2"]
        for k in range(30):
            text = [f"SELECT {f}", *[f"  line {n} 2025-01-01 [x]: duration: 1 ms" if n % 3 else "" for n in range(k % 11)]]
            tab = "\t" if k % 2 else ""
            lines += [head.format(k, k) + text[0], *[tab + x for x in text[1:]]]
            want.add((name[9], k, "\n".join(text)))
            lines += ["2025-01-01 10:00:59 UTC [9]: LOG:  checkpoint starting", "\tof which nothing", "duration: none"] * (k % 4)
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_text("\n".join(lines) + "\n")
    keys = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "0"}
    for key, value in keys.items():
        spark.conf.set(key, value)
    try:
        entries = telemetry.read_log_entries(spark, str(tmp_path))
        found = [(r["instance"], r["pid"], r["statement"]) for r in telemetry.parse_slow_log(entries).collect()]
    finally:
        for key in keys:
            spark.conf.unset(key)
    assert len(found) == len(want) and set(found) == want
    assert telemetry.unparsed_durations(entries).count() == 0


def test_logs_without_entries(spark, tmp_path):
    (tmp_path / "1.log").write_text("\tno\nentry duration: 5 ms\n")
    (tmp_path / "2.log").write_text("")
    assert telemetry.read_log_entries(spark, str(tmp_path)).collect() == []
