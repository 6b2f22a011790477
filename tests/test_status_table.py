"""The table of status steps: versions in any order, repeated, late, lost runs."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tallyline import scratch_dir
from tallyline.plans.windows import piece_begins
from tallyline.sources.lake import list_folders
from tallyline.streaming import status_table
from tallyline.streaming.status_table import land_status_changes, land_versions, read_status_changes

SCHEMA = "table_name string, row_id string, status string, version_at timestamp, version_no int"
START = datetime(2025, 1, 1)


def plain(rows):
    by = {}
    for table, row, status, at, n in set(rows):
        by.setdefault((table, row), []).append((at, n, status))
    out = []
    for key, versions in by.items():
        versions.sort(key=lambda v: v[:2])
        out += [(*key, a[2], b[2], b[0]) for a, b in zip(versions, versions[1:]) if a[2] != b[2]]
    return sorted(out, key=str)


def steps(spark, path):
    return sorted(map(tuple, read_status_changes(spark, path).collect()), key=str)


def test_versions_in_any_order_give_the_steps_of_all(spark, monkeypatch):
    monkeypatch.setattr(status_table, "RUNS", 2)
    rng, rows = random.Random(8), []
    for n in range(120):
        at = START + timedelta(hours=n // 3 if n % 2 else 5)
        rows.append((rng.choice(["invoices", None]), rng.choice(["i1", "i2", "i3", None]), rng.choice(["open", "paid", None]), at, n))
    rng.shuffle(rows)
    path, sofar = f"{scratch_dir(spark, 'test')}/steps", []
    for k in range(0, 120, 30):
        batch = rows[k:k + 30] + rng.sample(sofar, min(5, len(sofar)))
        sofar += batch
        land_versions(spark.createDataFrame(batch + batch[:3], SCHEMA), path)
        assert steps(spark, path) == plain(sofar)
    state = status_table._state(spark, path)
    assert state["number"] == 4 and len(state["newest"]) <= 2
    land_versions(spark.createDataFrame(batch, SCHEMA), path)
    land_versions(spark.createDataFrame([], SCHEMA), path)
    assert steps(spark, path) == plain(rows)


def test_only_rows_with_late_versions_are_taken_again(spark):
    path = f"{scratch_dir(spark, 'test')}/steps"
    first = [("t", f"r{k}", "open", START, 0) for k in range(50)] + [("t", f"r{k}", "void", START + timedelta(days=2), 2) for k in range(50)]
    land_versions(spark.createDataFrame(first, SCHEMA), path)
    late = [("t", "r7", "paid", START + timedelta(days=1), 1), ("t", "r8", "paid", START + timedelta(days=3), 3)]
    land_versions(spark.createDataFrame(late, SCHEMA), path)
    state = status_table._state(spark, path)
    again = spark.read.parquet(f"{path}/again/commit={state['again'][0]}")
    assert [r["row_id"] for r in again.collect()] == ["r7"]
    assert spark.read.parquet(f"{path}/steps/commit={state['steps'][1]}").count() == 3
    assert steps(spark, path) == plain(first + late)
    # A repeated batch finds its late version known.
    land_versions(spark.createDataFrame(late, SCHEMA), path)
    assert steps(spark, path) == plain(first + late)
    assert spark.read.parquet(f"{path}/steps/commit={status_table._state(spark, path)['steps'][2]}").count() == 0


def test_a_lost_run_publishes_nothing(spark, monkeypatch):
    path = f"{scratch_dir(spark, 'test')}/steps"
    rows = [("t", "r", "open", START, 0), ("t", "r", "paid", START, 1), ("t", "r", "void", START, 2)]
    land_versions(spark.createDataFrame(rows[:2], SCHEMA), path)
    with monkeypatch.context() as m:
        m.setattr(status_table, "publish_version", lambda *_: 1 / 0)
        try:
            land_versions(spark.createDataFrame(rows[2:], SCHEMA), path)
        except ZeroDivisionError:
            pass
    assert steps(spark, path) == plain(rows[:2])
    land_versions(spark.createDataFrame(rows[2:], SCHEMA), path)
    assert steps(spark, path) == plain(rows)
    assert read_status_changes(spark, f"{path}-none").count() == 0


def test_the_stream_runs_no_python_on_workers(spark):
    root = scratch_dir(spark, "test")
    rows = [("t", f"r{k % 4}", f"s{k % 3}", START + timedelta(hours=k), k) for k in range(40)]
    for k in (0, 20):
        spark.createDataFrame(rows[k:k + 20], SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/feed")
        land_status_changes(spark.readStream.schema(SCHEMA).parquet(f"{root}/feed"), f"{root}/steps", f"{root}/checkpoint").awaitTermination()
    found = read_status_changes(spark, f"{root}/steps")
    assert sorted(map(tuple, found.collect()), key=str) == plain(rows)
    batch = spark.createDataFrame(rows, SCHEMA)
    plan = status_table._steps(batch.selectExpr("*", "false AS _known"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "FlatMapGroups" not in plan


def test_a_batch_is_compared_once_and_writes_what_came_further_only(spark):
    path = f"{scratch_dir(spark, 'test')}/steps"
    first = [("t", f"r{k}", "open", START, 0) for k in range(40)]
    land_versions(spark.createDataFrame(first, SCHEMA), path)
    # A repeated batch brings nothing new: no newest versions, no rows to take again.
    land_versions(spark.createDataFrame(first, SCHEMA), path)
    state = status_table._state(spark, path)
    assert len(state["versions"]) == 2 and len(state["newest"]) == 1 and state["again"] == []
    second = [("t", "r1", "paid", START, 1), ("t", "r2", "open", START, 0), ("t", "r3", "late", START - timedelta(days=1), 0)]
    land_versions(spark.createDataFrame(second, SCHEMA), path)
    state = status_table._state(spark, path)
    newest = spark.read.parquet(f"{path}/newest/commit={state['newest'][1]}")
    assert [r["row_id"] for r in newest.collect()] == ["r1"] and len(state["again"]) == 1
    assert not list_folders(spark, f"{path}/matched", "commit=")
    assert steps(spark, path) == plain(first + second)


def test_steps_of_a_row_with_very_many_versions_are_found_in_pieces(spark):
    rows = spark.range(30_000).selectExpr(
        "'t' AS table_name", "IF(id % 10 < 7, 'hot', concat('r', id % 50)) AS row_id", "IF(id % 11 = 0, NULL, concat('s', id % 3)) AS status",
        "TIMESTAMP '2025-01-01' + make_dt_interval(0, 0, 0, id DIV 3) AS version_at", "CAST(id AS INT) AS version_no")
    begins = piece_begins(rows, status_table.KEYS, status_table.ORDER, F.lit(0), every=64, pieces=30)
    assert [r["row_id_r"] for r in begins.where("size(_begins) > 20").collect()] == ["hot"]
    found = status_table._steps(rows, begins).collect()
    assert sorted(map(tuple, found), key=str) == plain(map(tuple, rows.collect()))
