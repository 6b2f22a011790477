"""Status changes from snapshots and from a feed; history and incremental pulls."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyline.operators import audit
from tests.seed import seed_tables


@pytest.fixture(scope="module")
def log(spark):
    return seed_tables(spark).billing_audit_log


def test_snapshots(spark):
    before = spark.createDataFrame(
        [("a", "open", 1), ("b", "open", 1), ("c", None, 1), ("d", None, 1), ("gone", "open", 1)],
        "id string, status string, amount int",
    )
    after = spark.createDataFrame(
        [("a", "paid", 1), ("b", "open", 2), ("c", None, 1), ("d", "open", 1), ("new", "open", 1)],
        "id string, status string, amount int",
    )
    changes = audit.status_changes(before, after, "invoices", changed_at="2025-01-01", changed_by="u1")
    found = {(r["row_id"], r["old_status"], r["new_status"], r["changed_by"]) for r in changes.collect()}
    assert found == {("a", "open", "paid", "u1"), ("d", None, "open", "u1")}
    again = audit.status_changes(before, after, "invoices", changed_at="2025-01-01", changed_by="u1")
    assert {r["id"] for r in changes.collect()} == {r["id"] for r in again.collect()}


def test_actor_falls_back_to_the_session_user(spark):
    rows = spark.createDataFrame([("u1",), (None,)], "app_user string")
    user = spark.range(1).select(F.current_user()).first()[0]
    assert [r[0] for r in rows.select(audit.actor(F.col("app_user"))).collect()] == ["u1", user]


def brute_force(rows):
    last, steps = {}, []
    for table, row, status, at, number in sorted(rows, key=lambda r: (r[3], r[4])):
        if (table, row) in last and last[table, row] != status:
            steps.append((table, row, last[table, row], status, at))
        last[table, row] = status
    return sorted(steps, key=str)


@pytest.mark.parametrize("cell", ["hour", "day", "month"])
def test_feed_against_brute_force_with_a_hot_row(spark, cell):
    rng, start = random.Random(7), datetime(2024, 1, 1)
    rows = []
    for number in range(3000):
        # A third of all versions belong to one row.
        row = "hot" if number % 3 == 0 else f"r{rng.randrange(300)}"
        status = rng.choice(["draft", "open", "paid", None])
        rows.append(("invoices", row, status, start + timedelta(minutes=rng.randrange(60 * 24 * 50)), number))
    feed = spark.createDataFrame(
        rows, "table_name string, row_id string, status string, version_at timestamp, version_no int",
    )
    steps = audit.status_changes_from_feed(feed, cell)
    found = sorted(
        ((r["table_name"], r["row_id"], r["old_status"], r["new_status"], r["changed_at"]) for r in steps.collect()),
        key=str,
    )
    assert found == brute_force(rows)


def test_history_and_range(log):
    assert [r["id"] for r in audit.audit_history(log, "invoices", "i10").collect()] == ["a4"]
    found = audit.audit_between(log, "2025-05-21 15:20:00", "2025-08-19 06:30:00")
    assert {r["id"] for r in found.collect()} == {"a1", "a4"}


def test_incremental_pull(log):
    first = audit.audit_since(log, "1970-01-01 00:00:00")
    assert [r["id"] for r in first.collect()] == ["a3", "a1", "a4", "a2", "a5"]
    mark = audit.next_watermark(first, "1970-01-01 00:00:00").first()["watermark"]
    assert mark == datetime(2025, 9, 12, 18)
    assert audit.audit_since(log, mark).count() == 0
    assert audit.next_watermark(audit.audit_since(log, mark), mark).first()["watermark"] == mark
    assert [r["id"] for r in audit.audit_since(log, mark, overlap_seconds=60).collect()] == ["a5"]
    assert audit.audit_since(log, "1970-01-01", tables=("invoices",)).count() == 2
