"""Previous rows and running maxima over cells and pieces, against plain versions."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyline.plans import in_pieces, with_previous, with_running_max

ORDER = ["at", "n"]


@pytest.fixture(scope="module")
def feed(spark):
    """One key with most rows, half of them of one instant; keys, times and values that are missing."""
    rng, start = random.Random(4), datetime(2025, 1, 1)
    rows = []
    for n in range(3000):
        key = "hot" if n % 3 else rng.choice(["a", "b", None])
        at = start if key == "hot" and n % 2 else None if n % 97 == 0 else start + timedelta(minutes=rng.randint(0, 4000))
        rows.append((key, at, n, rng.choice([None, 1, 2, 3, n])))
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "key string, at timestamp, n int, value int")


def in_order(rows):
    by = {}
    for row in sorted(rows, key=lambda r: (r[1] is not None, r[1] or datetime.min, r[2])):
        by.setdefault(row[0], []).append(row)
    return by.values()


@pytest.mark.parametrize(("every", "pieces"), [(1024, 256), (5, 7), (2, 1000), (1, 3)])
def test_previous_and_running_maximum(feed, every, pieces):
    rows, df = feed
    previous, most = {}, {}
    for own in in_order(rows):
        high = None
        for k, row in enumerate(own):
            previous[row[2]] = None if k == 0 else (own[k - 1][3],)
            most[row[2]] = high
            high = row[3] if high is None else max(high, row[3] or 0)
    day = F.date_trunc("day", "at")
    found = with_previous(df, ["key"], ORDER, "value", day, "before", every, pieces).collect()
    assert len(found) == len(rows) and {r.n: None if r.before is None else tuple(r.before) for r in found} == previous
    found = with_running_max(df, ["key"], ORDER, "value", day, "most", every, pieces).collect()
    assert len(found) == len(rows) and {r.n: r.most for r in found} == most


def test_a_cell_of_very_many_rows_is_cut_in_pieces_in_order(spark):
    df = spark.range(60_000).select(F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id")).alias("key"), F.lit(5).alias("at"), F.col("id").alias("n"))
    placed = in_pieces(df, ["key"], ORDER, F.lit(1), every=64, pieces=40)
    pieces = placed.where("key = 0").groupBy("_cell").agg(F.count("*").alias("rows"), F.min("n").alias("low"), F.max("n").alias("high")).orderBy("_cell").collect()
    assert len(pieces) > 30 and max(p["rows"] for p in pieces) < 8_000
    assert all(a["high"] < b["low"] for a, b in zip(pieces, pieces[1:]))
    assert {r["_piece"] for r in placed.where("key <> 0").select("_cell.*").distinct().collect()} == {0}
    again = in_pieces(df.repartition(7), ["key"], ORDER, F.lit(1), every=64, pieces=40)
    assert placed.exceptAll(again).isEmpty()


def test_rows_of_one_key_and_day_are_spread_over_tasks(spark):
    hot = spark.range(100_000).select(F.pmod("id", F.lit(1)).alias("key"), F.pmod("id", F.lit(1)).alias("at"), F.col("id").alias("n"), F.col("id").alias("value"))
    placed = in_pieces(hot, ["key"], ORDER, F.lit(1))
    spread = placed.repartition(16, "key", "_cell").groupBy(F.spark_partition_id()).count().collect()
    assert len(spread) > 8 and max(r["count"] for r in spread) < 40_000
    plan = with_previous(hot, ["key"], ORDER, "value", F.lit(1), "before")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
