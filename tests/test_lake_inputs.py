"""What registered queries write to read again: files of bounded size, whatever the size of the tables."""

from datetime import datetime

from checks import lake_queries
from tallyline import scratch_dir

AT = datetime(1996, 1, 2)


def test_log_files_of_an_instance_are_written_by_several_tasks(spark, tmp_path, monkeypatch):
    spark.range(4000).selectExpr("id AS event_id", "TIMESTAMP_NTZ '2024-01-03 00:00:00' AS ts", "0L AS user_id", "concat('kind', id) AS event_type",
                                 "CAST(300 + id AS DOUBLE) AS value").write.parquet(f"{tmp_path}/events.parquet")
    root = scratch_dir(spark, "test")
    monkeypatch.setattr(lake_queries, "scratch_dir", lambda *_: root)
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "4k")
    try:
        found = lake_queries._slow_log_over_lines(spark, str(tmp_path))
        assert found.count() == 4000 - 400 - 40
    finally:
        spark.conf.unset(key)
    assert len(spark.read.text(f"{root}/instance=db-0").inputFiles()) > 1


def test_slices_take_files_of_bounded_size(spark, tmp_path, monkeypatch):
    orders = [(k, k, "F", 1.0, AT) for k in range(60)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(1, "c")], "c_custkey long, c_name string").write.parquet(f"{tmp_path}/customer.parquet")
    root = scratch_dir(spark, "test")
    monkeypatch.setattr(lake_queries, "scratch_dir", lambda *_: root)
    monkeypatch.setattr(lake_queries, "_FILE_ROWS", 10)
    assert lake_queries._in_slices(spark, str(tmp_path)).count() == 60
    assert len(spark.read.parquet(f"{root}/log").inputFiles()) == 6
