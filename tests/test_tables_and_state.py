"""Upserts work their rows out once and survive a stop half-way; sketches and copies need no large tables; stream state is on disk."""

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from odflux.operators.windows import demand_windows
from odflux.sources import tables
from odflux.streaming import queries as streams


def _rows(spark, *rows):
    return spark.createDataFrame(list(rows), "location_id int, window_start long, trip_count long, window_day long")


def _kept(spark, path):
    return {(r.location_id, r.window_start): r.trip_count for r in spark.read.parquet(path).collect()}


def test_an_upsert_works_its_rows_out_once(spark, tmp_path):
    path, keys = str(tmp_path / "t"), ["location_id", "window_start"]
    tables.upsert(_rows(spark, (1, 1, 5, 0), (2, 1, 6, 0), (3, 90_000_000, 7, 1)), path, keys)
    met = spark.sparkContext.accumulator(0)

    def count(value):
        met.add(1)
        return value
    worked_out = _rows(spark, (1, 1, 50, 0), (4, 1, 8, 0)).withColumn("trip_count", F.udf(count, T.LongType()).asNondeterministic()("trip_count"))
    tables.upsert(worked_out, path, keys)
    assert met.value == 2
    assert _kept(spark, path) == {(1, 1): 50, (2, 1): 6, (3, 90_000_000): 7, (4, 1): 8}


def test_a_stop_between_new_and_staying_rows_loses_nothing(spark, tmp_path, monkeypatch):
    path, keys = str(tmp_path / "t"), ["location_id", "window_start"]
    tables.upsert(_rows(spark, (1, 1, 5, 0), (2, 1, 6, 0)), path, keys)
    half = _rows(spark, (1, 1, 50, 0))
    half.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{path}__staged")
    tables.finish_move(spark, path, tables.PARTITION)
    assert _kept(spark, path) == {(1, 1): 5, (2, 1): 6}
    tables.upsert(_rows(spark, (2, 1, 60, 0)), path, keys)
    assert _kept(spark, path) == {(1, 1): 5, (2, 1): 60}


def test_an_upsert_with_other_columns_keeps_both(spark, tmp_path):
    path, keys = str(tmp_path / "t"), ["location_id", "window_start"]
    tables.upsert(_rows(spark, (1, 1, 5, 0), (2, 1, 6, 0)), path, keys)
    tables.upsert(_rows(spark, (1, 1, 50, 0)).withColumn("note", F.lit("x")).drop("trip_count"), path, keys)
    got = {r.location_id: (r.trip_count, r.note) for r in spark.read.option("mergeSchema", "true").parquet(path).collect()}
    assert got == {1: (None, "x"), 2: (6, None)}


def test_the_newest_row_of_a_key_stays_and_rows_without_an_order_are_older(spark):
    rows = spark.createDataFrame([(1, None, 9), (1, 2, 3), (1, 2, 4), (2, None, 1)], "id int, at int, v int")
    assert sorted(map(tuple, tables.latest_per_key(rows, ["id"], "at").collect())) == [(1, 2, 4), (2, None, 1)]


def test_copies_of_demand_rows_go_without_a_table_of_keys(spark):
    rows = spark.createDataFrame([(1, 10, 5), (1, 10, 5), (1, None, 7), (1, None, 7), (None, 10, 2), (None, 10, 2), (2, 10, 1)],
                                 "location_id int, window_start long, trip_count long").withColumn("window_end", F.col("window_start") + 1)
    kept = tables.demand_features(rows)
    assert sorted(map(str, kept.select("location_id", "window_start", "trip_count").collect())) == sorted(map(str, [
        *rows.distinct().select("location_id", "window_start", F.col("trip_count").cast("double").alias("trip_count")).collect()]))
    assert "Aggregate" not in kept._jdf.queryExecution().executedPlan().toString()


def test_sketches_are_built_behind_the_shuffle_only(spark):
    trips = spark.createDataFrame([(1, d, 60_000 * d, 1, 1.0, 60, 2.0, 3.0, 4.0, 0.5) for d in range(9)],
                                  "pickup_location_id int, dropoff_location_id int, pickup_epoch_millis long, passenger_count int, trip_distance_miles double, "
                                  "trip_duration_seconds int, average_speed_mph double, fare_amount double, total_amount double, tip_amount double")
    about = demand_windows(trips)
    plan = about._jdf.queryExecution().executedPlan().toString()
    last_shuffle = plan.index("REPARTITION_BY_NUM")
    assert "hyperlog" not in plan[last_shuffle:].lower() and "approx_count_distinct" not in plan[last_shuffle:]
    assert sorted(map(tuple, about.collect())) == sorted(map(tuple, demand_windows(trips, exact_distinct=True).collect()))


def test_streams_keep_their_state_on_disk_in_any_session(spark, tmp_path):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        trip = json.dumps({"event_id": "a", "pickup_epoch_millis": 6_000_000, "dropoff_epoch_millis": 6_600_000, "trip_duration_seconds": 600,
                           "pickup_location_id": 1, "dropoff_location_id": 2, "passenger_count": 1, "trip_distance_miles": 1.0, "total_amount": 5.0})
        src = str(tmp_path / "src")
        spark.createDataFrame([("k", trip, 0)], "key string, value string, event_millis long").write.parquet(src)
        trips = streams.trip_stream(streams.read_event_stream(spark, {"path": src}))
        run = streams.start_demand_query(trips, str(tmp_path / "out"), str(tmp_path / "mark"), "update", {"availableNow": True})
        run.awaitTermination()
        told = [op.customMetrics for p in run.recentProgress for op in p.stateOperators]
        assert told and all(any(name.startswith("rocksdb") for name in metrics) for metrics in told)
    finally:
        spark.conf.set(key, before)
