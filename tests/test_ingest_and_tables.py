import gzip
import json

import pytest
from pyspark.sql import functions as F

from odflux.operators import events, ingest, quality
from odflux.operators.windows import demand_windows
from odflux.sources import tables
from odflux.sources.polygons import enrich_polygons, load_zone_polygons
from odflux.sources.trip_files import canonicalise_header, scan_trip_csv

YELLOW = "﻿VendorID,tpep_pickup_datetime,tpep_dropoff_datetime,passenger_count,trip_distance,PULocationID,DOLocationID,total_amount,note\n"
GREEN = "lpep_pickup_datetime,Lpep_dropoff_datetime,PULocationID,DOLocationID,trip_distance,total_amount,ehail_fee\n"


@pytest.fixture
def extracts(tmp_path):
    (tmp_path / "a.csv").write_text(
        YELLOW
        + '1,2024-01-01 10:00:00,2024-01-01 10:10:00,2,1.5,10,20,12.50,"said ""hi"", left"\n'
        + "\n"
        + "1,2024-01-01 10:00:00,2024-01-01 09:00:00,2,1.5,10,20,12.50,\n"
        + "1,2024-01-01 10:00:00,2024-01-01 10:10:00,2,1.5,NaN,20,12.50\n")
    with gzip.open(tmp_path / "b.csv.gz", "wt") as out:
        out.write(GREEN + "01/01/2024 10:00:00 PM,2024-01-01T22:30:00,5,6.9,2,9,0.5\n")
    (tmp_path / "notes.md").write_text("not a trip file")
    return str(tmp_path)


def test_scan_unites_header_spellings(spark, extracts):
    rows = scan_trip_csv(spark, extracts).orderBy("source_file", "source_line").collect()
    assert [(r["source_file"], r["source_line"]) for r in rows] == [
        ("a.csv", 2), ("a.csv", 4), ("a.csv", 5), ("b.csv.gz", 2)]
    assert rows[3]["ehail_fee"] == "0.5" and rows[0]["ehail_fee"] is None


def test_parse_and_reject(spark, extracts):
    trips, rejects = ingest.parse_trips(scan_trip_csv(spark, extracts), "yellow")
    got = {r["source_file"]: r for r in trips.collect()}
    assert got["a.csv"]["pickup_time"] == "2024-01-01T15:00:00Z" and got["a.csv"]["average_speed_mph"] == 9.0
    assert got["b.csv.gz"]["trip_duration_seconds"] == 1800 and got["b.csv.gz"]["dropoff_location_id"] == 6
    told = {r["reason"]: r["detail"] for r in rejects.collect()}
    assert told == {"non_positive_duration": "duration_seconds=-3600", "zone_id_out_of_range": "pickup=0"}
    with pytest.raises(Exception, match="rejected row"):
        ingest.parse_trips(scan_trip_csv(spark, extracts), "yellow", fail_fast=True)[0].collect()


def test_missing_required_column(spark):
    with pytest.raises(ValueError, match="total_amount"):
        canonicalise_header(spark.createDataFrame([("x",)], "tpep_pickup_datetime string"))


def test_daylight_saving_gap_and_overlap(spark):
    times = ["2024-03-10 02:30:00", "2024-11-03 01:30:00", "2024-02-30 00:00:00", "2024-01-01 10:00:00 AM"]
    got = spark.createDataFrame([(t,) for t in times], "t string").select(
        ingest._instant_millis(ingest._one_layout(F.col("t")), "America/New_York").alias("ms")).collect()
    assert [r["ms"] for r in got] == [1710055800000, 1730611800000, None, None]


def test_event_json_keeps_nulls_and_round_trips(spark, extracts):
    trips, _ = ingest.parse_trips(scan_trip_csv(spark, extracts), "yellow")
    payload = ingest.to_event_json(trips)
    assert "airport_fee" in json.loads(payload.first()["value"])
    bad = spark.createDataFrame([("{broken",), ('{"event_id": null}',)], "value string")
    decoded = events.decode_payloads(payload.unionByName(bad))
    assert events.payload_quality(decoded).first().asDict() == {"payloads_seen": 4, "payloads_malformed": 2}
    assert events.valid_events(decoded).count() == 2


def test_summary_counts_bytes(spark, extracts):
    row = ingest.ingest_summary(ingest.assess_trips(scan_trip_csv(spark, extracts), "yellow")).first()
    assert (row["rows_read"], row["rows_accepted"], row["rows_rejected"]) == (4, 2, 2) and row["payload_bytes"] > 500


def test_window_longer_than_slide_by_a_fraction(spark):
    trips = spark.createDataFrame(
        [(1, 2, 10 * 60_000, 1, 1.0, 60, 1.0, 1.0, 1.0, 1.0)],
        "pickup_location_id int, dropoff_location_id int, pickup_epoch_millis long, passenger_count int, trip_distance_miles double,"
        " trip_duration_seconds long, average_speed_mph double, fare_amount double, total_amount double, tip_amount double")
    starts = [r[0] // 60_000 for r in demand_windows(trips, "10 minutes", "4 minutes").select("window_start").collect()]
    assert sorted(starts) == [4, 8]
    with pytest.raises(ValueError):
        demand_windows(trips, "4 minutes", "10 minutes")


def rows(spark, *data):
    return spark.createDataFrame(list(data), "location_id int, window_start long, trip_count long")


def test_upsert_touches_only_its_partitions(spark, tmp_path):
    path, day = str(tmp_path / "t"), 86_400_000
    tables.upsert_demand_windows(rows(spark, (1, 0, 1), (1, day, 2), (2, day, 3)), path)
    before = {r[0] for r in spark.read.parquet(path).where("window_day = 0").select("_metadata.file_path").collect()}
    tables.upsert_demand_windows(rows(spark, (1, day, 9), (3, 2 * day, None)), path)
    after = spark.read.parquet(path)
    assert {tuple(r) for r in after.select("location_id", "window_start", "trip_count").collect()} == {
        (1, 0, 1), (1, day, 9), (2, day, 3), (3, 2 * day, 0)}
    assert before == {r[0] for r in after.where("window_day = 0").select("_metadata.file_path").collect()}


def test_latest_per_key_by_order(spark):
    data = spark.createDataFrame([(1, 5, "new"), (1, 4, "old"), (2, 1, "x")], "k int, seq int, v string")
    assert {tuple(r) for r in tables.latest_per_key(data, ["k"], "seq").select("k", "v").collect()} == {(1, "new"), (2, "x")}


def test_store_reads_prune_partitions(spark, tmp_path):
    path = str(tmp_path / "fs")
    tables.write_feature_store(rows(spark, (1, 0, 1), (1, 86_400_000, 2)), path)
    plan = tables.read_feature_store(spark, path, 1, 2)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(window_day" in plan
    assert tables.read_feature_store(spark, path, 1, 2).count() == 1


def test_unique_check_ignores_null_keys(spark):
    data = spark.createDataFrame([(1,), (1,), (None,), (None,)], "k int")
    assert [tuple(r) for r in quality.dq_unique(data, ["k"]).collect()] == [(1, 2)]


def test_polygons_take_both_id_spellings(spark, tmp_path):
    shape = {"type": "Polygon", "coordinates": [[[0, 0], [0, 1], [1, 1], [0, 0]]]}
    props = [{"location_id": 1, "zone": "A"}, {"LocationID": "2", "zone": "B"}, {"LocationID": "x"}]
    (tmp_path / "z.json").write_text(json.dumps({"type": "FeatureCollection", "features": [
        {"type": "Feature", "geometry": shape, "properties": p} for p in props]}))
    metrics = spark.createDataFrame([(1, 7)], "location_id int, trip_count int")
    got = enrich_polygons(load_zone_polygons(spark, str(tmp_path / "z.json")), metrics, ["trip_count"]).collect()
    assert sorted((r["location_id"], r["trip_count"], r["zone_name"]) for r in got) == [(-1, 0, ""), (1, 7, "A"), (2, 0, "B")]
    assert json.loads(got[0]["geometry"]) == shape


def test_blank_header_is_an_error_and_a_repeated_header_a_row(spark, tmp_path):
    head = "tpep_pickup_datetime,tpep_dropoff_datetime,PULocationID,DOLocationID,trip_distance,total_amount"
    (tmp_path / "a.csv").write_text(f"{head}\n2024-01-01 00:00:00,2024-01-01 00:05:00,1,2,1.0,5.0\n{head}\n")
    (tmp_path / "empty.csv").write_text("")
    rows = scan_trip_csv(spark, str(tmp_path)).orderBy("source_line").collect()
    assert [(r.source_line, r.pickup_datetime) for r in rows] == [(2, "2024-01-01 00:00:00"), (3, "tpep_pickup_datetime")]
    (tmp_path / "b.csv").write_text(f"\n{head}\n")
    with pytest.raises(ValueError, match="b.csv lacks required columns"):
        scan_trip_csv(spark, str(tmp_path))


def test_upsert_reads_only_the_touched_days(spark, tmp_path, monkeypatch):
    path, day = str(tmp_path / "t"), 86_400_000
    tables.upsert_demand_windows(rows(spark, (1, 0, 1), (1, day, 2), (1, 2 * day, 3)), path)
    plans = []
    kept = tables.merge_rows
    monkeypatch.setattr(tables, "merge_rows", lambda *a: plans.append(a[0]._jdf.queryExecution().executedPlan().toString()) or kept(*a))
    tables.upsert_demand_windows(rows(spark, (1, day, 9)), path)
    assert "PartitionFilters: [window_day" in plans[0] or "PartitionFilters: [isnotnull(window_day" in plans[0]


def test_writer_that_died_while_moving_is_finished(spark, tmp_path, monkeypatch):
    path, day = str(tmp_path / "t"), 86_400_000
    tables.upsert_demand_windows(rows(spark, (1, 0, 1), (1, day, 2)), path)
    finish = tables.finish_move
    calls = []

    def dies(spark, at, partition=None):
        calls.append(at)
        if len(calls) == 2:
            raise RuntimeError("executor lost")
        finish(spark, at, partition)

    monkeypatch.setattr(tables, "finish_move", dies)
    with pytest.raises(RuntimeError):
        tables.upsert_demand_windows(rows(spark, (1, day, 7), (2, day, 8)), path)
    monkeypatch.setattr(tables, "finish_move", finish)
    import shutil
    shutil.rmtree(tmp_path / "t" / "window_day=1")  # what an overwrite removes first
    tables.upsert_demand_windows(rows(spark, (3, day, 5)), path)
    assert {tuple(r) for r in spark.read.parquet(path).select("location_id", "window_start", "trip_count").collect()} == {
        (1, 0, 1), (1, day, 7), (2, day, 8), (3, day, 5)}


def test_dimension_survives_a_dead_writer(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "zones")
    tables.replace_dimension(spark.createDataFrame([(1, "a")], "location_id int, zone_name string"), path)
    spark.createDataFrame([(2, "b")], "location_id int, zone_name string").write.parquet(f"{path}__staged")
    import shutil
    shutil.rmtree(path)
    assert [tuple(r) for r in tables.read_dimension(spark, path).collect()] == [(2, "b")]


def test_copies_without_an_order_settle_the_same_way(spark):
    data = spark.createDataFrame([(1, "b", 2), (1, "a", 9), (2, None, 1)], "k int, v string, n int")
    both = [sorted(map(tuple, tables.latest_per_key(d, ["k"], None).collect())) for d in (data, data.orderBy("n"))]
    assert both[0] == both[1] == [(1, "b", 2), (2, None, 1)]
