import json
import math
import random
import time

import pytest
from pyspark.sql import functions as F

from odflux.operators import explain, features, forecast
from odflux.operators.forecast import TrainConfig
from odflux.plans import jobs
from odflux.sources import tables
from odflux.streaming import queries as streams

NOW = {"availableNow": True}
SMALL = {"maxIter": 4, "maxDepth": 3, "stepSize": 0.3}


def payload(event, minute, zone=1):
    at = minute * 60_000
    return json.dumps({"event_id": event, "pickup_epoch_millis": at, "dropoff_epoch_millis": at + 600_000,
                       "trip_duration_seconds": 600, "pickup_location_id": zone, "dropoff_location_id": 2,
                       "passenger_count": 1, "trip_distance_miles": 1.0, "total_amount": 5.0})


def send(spark, path, *values):
    spark.createDataFrame([("k", v, 0) for v in values], "key string, value string, event_millis long") \
        .coalesce(1).write.mode("append").parquet(path)


def run(spark, src, out, mark, mode="update"):
    trips = streams.trip_stream(streams.read_event_stream(spark, {"path": src}))
    streams.start_demand_query(trips, out, mark, mode, NOW).awaitTermination()


def counts(spark, out):
    return {r["window_start"] // 60_000: r["trip_count"] for r in spark.read.parquet(out).collect()}


def test_copies_bad_payloads_and_late_events(spark, tmp_path):
    src, out, mark = (str(tmp_path / n) for n in ("src", "out", "mark"))
    send(spark, src, payload("a", 100), payload("a", 100), payload("b", 101), "{bad")
    run(spark, src, out, mark)
    assert counts(spark, out) == {90: 2, 95: 2, 100: 2}
    send(spark, src, payload("c", 300))
    run(spark, src, out, mark)
    send(spark, src, payload("too-late", 101), payload("b", 101))
    run(spark, src, out, mark)
    assert counts(spark, out)[100] == 2 and counts(spark, out)[300] == 1


def test_progress_is_a_table(spark, tmp_path):
    log = streams.ProgressLog(spark, str(tmp_path / "progress"))
    spark.streams.addListener(log)
    try:
        src = str(tmp_path / "src")
        send(spark, src, payload("a", 100), "{bad")
        run(spark, src, str(tmp_path / "out"), str(tmp_path / "mark"))
        for _ in range(100):
            if tables.path_exists(spark, str(tmp_path / "progress")) and log.frame().count():
                break
            time.sleep(0.1)
        assert log.frame().agg(F.max("payloads_seen"), F.max("payloads_malformed")).first()[:] == (2, 1)
    finally:
        spark.streams.removeListener(log)


def test_stream_job_keeps_both_tables(spark, tmp_path):
    src = str(tmp_path / "src")
    send(spark, src, payload("a", 100), payload("b", 101))
    cfg = jobs.JobConfig(str(tmp_path / "lake"))
    for query in jobs.stream_job(spark, cfg, {"path": src}, NOW):
        query.awaitTermination()
    assert spark.read.parquet(cfg.at("demand_windows")).agg(F.sum("trip_count")).first()[0] == 6
    assert spark.read.parquet(cfg.at("zone_flows")).agg(F.sum("trip_count")).first()[0] == 6


def test_validation_leaves_the_callers_cache(spark, matrix):
    rows = features.assemble_vector(matrix).persist()
    forecast.walk_forward_validate(rows, TrainConfig(params=SMALL), folds=2)
    assert rows.is_cached
    tried = forecast.grid_search(rows, [TrainConfig(params=SMALL), TrainConfig(params={**SMALL, "maxDepth": 1})], folds=1)
    assert rows.is_cached and len(tried) == 2
    scores = [report.first()["mean_rmse"] for _, report in tried]
    assert scores == sorted(scores)
    rows.unpersist()


def test_generic_evaluator_and_unclamped_bounds(spark, matrix):
    model = forecast.train(matrix, TrainConfig(params=SMALL, clamp=False))
    scored = forecast.score(model, matrix)
    assert forecast.evaluator(model.config).evaluate(scored) == pytest.approx(model.metrics["rmse"])
    low = scored.withColumn("prediction", F.lit(-2.0))
    from odflux.operators.evaluation import forecast_intervals
    assert forecast_intervals(low, -1.0, 1.0, clamp=False).first()["forecast_trip_count"] == -2.0
    assert forecast_intervals(low, -1.0, 1.0).first()["forecast_trip_count"] == 0.0
    assert {r.location_id for r in forecast.evaluate_by_zone(model, matrix).collect()} == {0, 1, 2}
    assert forecast.unused_features(model).where("importance > 0").isEmpty()


def test_append_mode_emits_only_closed_windows(spark, tmp_path):
    src, out, mark = (str(tmp_path / n) for n in ("src", "out", "mark"))
    send(spark, src, payload("a", 100), payload("b", 300))
    run(spark, src, out, mark, "append")
    assert set(counts(spark, out)) == {90, 95, 100}
    with pytest.raises(ValueError):
        run(spark, src, out, mark, "complete")


@pytest.fixture(scope="module")
def matrix(spark):
    rows = [(z, s * 300_000, float(40 + 25 * math.sin(2 * math.pi * s / 48) + 5 * z)) for z in range(3) for s in range(240)]
    frame = spark.createDataFrame(rows, "location_id int, window_start long, trip_count double").withColumn(
        "demand_per_minute", F.col("trip_count") / 15)
    made = features.target_label(features.lag_features(features.calendar_features(frame), (1, 2, 3)), 3)
    return features.trim_warm_up(made, 6, 300_000).persist()


def test_train_forecast_save_and_load(spark, matrix, tmp_path):
    model = forecast.train(matrix, TrainConfig(params=SMALL, seed=7))
    told = forecast.forecast(model, matrix)
    assert told.where("forecast_lower_bound < 0 or forecast_lower_bound > forecast_upper_bound").isEmpty()
    assert model.metrics["r2"] > 0.5 and "trip_count_lag_1" in model.feature_names
    path = str(tmp_path / "model")
    forecast.save_model(model, path, "v7", 0.25)
    again = forecast.load_model(path)
    assert forecast.saved_version(spark, path) == "v7" and again.config == model.config
    differ = forecast.forecast(again, matrix).exceptAll(told)
    assert differ.isEmpty()
    with pytest.raises(ValueError):
        forecast.save_model(model, path, " ")
    with pytest.raises(FileNotFoundError):
        forecast.load_model(str(tmp_path / "none"))


def test_training_refuses_empty_and_short_history(spark, matrix):
    with pytest.raises(ValueError):
        forecast.train(matrix.limit(0), TrainConfig(params=SMALL))
    with pytest.raises(ValueError):
        forecast.walk_forward_validate(matrix.where("window_start < 3000000"), TrainConfig(params=SMALL))


def test_attribution_names_the_driver_of_the_forecast(spark, matrix):
    rows = matrix.withColumn("forecast_trip_count", F.col("trip_count") * 2)
    found = explain.fit_surrogate(matrix, rows, max_iter=10)
    told = explain.attribution(found, found.holdout)
    ranked = explain.global_importance(told).collect()
    assert found.fidelity_r2 > 0.8 and ranked[0]["feature"] in ("trip_count", "demand_per_minute")
    assert told.count() == found.holdout.count() * len(found.feature_names)
    few = explain.fit_surrogate(matrix, rows, sample=200, max_iter=5)
    assert few.holdout.count() > matrix.count() - 200
    assert explain.surrogate_fidelity(matrix.limit(20), None).first()["holdout_rows"] == 0
    assert explain.local_contributions(told, 3).groupBy("location_id", "window_start").count().where("count != 3").isEmpty()
    assert explain.fit_surrogate(matrix.limit(20), None) is None


def test_all_jobs_in_order(spark, tmp_path):
    rng = random.Random(3)
    lines = ["tpep_pickup_datetime,tpep_dropoff_datetime,PULocationID,DOLocationID,trip_distance,total_amount"]
    for hour in range(36):
        for _ in range(40):
            day, h = divmod(hour, 24)
            block = rng.randrange(2)
            a, b = (1 + block * 4 + rng.randrange(4) for _ in range(2))
            lines.append(f"2024-01-{day + 1:02d} {h:02d}:{rng.randrange(40):02d}:00,2024-01-{day + 1:02d} {h:02d}:55:00,{a},{b},1.0,10.0")
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "trips.csv").write_text("\n".join(lines) + "\nbad,row,1,2,3,4\n")
    root = str(tmp_path / "lake")
    cfg = jobs.JobConfig(
        root, folds=2, training=TrainConfig(params=SMALL),
        features=features.FeatureConfig(slide_seconds=900, window_seconds=900, lags=(1, 2), spans=(4,), daily_lag=False,
                                        weekly_lag=False, graph=features.CURRENT))
    with pytest.raises(ValueError, match="nothing was sent"):
        jobs.ingest_job(spark, cfg, str(raw), "yellow", tz="UTC", fail_fast=True)
    jobs.ingest_job(spark, cfg, str(raw), "yellow", tz="UTC", limit=5, sink={"path": str(tmp_path / "few")})
    assert spark.read.parquet(str(tmp_path / "few")).count() == 5
    jobs.ingest_job(spark, cfg, str(raw), "yellow", tz="UTC")
    assert spark.read.parquet(cfg.at("rejects")).first()["source_line"] == 36 * 40 + 2
    assert spark.read.parquet(cfg.at("rejects")).count() == 1
    assert spark.read.parquet(cfg.at("ingest_summary")).first()["rows_accepted"] == 36 * 40
    spark.createDataFrame([(z, f"Z{z}", "B1" if z < 5 else "B2", "Core") for z in range(1, 9)],
                          "location_id int, zone_name string, borough string, service_zone string").write.parquet(cfg.at("zones"))
    payloads = streams.read_event_stream(spark, {"path": cfg.at("events")})
    trips = streams.trip_stream(payloads)
    for start, name in ((streams.start_demand_query, "demand_windows"), (streams.start_flow_query, "zone_flows")):
        start(trips, cfg.at(name), cfg.at(f"checkpoints/{name}"), "update", NOW, "15 minutes", "15 minutes").awaitTermination()
    from dataclasses import replace
    import odflux.operators.projection as projection
    strong = replace(projection.COMMUNITY, min_trip_count=1)
    projection.COMMUNITY, kept = strong, projection.COMMUNITY
    try:
        jobs.graph_cycle(spark, cfg)
    finally:
        projection.COMMUNITY = kept
    zones = spark.read.parquet(cfg.at("zones"))
    assert zones.where("importance_rank is null or community_id is null").isEmpty()
    assert zones.groupBy("community_id").count().count() == 2
    jobs.training_cycle(spark, cfg)
    for _ in range(2):
        jobs.inference_cycle(spark, cfg)
    told = spark.read.parquet(cfg.at("forecasts"))
    assert told.count() == told.select("location_id", "target_window_start").distinct().count() == 8
    assert tables.path_exists(spark, cfg.at("graph_snapshots"))
