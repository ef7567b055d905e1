"""Quantiles by rank, trailing statistics by doubling, mixed trip files, stored scalers: against plain versions."""

import random
import statistics

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from odflux.operators import features, forecast, projection
from odflux.operators.quantiles import exact_quantiles
from odflux.sources.trip_files import scan_trip_csv

PROBS = [0.0, 0.05, 0.25, 1 / 3, 0.5, 0.9, 0.999, 1.0]


@pytest.mark.parametrize("values", [
    [3.0], [1.0, 2.0], [7.0] * 500 + [1.0, 9.0], [random.Random(1).gauss(0, 5) for _ in range(5_000)],
    [float(random.Random(k).randint(0, 9)) for k in range(999)]], ids=["one", "two", "hot", "spread", "ties"])
def test_quantiles_equal_numpy(spark, values):
    frame = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double").repartition(3)
    got = exact_quantiles(frame, F.col("x"), PROBS).first()["q"]
    assert got == pytest.approx(np.quantile(values, PROBS).tolist(), abs=1e-9)


def test_quantiles_of_nothing_and_bad_probabilities(spark):
    empty = spark.createDataFrame([(None,)], "x double")
    assert exact_quantiles(empty, F.col("x"), [0.1, 0.5]).first()["q"] == [None, None]
    row = projection.distribution(empty, "x", exact=True).first()
    assert row["p50"] is None and row["mean"] is None
    for bad in ([], [1.5]):
        with pytest.raises(ValueError):
            exact_quantiles(empty, F.col("x"), bad)


@pytest.mark.parametrize("spans", [(2,), (6, 12, 36), (3, 5, 7, 64), ()])
def test_trailing_statistics_equal_a_plain_scan(spark, spans):
    draw = random.Random(len(spans))
    rows = [(z, t * 300_000, float(draw.choice([0, 0, 1, 5, 40]))) for z in range(3) for t in range(100 if z else 1)]
    frame = spark.createDataFrame(rows, "location_id int, window_start long, trip_count double").repartition(4)
    got = features.rolling_features(frame, spans)
    assert got.columns == ["location_id", "window_start", "trip_count"] + [
        f"trip_count_{f}_{n}" for n in spans for f in ("mean", "stddev", "max", "min", "trend")]
    series = {}
    for z, t, v in rows:
        series.setdefault(z, []).append(v)
    for r in got.collect():
        at = r.window_start // 300_000
        for n in spans:
            past = series[r.location_id][max(0, at - n):at]
            mean = sum(past) / len(past) if past else 0.0
            want = [mean, statistics.stdev(past) if len(past) > 1 else 0.0, max(past, default=0.0), min(past, default=0.0), r.trip_count - mean]
            assert [r[f"trip_count_{f}_{n}"] for f in ("mean", "stddev", "max", "min", "trend")] == pytest.approx(want, abs=1e-9)


def test_trailing_statistics_do_not_scan_their_span(spark):
    frame = spark.createDataFrame([(1, 0, 1.0)], "location_id int, window_start long, trip_count double")
    plan = features.rolling_features(frame, (36, 288))._jdf.queryExecution().executedPlan().toString()
    assert "stddev_samp" not in plan and "-36" not in plan.replace("lag", "")
    assert plan.count("Exchange hashpartitioning") == 1


def test_files_of_several_spellings_are_numbered_in_one_read(spark, tmp_path):
    draw = random.Random(5)
    spellings = [["tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID", "DOLocationID", "trip_distance", "total_amount", "note"],
                 ["Total Amount", "Trip_Distance", "DO Location ID", "PU_Location_ID", "Pickup Date", "Dropoff Date"]]
    truth = []
    for f in range(5):
        header = spellings[f % 2]
        lines = [",".join(header)]
        for k in range(draw.randint(0, 400)):
            if draw.random() < 0.1:
                lines.append("")
                continue
            cells = {"pickup": f"p{f}-{k}", "dropoff": '"a, b"', "pu": str(k), "do": "2", "dist": "1.5", "total": "x"}
            order = ["pickup", "dropoff", "pu", "do", "dist", "total"] if f % 2 == 0 else ["total", "dist", "do", "pu", "pickup", "dropoff"]
            lines.append(",".join(cells[c] for c in order) + (",more" if f % 2 == 0 else ""))
            truth.append((f"t{f}.csv", len(lines), f"p{f}-{k}", "a, b", str(k), "2", "1.5", "x"))
        day = tmp_path / f"day={f % 3}"
        day.mkdir(exist_ok=True)
        (day / f"t{f}.csv").write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")  # several splits a file
    try:
        rows = scan_trip_csv(spark, str(tmp_path / "day=*")).select(
            "source_file", "source_line", "pickup_datetime", "dropoff_datetime", "pickup_location_id", "dropoff_location_id",
            "trip_distance", "total_amount").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(map(tuple, rows)) == sorted(truth)
    with pytest.raises(FileNotFoundError):
        scan_trip_csv(spark, str(tmp_path / "none=*"))


def _matrix(spark):
    draw = random.Random(8)
    rows = [(z, t * 300_000, float(z * 50 + draw.randint(0, 20)), draw.random() * 1_000) for z in range(3) for t in range(150)]
    frame = spark.createDataFrame(rows, "location_id int, window_start long, trip_count double, other double")
    return features.target_label(features.lag_features(frame.withColumn("demand_per_minute", F.col("trip_count") / 15), (1,)), 3)


def test_one_row_is_scored_as_among_all(spark, tmp_path):
    rows = _matrix(spark)
    cfg = forecast.TrainConfig(params={"maxIter": 5, "maxDepth": 3}, scale=True)
    model = forecast.train(rows, cfg)
    assert model.feature_names == features.feature_names(rows)
    forecast.save_model(model, str(tmp_path / "m"), "v1")
    again = forecast.load_model(str(tmp_path / "m"))
    assert again.config.scale
    among = {(r.location_id, r.window_start): r.prediction for r in forecast.score(model, rows).collect()}
    for r in rows.orderBy("window_start", "location_id").limit(5).collect():
        alone = rows.where((F.col("location_id") == r.location_id) & (F.col("window_start") == r.window_start))
        assert forecast.score(again, alone).first().prediction == among[r.location_id, r.window_start]


def test_a_fitted_scaler_is_applied_not_fitted_again(spark):
    rows = _matrix(spark)
    scaler = features.fit_scaler(rows)
    one = rows.limit(1)
    whole = {(r.location_id, r.window_start): r.x for r in features.assemble_vector(rows, scaler=scaler).select(
        "location_id", "window_start", vector_to_array("scaled_features").alias("x")).collect()}
    r = features.assemble_vector(one, scaler=scaler).select("location_id", "window_start", vector_to_array("scaled_features").alias("x")).first()
    assert r.x == whole[r.location_id, r.window_start] and any(abs(v) > 0.1 for v in r.x)


def test_grid_search_equals_one_run_after_the_other(spark):
    rows = _matrix(spark)
    cfgs = [forecast.TrainConfig(params={"maxIter": 2, "maxDepth": d}) for d in (1, 3, 5)]
    side_by_side = forecast.grid_search(rows, cfgs, folds=2, at_once=4)
    alone = {cfg.describe(): forecast.validation_report(forecast.walk_forward_validate(rows, cfg, 2, at_once=1)).first() for cfg in cfgs}
    assert [tuple(report.first()) for _, report in side_by_side] == sorted(
        (tuple(alone[cfg.describe()]) for cfg, _ in side_by_side), key=lambda t: t[1])
    assert len(forecast.boosted_grid()) == 6 and len(forecast.forest_grid()) == 4 and len(forecast.family_grid()) == 2
    with pytest.raises(ValueError):
        forecast.grid_search(rows, [])
