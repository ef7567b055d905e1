import math

import pytest
from pyspark.sql import functions as F

from odflux.operators import features
from odflux.operators.features import CARRIED_INTO_EMPTY_SLOT, ZERO_IN_EMPTY_SLOT

BASE, SLIDE, WIDTH = 1_600_000_000_000, 300_000, 900_000


def demand(spark, rows):
    """rows: (zone, slot, trips); slots are relative to a base that no slide divides."""
    names = ["location_id", "window_start", "window_end", *ZERO_IN_EMPTY_SLOT, *CARRIED_INTO_EMPTY_SLOT]
    kinds = ["int", "long", "long"] + ["double"] * (len(names) - 3)
    data = [(z, BASE + s * SLIDE, None if s % 2 else BASE + s * SLIDE + WIDTH, *[float(t)] * 6, 0.0,
             *[float(10 + s)] * 6) for z, s, t in rows]
    return spark.createDataFrame(data, ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))


def zones(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "location_id int")


def slots(frame, column):
    rows = frame.orderBy("location_id", "window_start").select("location_id", "window_start", column).collect()
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r[2])
    return out


SPARSE = [(1, 0, 4), (1, 1, 5), (1, 3, 7), (1, 5, 9), (2, 0, 1), (2, 5, 2)]


def test_grid_has_every_slot_of_every_zone(spark):
    grid = features.complete_grid(demand(spark, SPARSE), zones(spark, 1, 2), SLIDE, WIDTH)
    assert slots(grid, "trip_count") == {1: [4, 5, 0, 7, 0, 9], 2: [1, 0, 0, 0, 0, 2]}
    assert slots(grid, "avg_speed_mph")[1] == [10, 11, 11, 13, 13, 15]
    assert grid.where(F.col("window_end") != F.col("window_start") + WIDTH).isEmpty()


def test_grid_leads_in_with_zeros_and_drops_thin_and_unknown_zones(spark):
    rows = SPARSE + [(3, 3, 8), (3, 4, 8), (4, 2, 1), (9, 1, 1), (9, 2, 1)]
    grid = features.complete_grid(demand(spark, rows), zones(spark, 1, 2, 3, 4), SLIDE, WIDTH, min_observed=2)
    assert slots(grid, "trip_count")[3] == [0, 0, 0, 8, 8, 0]
    assert slots(grid, "avg_speed_mph")[3] == [0, 0, 0, 13, 14, 14]
    assert set(slots(grid, "trip_count")) == {1, 2, 3}


def test_empty_demand_gives_an_empty_grid(spark):
    assert features.complete_grid(demand(spark, SPARSE).limit(0), zones(spark, 1), SLIDE, WIDTH).isEmpty()


def test_lags_stay_in_their_zone(spark):
    grid = features.complete_grid(demand(spark, SPARSE), zones(spark, 1, 2), SLIDE, WIDTH)
    got = slots(features.lag_features(grid, (1, 2)), "trip_count_lag_1")
    assert got == {1: [0, 4, 5, 0, 7, 0], 2: [0, 1, 0, 0, 0, 0]}


def test_trailing_statistics_never_see_the_current_row(spark):
    rows = [(1, s, 100 if s == 8 else 2) for s in range(10)]
    grid = features.complete_grid(demand(spark, rows), zones(spark, 1), SLIDE, WIDTH)
    rolled = features.rolling_features(grid, (6,))
    assert slots(rolled, "trip_count_max_6")[1] == [0, 2, 2, 2, 2, 2, 2, 2, 2, 100]
    assert slots(rolled, "trip_count_trend_6")[1][8] == 98


def test_target_and_trim(spark):
    rows = [(1, s, s) for s in range(10)]
    grid = features.complete_grid(demand(spark, rows), zones(spark, 1), SLIDE, WIDTH)
    labelled = features.target_label(grid, 3)
    assert slots(labelled, "target_trip_count")[1] == [3, 4, 5, 6, 7, 8, 9]
    assert slots(features.trim_warm_up(labelled, 4, SLIDE), "trip_count")[1] == [4, 5, 6]


def test_split_keeps_an_embargo(spark):
    rows = demand(spark, [(1, s, 1) for s in range(101)])
    train, holdout = features.chronological_split(rows, 0.8, 3 * SLIDE)
    assert train.agg(F.max("window_start")).first()[0] == BASE + 79 * SLIDE
    assert holdout.agg(F.min("window_start")).first()[0] == BASE + 83 * SLIDE


def test_calendar_follows_daylight_saving(spark):
    # 2024-03-10 06:59 and 07:01 UTC lie either side of the spring change in New York
    rows = spark.createDataFrame([(1710053940000,), (1710054060000,)], "window_start long")
    got = features.calendar_features(rows).orderBy("window_start").collect()
    assert [r["hour_of_day"] for r in got] == [1.0, 3.0]
    assert got[0]["day_of_week"] == 0.0 and got[0]["is_weekend"] == 1.0
    assert math.isclose(got[1]["hour_sin"], math.sin(2 * math.pi * 181 / 1440))


def test_snapshot_of_the_past_only(spark):
    rows = spark.createDataFrame([(1, 5), (1, 10), (1, 25), (2, 50)], "location_id int, window_start long")
    marks = spark.createDataFrame([(1, 0.1, 7, 10), (1, 0.2, 8, 20)],
                                  "location_id int, page_rank_score double, community_id long, snapshot_start long")
    got = {(r[0], r[1]): (r[2], r[3]) for r in features.asof_snapshots(rows, marks).collect()}
    assert got == {(1, 5): (0.0, -1), (1, 10): (0.1, 7), (1, 25): (0.2, 8), (2, 50): (0.0, -1)}


def test_null_feature_is_an_error_and_names_are_sorted(spark):
    rows = spark.createDataFrame([(1, 1, 2.0, 1.0), (1, 2, None, 1.0)], "location_id int, window_start long, b double, a double")
    assert features.feature_names(rows) == ["a", "b"]
    with pytest.raises(Exception):
        features.assemble_vector(rows).select("features").collect()


@pytest.mark.parametrize("bad", [{"lags": ()}, {"lags": (1, 1)}, {"spans": (1,)}, {"horizon": 0}, {"graph": "x"},
                                 {"window_seconds": 60}, {"slide_seconds": 700}])
def test_bad_settings_are_refused(bad):
    with pytest.raises(ValueError):
        features.FeatureConfig(**bad)


def test_a_zone_off_the_grid_has_empty_slots(spark):
    odd = demand(spark, [(1, 0, 4), (1, 2, 5), (2, 1, 9)]).withColumn(
        "window_start", F.when(F.col("location_id") == 2, F.col("window_start") + 7).otherwise(F.col("window_start")))
    grid = features.complete_grid(odd, zones(spark, 1, 2), SLIDE, WIDTH)
    assert slots(grid, "trip_count") == {1: [4, 0, 5], 2: [0, 0, 0]}
    assert slots(grid, "avg_speed_mph")[2] == [0, 0, 0]


def test_matrix_without_a_graph_layer(spark):
    cfg = features.FeatureConfig(lags=(1,), spans=(2,), daily_lag=False, weekly_lag=False, horizon=1, graph=features.CURRENT)
    sources = features.FeatureSources(demand(spark, SPARSE), zones(spark, 1, 2))
    for graph in (features.CURRENT, features.SNAPSHOTS):
        from dataclasses import replace
        got = features.training_matrix(sources, replace(cfg, graph=graph)).collect()
        assert got and all(r.community_id == -1 and r.page_rank_score == 0 and r.inbound_trip_count == 0 for r in got)


def test_calendar_of_a_slot_is_not_worked_out_row_by_row(spark):
    cfg = features.FeatureConfig(lags=(1,), spans=(2,), daily_lag=False, weekly_lag=False, horizon=1, graph=features.CURRENT)
    matrix = features.inference_matrix(features.FeatureSources(demand(spark, SPARSE), zones(spark, 1, 2)), cfg, BASE + 5 * SLIDE, 2)
    assert "from_utc_timestamp" not in matrix._jdf.queryExecution().optimizedPlan().toString()
    plain = features.calendar_features(matrix.select("location_id", "window_start"))
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, matrix.select(*plain.columns).collect())) and plain.count() == 4


def test_wide_steps_of_queries_are_split_into_methods_the_jvm_compiles(spark):
    from registry.queries import Given

    before = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    try:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
        Given(spark, "/root/testdata/sf0.001")
        assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000
    finally:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", before)
