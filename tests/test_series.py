"""Slots written inside Arrow batches against the window expressions over a filled grid."""

import random

from pyspark.sql import functions as F

from odflux.operators import features
from registry.queries import rounded
from tests.test_features import BASE, SLIDE, WIDTH, demand, zones

ROWS = [(z, s, random.Random(31 * z + s).randint(1, 9)) for z in range(1, 8) for s in range(60) if random.Random(97 * z + s).random() < 0.4]


def _same(left, right):
    assert left.columns == right.columns
    near = lambda df: sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())
    assert near(left) == near(right)


def test_series_agree_with_windows_over_the_grid_also_when_batches_cut_zones(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        frame, known = demand(spark, ROWS), zones(spark, *range(1, 7))
        grid = features.complete_grid(frame, known, SLIDE, WIDTH)
        plain = features.seasonal_lags(features.lag_features(features.rolling_features(grid, (2, 5, 16)), (1, 3)), 8)
        got = features.on_grid(frame, known, SLIDE, WIDTH, lags=(1, 3), seasons={"day": 8, "week": 56}, spans=(2, 5, 16), horizon=2)
        _same(got, features.target_label(plain, 2))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_rows_beside_slots_and_snapshots_agree_with_joins(spark):
    frame, known = demand(spark, ROWS), zones(spark, *range(1, 7))
    beside = spark.createDataFrame([(1, BASE, 2.0), (1, BASE + 7 * SLIDE, 3.0), (4, BASE + 59 * SLIDE, None), (5, BASE + 1, 9.0),
                                    (6, BASE - SLIDE, 9.0), (9, BASE, 9.0)], "location_id int, window_start long, inbound_trip_count double")
    marks = spark.createDataFrame([(1, BASE - 1, 1.0, 5), (1, BASE + 3 * SLIDE, None, 6), (2, BASE + 10 * SLIDE, 4.0, None), (2, BASE + 10 * SLIDE, 4.0, 7),
                                   (9, BASE, 1.0, 1)], "location_id int, snapshot_start long, page_rank_score double, community_id long")
    got = features.on_grid(frame, known, SLIDE, WIDTH, keep=["trip_count"], beside=beside, snapshots=marks)
    grid = features.complete_grid(frame, known, SLIDE, WIDTH).select("location_id", "window_start", "window_end", "trip_count")
    wanted = features.asof_snapshots(grid, marks).join(beside, ["location_id", "window_start"], "left").fillna(0.0, ["inbound_trip_count"])
    _same(got, wanted)


def test_filled_grid_is_neither_sorted_nor_shuffled(spark):
    got = features.on_grid(demand(spark, ROWS), zones(spark, 1, 2), SLIDE, WIDTH, lags=(1,), spans=(6,), horizon=1)
    plan = got._jdf.queryExecution().executedPlan().toString()
    above = plan.split("MapInArrow")[0]
    assert "MapInArrow" in plan and not any(step in above for step in ("Sort", "Exchange", "Window", "Generate"))


def test_rounding_is_that_of_round(spark):
    values = [0.0, -0.0, 3.0, -7.0, 0.1234565, -2.5000005, 1e20, float("inf"), float("-inf"), float("nan"), None, -1e-9, 4e-7]
    draw = random.Random(5)
    values += [draw.uniform(-1, 1) * 10 ** draw.randint(-8, 9) for _ in range(2_000)]
    values += [draw.randint(-10 ** 8, 10 ** 8) / 2e6 for _ in range(2_000)]  # many of them ties
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    told = frame.select(F.round("v", 6).alias("v"))
    assert [str(r[0]) for r in rounded(frame).collect()] == [str(r[0]) for r in told.collect()]
