"""Sliding-window demand per zone and flow per zone pair.

Batch frames are first folded to *panes*: one row per (pickup, dropoff, pane),
where the pane is the greatest length that tiles both window and slide. Every
trip is therefore touched once, however many windows cover it, and only the
folded panes are fanned out. A zone holding a third of all trips folds map-side.
Streams aggregate with the built-in ``window`` so the watermark bounds state.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odflux.functions.columns import interval_millis, or_zero, round_dp

_AVERAGED = ["trip_distance_miles", "trip_duration_seconds", "average_speed_mph", "fare_amount"]
_TOTALLED = ["total_amount", "tip_amount"]
WIDTH, SLIDE = "15 minutes", "5 minutes"


def _lengths(width: str, slide: str) -> tuple[int, int]:
    width_ms, slide_ms = interval_millis(width), interval_millis(slide)
    if slide_ms > width_ms:
        raise ValueError("slide must not exceed the window width")
    return width_ms, slide_ms


def _folds() -> list[Column]:
    """Sums and counts: the mergeable form of every count, total and average."""
    out = [
        F.count(F.lit(1)).alias("n"),
        F.sum(F.coalesce(F.col("passenger_count"), F.lit(0)).cast("long")).alias("passengers"),
    ]
    for name in _AVERAGED:
        value = F.col(name).cast("double")
        out += [F.sum(value).alias(f"sum_{name}"), F.count(value).alias(f"cnt_{name}")]
    return out + [F.sum(or_zero(F.col(name))).alias(f"sum_{name}") for name in _TOTALLED]


def _refolds() -> list[Column]:
    names = ["n", "passengers"] + [f"{p}_{c}" for c in _AVERAGED for p in ("sum", "cnt")]
    return [F.sum(c).alias(c) for c in names + [f"sum_{c}" for c in _TOTALLED]]


def flow_panes(trips: DataFrame, pane_ms: int) -> DataFrame:
    """Trips folded to one row per (pickup, dropoff, pane)."""
    start = F.col("pickup_epoch_millis")
    return trips.groupBy(
        F.col("pickup_location_id"), F.col("dropoff_location_id"),
        (start - F.pmod(start, F.lit(pane_ms))).alias("pane_start"),
    ).agg(*_folds())


def _windows_of(panes: DataFrame, width_ms: int, slide_ms: int, pane_ms: int) -> DataFrame:
    """Each pane once per window covering it; window starts are multiples of the slide."""
    pane = F.col("pane_start")
    latest = pane - F.pmod(pane, F.lit(slide_ms))
    bound = pane + F.lit(pane_ms - width_ms)
    earliest = bound + F.pmod(-bound, F.lit(slide_ms))
    return panes.withColumn("window_start", F.explode(F.sequence(earliest, latest, F.lit(slide_ms))))


def _mean(name: str, places: int) -> Column:
    average = F.try_divide(F.col(f"sum_{name}"), F.col(f"cnt_{name}").cast("double"))
    return F.coalesce(round_dp(average, places), F.lit(0.0))


def _demand_columns(width_ms: int) -> list[Column]:
    per_minute = F.col("n").cast("double") / F.lit(max(1.0, width_ms / 60_000)).cast("double")
    return [
        F.col("pickup_location_id").cast("int").alias("location_id"),
        F.col("window_start"),
        (F.col("window_start") + F.lit(width_ms)).alias("window_end"),
        F.lit(width_ms // 1000).cast("long").alias("window_seconds"),
        F.col("n").cast("long").alias("trip_count"),
        F.col("passengers").cast("long").alias("passenger_total"),
        per_minute.alias("demand_per_minute"),
        _mean("trip_distance_miles", 4).alias("avg_trip_distance_miles"),
        _mean("trip_duration_seconds", 2).alias("avg_duration_seconds"),
        _mean("average_speed_mph", 3).alias("avg_speed_mph"),
        _mean("fare_amount", 4).alias("avg_fare_amount"),
        round_dp(F.col("sum_total_amount"), 2).alias("total_revenue"),
        round_dp(F.col("sum_tip_amount"), 2).alias("total_tips"),
        F.col("destinations").cast("long").alias("distinct_destinations"),
    ]


def _flow_columns(width_ms: int) -> list[Column]:
    return [
        F.col("pickup_location_id").cast("int").alias("origin_id"),
        F.col("dropoff_location_id").cast("int").alias("destination_id"),
        F.col("window_start"),
        (F.col("window_start") + F.lit(width_ms)).alias("window_end"),
        F.col("n").cast("long").alias("trip_count"),
        _mean("trip_duration_seconds", 2).alias("avg_duration_seconds"),
        _mean("trip_distance_miles", 4).alias("avg_trip_distance_miles"),
        _mean("average_speed_mph", 3).alias("avg_speed_mph"),
        round_dp(F.col("sum_total_amount"), 2).alias("total_revenue"),
    ]


def _aggregate(trips: DataFrame, keys: list[str], width: str, slide: str, extra: list[Column],
               sketched: bool = False) -> DataFrame:
    width_ms, slide_ms = _lengths(width, slide)
    if trips.isStreaming:
        bucket = F.window("pickup_time", width, slide)
        grouped = trips.groupBy(bucket.alias("w"), *keys).agg(*_folds(), *extra)
        return grouped.select("*", F.unix_millis("w.start").alias("window_start"))
    pane_ms = gcd(width_ms, slide_ms)
    spread = _windows_of(flow_panes(trips, pane_ms), width_ms, slide_ms, pane_ms)
    if sketched:
        # A sketch has 416 bytes, so tables of them are built once, behind the shuffle, in tasks that are not merged.
        places = int(trips.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        spread = spread.repartition(places, "window_start", *keys)
    return spread.groupBy("window_start", *keys).agg(*_refolds(), *extra)


def demand_windows(trips: DataFrame, width: str = WIDTH, slide: str = SLIDE,
                   exact_distinct: bool = False) -> DataFrame:
    """Demand per (pickup zone, window). ``slide == width`` gives tumbling windows."""
    target = F.col("dropoff_location_id")
    counted = F.count_distinct(target) if exact_distinct and not trips.isStreaming else F.approx_count_distinct(target)
    folded = _aggregate(trips, ["pickup_location_id"], width, slide, [counted.alias("destinations")], sketched=not exact_distinct)
    return folded.select(*_demand_columns(interval_millis(width)))


def zone_flows(trips: DataFrame, width: str = WIDTH, slide: str = SLIDE) -> DataFrame:
    """Flow per (pickup zone, dropoff zone, window)."""
    folded = _aggregate(trips, ["pickup_location_id", "dropoff_location_id"], width, slide, [])
    return folded.select(*_flow_columns(interval_millis(width)))
