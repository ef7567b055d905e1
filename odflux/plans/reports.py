"""Read queries over the stored tables: one function per report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odflux.functions.columns import long_or_zero, or_zero
from odflux.sources.tables import ZONE_SCORES


def _text(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit("")).alias(name)


def _flag(name: str) -> Column:
    return F.coalesce(F.col(name).cast("boolean"), F.lit(False)).alias(name)


def window_bounds(windows: DataFrame) -> DataFrame:
    at = F.col("window_start")
    return windows.agg(F.max(at).alias("latest"), F.min(at).alias("earliest"), F.count(F.lit(1)).alias("window_count"))


def latest_window(windows: DataFrame) -> Column:
    return windows.agg(F.max("window_start").alias("latest")).scalar()


def zone_state(zones: DataFrame) -> DataFrame:
    """The zone list with its latest demand and scores; unknown text is blank, unknown numbers 0."""
    have = set(zones.columns)
    pick = lambda c: F.col(c) if c in have else F.lit(None)
    return zones.select(
        "location_id",
        *[F.coalesce(pick(c), F.lit("")).alias(c) for c in ("zone_name", "borough", "service_zone")],
        pick("latest_window_start").cast("long").alias("latest_window_start"),
        long_or_zero(pick("latest_trip_count")).alias("latest_trip_count"),
        or_zero(pick("latest_demand_per_minute")).alias("latest_demand_per_minute"),
        long_or_zero(pick("peak_trip_count")).alias("peak_trip_count"),
        *[or_zero(pick(c)).alias(c) for c in ZONE_SCORES if c != "importance_rank"],
        long_or_zero(pick("importance_rank")).alias("importance_rank"),
        F.coalesce(pick("community_id").cast("long"), F.lit(-1).cast("long")).alias("community_id"),
        pick("latitude").cast("double").alias("latitude"), pick("longitude").cast("double").alias("longitude"),
    ).orderBy("location_id")


def windows_since(windows: DataFrame, since: int) -> DataFrame:
    return windows.where(F.col("window_start") >= since).select(
        "location_id", "window_start", "window_end",
        *[long_or_zero(F.col(c)).alias(c) for c in ("trip_count", "passenger_total")],
        *[or_zero(F.col(c)).alias(c) for c in (
            "demand_per_minute", "total_revenue", "avg_speed_mph", "avg_trip_distance_miles",
            "avg_duration_seconds", "surge_ratio")],
        _flag("is_surge"),
    ).orderBy("window_start", "location_id")


def zone_history(windows: DataFrame, zone: int, since: int) -> DataFrame:
    mine = windows.where((F.col("location_id") == zone) & (F.col("window_start") >= since))
    return mine.select(
        "window_start", long_or_zero(F.col("trip_count")).alias("trip_count"),
        *[or_zero(F.col(c)).alias(c) for c in ("demand_per_minute", "baseline_demand_per_minute", "surge_ratio")],
        _flag("is_surge"),
    ).orderBy("window_start")


def zone_history_kpis(windows: DataFrame, zone: int, since: int) -> DataFrame:
    return zone_history(windows, zone, since).agg(
        F.avg("trip_count").alias("mean_trips"), F.max("trip_count").alias("peak_trips"),
        F.count_if("is_surge").alias("surging_windows"))


def dominant_flows(flows: DataFrame, zones: DataFrame, since: int, min_trips: int = 1, limit: int = 50) -> DataFrame:
    """Largest flows between different zones; the size filter applies to each windowed edge."""
    size = F.coalesce("trip_count", F.lit(0))
    pairs = (
        flows.where((F.col("window_start") >= since) & (size >= min_trips) & (F.col("origin_id") != F.col("destination_id")))
        .groupBy("origin_id", "destination_id").agg(
            F.sum("trip_count").cast("long").alias("trips"),
            or_zero(F.avg("avg_duration_seconds")).alias("avg_duration_seconds"),
            or_zero(F.avg("avg_trip_distance_miles")).alias("avg_distance_miles"))
    )
    have = set(zones.columns)

    def end(side: str) -> DataFrame:
        number = lambda c: (F.col(c) if c in have else F.lit(None)).cast("double")
        return zones.select(
            F.col("location_id").alias(f"{side}_id"), F.coalesce("zone_name", F.lit("")).alias(f"{side}_name"),
            F.coalesce("borough", F.lit("")).alias(f"{side}_borough"),
            number("latitude").alias(f"{side}_lat"), number("longitude").alias(f"{side}_lng"))

    return (
        pairs.join(end("origin"), "origin_id").join(end("destination"), "destination_id")
        .orderBy(F.desc("trips"), "origin_id", "destination_id").limit(limit)
    )


def mappable_flows(flows: DataFrame) -> DataFrame:
    """Flows whose two ends both have a position."""
    return flows.dropna(subset=["origin_lat", "origin_lng", "destination_lat", "destination_lng"])


def communities_view(communities: DataFrame) -> DataFrame:
    c = F.col
    spread = long_or_zero(c("borough_spread"))
    return communities.select(
        "community_id", long_or_zero(c("size")).alias("size"), or_zero(c("cohesion")).alias("cohesion"),
        _text("dominant_borough"), or_zero(c("dominant_borough_share")).alias("dominant_borough_share"),
        spread.alias("borough_spread"), long_or_zero(c("internal_trip_count")).alias("internal_trip_count"),
        long_or_zero(c("external_trip_count")).alias("external_trip_count"),
        (spread > 1).alias("crosses_boroughs"),
    ).orderBy(F.desc("size"), "community_id")


def forecasts_since(forecasts: DataFrame, zones: DataFrame, since: int) -> DataFrame:
    have = set(zones.columns)
    place = zones.select(
        "location_id", _text("zone_name"), _text("borough"),
        *[(F.col(c) if c in have else F.lit(None)).cast("double").alias(c) for c in ("latitude", "longitude")])
    return forecasts.where(F.col("target_window_start") >= since).join(place, "location_id").select(
        "location_id", "zone_name", "borough", "origin_window_start", "target_window_start",
        *[or_zero(F.col(c)).alias(c) for c in ("forecast_trip_count", "lower_bound", "upper_bound")],
        _text("model_version"), F.coalesce("horizon_slots", F.lit(0)).alias("horizon_slots"), "latitude", "longitude",
    ).orderBy("target_window_start", "location_id")


def _current(windows: DataFrame) -> DataFrame:
    return windows.where(F.col("window_start") == latest_window(windows))


def latest_kpis(windows: DataFrame) -> DataFrame:
    return _current(windows).agg(
        F.count_distinct("location_id").alias("active_zones"), F.sum("trip_count").cast("long").alias("trips"),
        F.sum("total_revenue").alias("revenue"), F.count_if(F.col("is_surge")).alias("surging_zones"),
        F.max("window_start").alias("latest_window_start"))


def citywide_series(windows: DataFrame) -> DataFrame:
    return windows.groupBy("window_start").agg(
        F.sum("trip_count").cast("long").alias("trip_count"), F.count_if(F.col("is_surge")).alias("surge_zones"),
        F.sum("total_revenue").alias("revenue")).orderBy("window_start")


def busiest_zones(windows: DataFrame, zones: DataFrame, limit: int = 12) -> DataFrame:
    return (
        _current(windows).orderBy(F.desc("trip_count"), "location_id").limit(limit)
        .join(zones.select("location_id", "zone_name", "borough"), "location_id", "left")
        .select("location_id", "zone_name", "borough", "trip_count", "demand_per_minute")
        .orderBy(F.desc("trip_count"), "location_id")
    )


def borough_share(windows: DataFrame, zones: DataFrame) -> DataFrame:
    joined = _current(windows).join(zones.select("location_id", "borough"), "location_id")
    return (joined.where(F.col("borough") != "").groupBy("borough")
            .agg(F.sum("trip_count").cast("long").alias("trip_count")).orderBy(F.desc("trip_count"), "borough"))


def demand_map(windows: DataFrame, zones: DataFrame, forecasts: DataFrame | None, slot: int | Column) -> DataFrame:
    """One window on the map, with the forecast made at that window and its difference to the count."""
    place = zone_state(zones).select("location_id", "zone_name", "borough", "latitude", "longitude",
                                     F.col("importance_score").alias("importance"), "community_id")
    rows = windows.where(F.col("window_start") == slot).join(place, "location_id", "left").dropna(
        subset=["latitude", "longitude"])
    if forecasts is None:
        rows = rows.withColumns({"forecast_trip_count": F.lit(0.0), "forecast_delta": F.lit(0.0)})
    else:
        told = forecasts.where(F.col("origin_window_start") == slot).select("location_id", "forecast_trip_count")
        rows = rows.join(told, "location_id", "left").fillna(0.0, ["forecast_trip_count"]).withColumn(
            "forecast_delta", F.col("forecast_trip_count") - F.col("trip_count"))
    return rows.select(
        "location_id", "zone_name", "borough", "latitude", "longitude", "trip_count", "demand_per_minute",
        "total_revenue", "surge_ratio", "is_surge", "importance", "community_id", "forecast_trip_count", "forecast_delta")


def forecast_movements(map_rows: DataFrame, limit: int = 10) -> DataFrame:
    return map_rows.select("location_id", "zone_name", "borough", "trip_count", "forecast_trip_count", "forecast_delta") \
        .orderBy(F.desc("forecast_delta"), "location_id").limit(limit)


def importance_top(zones: DataFrame, limit: int = 15) -> DataFrame:
    return zone_state(zones).select(
        "location_id", "zone_name", "borough", "importance_score", "page_rank_score", "betweenness_score",
        "corridor_bias").orderBy(F.desc("importance_score"), "location_id").limit(limit)


def centrality_scatter(zones: DataFrame) -> DataFrame:
    return zone_state(zones).where(F.col("importance_score") > 0).select(
        "location_id", "zone_name", "borough", "page_rank_score", "betweenness_score", "latest_trip_count")


def local_labels(windows: DataFrame, tz: str = "America/New_York") -> DataFrame:
    """Each window start with its local time and clock label."""
    local = F.from_utc_timestamp(F.timestamp_millis("window_start"), tz)
    return windows.select("window_start").distinct().select(
        "window_start", F.date_format(local, "yyyy-MM-dd HH:mm:ss").alias("local_time"),
        F.date_format(local, "HH:mm").alias("label"))
