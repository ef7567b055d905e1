"""Derived columns and dimensions of the demand tables, recomputed from the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from odflux.functions.columns import or_zero

QUARANTINE_REASON = "location_id_out_of_tlc_range"


def _by_time():
    """One zone's windows in order; at most one row per slot, so a partition is bounded by the calendar."""
    return Window.partitionBy("location_id").orderBy("window_start")


def derive_window_end(windows: DataFrame) -> DataFrame:
    derived = F.col("window_start") + F.col("window_seconds").cast("long") * F.lit(1000)
    return windows.withColumn("window_end", F.coalesce("window_end", derived))


def complete_zone_dim(zones: DataFrame, windows: DataFrame) -> DataFrame:
    """Zones plus a bare row for every zone id seen only in windows."""
    seen = windows.select("location_id").where(F.col("location_id").isNotNull()).distinct()
    return zones.unionByName(seen.join(zones, "location_id", "left_anti"), allowMissingColumns=True)


def window_chain(windows: DataFrame) -> DataFrame:
    """Start of the nearest earlier and later window of the same zone."""
    w = _by_time()
    return windows.select(
        "location_id", "window_start",
        F.lag("window_start").over(w).alias("previous_window_start"),
        F.lead("window_start").over(w).alias("next_window_start"),
    )


def zone_rollup(windows: DataFrame) -> DataFrame:
    """Latest window, its demand, the peak and the number of windows, per zone."""
    newest = F.col("window_start")
    return windows.groupBy("location_id").agg(
        F.max(newest).alias("latest_window_start"),
        F.max_by("trip_count", newest).alias("latest_trip_count"),
        F.max_by("demand_per_minute", newest).alias("latest_demand_per_minute"),
        F.max("trip_count").alias("peak_trip_count"),
        F.count(F.lit(1)).alias("observed_window_count"),
    )


def surge_score(windows: DataFrame, span: int = 12, min_samples: int = 4, factor: float = 1.75) -> DataFrame:
    """Each window against the mean of up to ``span`` windows before it in its zone."""
    rate = F.col("demand_per_minute")
    known = windows.where(rate.isNotNull())
    before = _by_time().rowsBetween(-span, -1)
    return known.select(
        "*",
        or_zero(F.avg(rate).over(before)).alias("baseline_demand_per_minute"),
        F.count(rate).over(before).alias("baseline_sample_size"),
    ).select(
        "*",
        F.when(F.col("baseline_demand_per_minute") > 0, rate / F.col("baseline_demand_per_minute"))
        .otherwise(0.0).alias("surge_ratio"),
        ((F.col("baseline_demand_per_minute") > 0) & (F.col("baseline_sample_size") >= min_samples)
         & (rate >= F.col("baseline_demand_per_minute") * F.lit(factor))).alias("is_surge"),
    )


def borough_dim(zones: DataFrame) -> DataFrame:
    return zones.where(F.trim("borough") != "").select("borough").distinct()


def zone_borough(zones: DataFrame) -> DataFrame:
    """Zone-to-borough membership rows."""
    return zones.where(F.trim("borough") != "").select("location_id", "borough")


def classify_flows(flows: DataFrame) -> DataFrame:
    """Marks trips that stay in their zone and the span of the flow's window."""
    return flows.withColumns({
        "is_internal": F.col("origin_id") == F.col("destination_id"),
        "window_span_seconds": F.floor((F.col("window_end") - F.col("window_start")) / F.lit(1000)).cast("long"),
    })


def quarantine_zones(zones: DataFrame, lo: int = 1, hi: int = 265) -> DataFrame:
    """Keeps every zone; those outside ``lo..hi`` carry the flag and the reason."""
    outside = F.coalesce(~F.col("location_id").between(lo, hi), F.lit(False))
    return zones.withColumns({
        "is_quarantined": outside,
        "quarantine_reason": F.when(outside, F.lit(QUARANTINE_REASON)),
    })
