"""Keyed Parquet tables: replay-safe upserts, typed loads, feature store, snapshots.

A table is a Parquet folder partitioned by one slot column. An upsert reads and
rewrites only the partitions the incoming rows touch. The merged rows are first
written to ``<path>__staged``, the incoming ones as they are worked out and then the
stored ones that stay, and the table is overwritten from there, so no job
ever overwrites what it is reading. A finished staged copy that is still there
when a writer begins means that the writer before died while it moved the copy in:
the move is done again first, before anything is read. One writer per table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from odflux.functions.columns import day_slot, half_open, long_or_zero, or_zero

PARTITION = "window_day"

# Stored zone scores and the stored community figures.
ZONE_SCORES = ["page_rank_score", "betweenness_score", "importance_score", "importance_rank", "corridor_bias"]
COMMUNITY_FIGURES = ["community_size", "community_cohesion"]
DEMAND_COLUMNS = [
    "trip_count", "passenger_total", "demand_per_minute", "avg_trip_distance_miles",
    "avg_duration_seconds", "avg_speed_mph", "avg_fare_amount", "total_revenue", "total_tips",
    "distinct_destinations", "surge_ratio", "baseline_demand_per_minute",
]


def path_exists(spark: SparkSession, path: str) -> bool:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)


def latest_per_key(rows: DataFrame, keys: list[str], order_col: str | None) -> DataFrame:
    """One row per key: the greatest ``order_col``, ties and rows without one settled by the other values."""
    rest = [c for c in rows.columns if c not in keys]
    if not rest:
        return rows.distinct()
    newest = F.max(F.struct(*[c for c in rest if c == order_col], *[c for c in rest if c != order_col]))
    return rows.groupBy(*keys).agg(newest.alias("_row")).select(*keys, "_row.*").select(*rows.columns)


def merge_rows(existing: DataFrame, incoming: DataFrame, keys: list[str], staying: bool = False) -> DataFrame:
    """Incoming rows win; existing rows whose key is not incoming stay, and only those are returned if ``staying``."""
    kept = existing.join(incoming.select(*keys), keys, "left_anti")
    return kept if staying else kept.unionByName(incoming, allowMissingColumns=True)


def upsert_outcome(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """How many incoming keys are new, change a stored row, or repeat it."""
    shared = [c for c in incoming.columns if c not in keys and c in existing.columns]
    digest = F.xxhash64(*shared) if shared else F.lit(0)
    old = existing.select(*keys, F.lit(True).alias("_old"), digest.alias("_old_hash"))
    new = incoming.select(*keys, F.lit(True).alias("_new"), digest.alias("_new_hash"))
    both = old.join(new, keys, "full_outer")
    is_old, is_new = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    return both.agg(
        F.count_if(is_new).alias("rows_written"),
        F.count_if(is_new & ~is_old).alias("rows_created"),
        F.count_if(is_new & is_old & (F.col("_old_hash") != F.col("_new_hash"))).alias("rows_updated"),
        F.count_if(is_new & is_old & (F.col("_old_hash") == F.col("_new_hash"))).alias("rows_unchanged"),
        F.count_if(is_old & ~is_new).alias("rows_untouched"),
    )


def upsert(df: DataFrame, path: str, keys: list[str], order_col: str | None = None,
           partition: str = PARTITION) -> None:
    """Last-write-wins merge of ``df`` into the table at ``path``, partition by partition."""
    spark = df.sparkSession
    finish_move(spark, path, partition)
    incoming = latest_per_key(df, keys, order_col)
    if not path_exists(spark, path):
        incoming.write.mode("overwrite").parquet(_staged(path))
        finish_move(spark, path, partition)
        return
    table = spark.read.parquet(path)
    own = lambda frame: {c: t for c, t in frame.dtypes if c != partition}
    if own(table) != own(incoming):
        shaped = table.limit(0).unionByName(incoming, allowMissingColumns=True).schema
        incoming = incoming.select(*[(F.col(f.name) if f.name in incoming.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in shaped])
    # Worked out once; without the mark of a finished write, which the rows that stay bring with them.
    incoming.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(_staged(path))
    written = spark.read.schema(incoming.schema).parquet(_staged(path))
    # The slots of a batch are few, and as literals they reach the partition filter of the scan.
    touched = [r[0] for r in written.select(partition).distinct().collect()]
    slot = F.col(partition)
    known = slot.isin([t for t in touched if t is not None])
    existing = table.where(known | slot.isNull() if None in touched else known)
    kept = merge_rows(existing, written, keys, True)
    kinds = dict(incoming.dtypes)
    kept.select(*[(F.col(c) if c in table.columns else F.lit(None)).cast(t).alias(c) for c, t in kinds.items()]).write.mode("append").parquet(_staged(path))
    finish_move(spark, path, partition)


def _staged(path: str) -> str:
    return f"{path}__staged"


def finish_move(spark: SparkSession, path: str, partition: str | None = None) -> None:
    """Move a finished staged copy into the table and remove it; doing so twice changes nothing."""
    staged = _staged(path)
    if not path_exists(spark, f"{staged}/_SUCCESS"):
        return
    rows = spark.read.parquet(staged)
    if partition is None:
        rows.write.mode("overwrite").parquet(path)
    else:
        # REBALANCE: one writer per small slot, several for a slot that holds much of the data.
        (rows.hint("rebalance", F.col(partition)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path))
    location = spark._jvm.org.apache.hadoop.fs.Path(staged)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)


def with_day(df: DataFrame, millis: str = "window_start") -> DataFrame:
    return df if PARTITION in df.columns else df.withColumn(PARTITION, day_slot(F.col(millis)))


def _no_null_numbers(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.fillna(0, [c for c, t in df.dtypes if c not in keys and t in ("bigint", "int", "double")])


def upsert_demand_windows(batch: DataFrame, path: str) -> None:
    keys = ["location_id", "window_start"]
    upsert(with_day(_no_null_numbers(batch, keys)), path, keys)


def upsert_zone_flows(batch: DataFrame, path: str) -> None:
    keys = ["origin_id", "destination_id", "window_start"]
    upsert(with_day(_no_null_numbers(batch, keys)), path, keys)


# --- typed loads -----------------------------------------------------------

def in_days(rows: DataFrame, start: int | None, end: int | None) -> DataFrame:
    """Rows of a stored table in the day partitions that ``start <= window_start < end`` can touch; other frames as they are."""
    if PARTITION not in rows.columns:
        return rows
    last = None if end is None else (end - 1) // 86_400_000 + 1
    return rows.where(half_open(F.col(PARTITION), None if start is None else start // 86_400_000, last))



def demand_features(windows: DataFrame, start: int | None = None, end: int | None = None) -> DataFrame:
    """Demand rows in canonical types for ``start <= window_start < end``, one per key."""
    have = set(windows.columns)
    number = lambda name: (F.col(name) if name in have else F.lit(None)).cast("double").alias(name)
    surge = F.coalesce(F.col("is_surge").cast("boolean"), F.lit(False)) if "is_surge" in have else F.lit(False)
    return (
        in_days(windows, start, end).where(half_open(F.col("window_start"), start, end))
        .select(
            F.col("location_id").cast("int").alias("location_id"),
            F.col("window_start").cast("long").alias("window_start"),
            F.col("window_end").cast("long").alias("window_end"),
            *[number(name) for name in DEMAND_COLUMNS],
            F.when(surge, 1.0).otherwise(0.0).alias("is_surge"),
        )
        # By one sort, which may spill and which demand that is already in time order per zone need not repeat.
        .withColumn("_copy", F.row_number().over(Window.partitionBy("location_id", "window_start").orderBy("window_start")))
        .where(F.col("_copy") == 1).drop("_copy")
    )


def load_demand_windows(spark: SparkSession, path: str, start: int | None = None,
                        end: int | None = None) -> DataFrame:
    """``demand_features`` of a stored table, reading only the day partitions in range."""
    return demand_features(spark.read.parquet(path), start, end)


def zone_graph_features(zones: DataFrame) -> DataFrame:
    """Zone ids with their current scores; missing scores are 0, no community is -1. Of copies that differ the greatest scores stay."""
    have = set(zones.columns)
    stored = lambda name: F.col(name) if name in have else F.lit(None)
    return zones.select(
        F.col("location_id").cast("int").alias("location_id"),
        *[or_zero(stored(name)).alias(name) for name in ZONE_SCORES],
        F.coalesce(stored("community_id").cast("long"), F.lit(-1).cast("long")).alias("community_id"),
    ).groupBy("location_id").agg(F.max(F.struct(*ZONE_SCORES, "community_id")).alias("_z")).select("location_id", "_z.*")


def community_features(communities: DataFrame) -> DataFrame:
    return communities.select(
        F.col("community_id").cast("long").alias("community_id"),
        or_zero(F.col("size")).alias("community_size"),
        or_zero(F.col("cohesion")).alias("community_cohesion"),
    ).groupBy("community_id").agg(F.max(F.struct("community_size", "community_cohesion")).alias("_c")).select("community_id", "_c.*")


def flow_edges(flows: DataFrame, start: int | None = None, end: int | None = None) -> DataFrame:
    return in_days(flows, start, end).where(half_open(F.col("window_start"), start, end)).select(
        F.col("origin_id").cast("int").alias("origin_id"),
        F.col("destination_id").cast("int").alias("destination_id"),
        F.col("window_start").cast("long").alias("window_start"),
        or_zero(F.col("trip_count")).alias("edge_trips"),
    )


# --- feature store and snapshots ------------------------------------------

def write_feature_store(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    (with_day(df).hint("rebalance", F.col(PARTITION)).write.mode(mode).partitionBy(PARTITION)
     .option("compression", "snappy").parquet(path))


def read_feature_store(spark: SparkSession, path: str, from_day: int | None = None,
                       to_day: int | None = None) -> DataFrame:
    return spark.read.parquet(path).where(half_open(F.col(PARTITION), from_day, to_day))


def graph_snapshot(zones: DataFrame, communities: DataFrame, valid_from: int,
                   key: str = "snapshot_start") -> DataFrame:
    """Current zone and community scores stamped with the time they hold from."""
    return (
        zone_graph_features(zones)
        .join(community_features(communities), "community_id", "left")
        .fillna(0.0, COMMUNITY_FIGURES)
        .withColumn(key, F.lit(valid_from).cast("long"))
    )


def write_graph_snapshot(zones: DataFrame, communities: DataFrame, path: str, valid_from: int,
                         key: str = "snapshot_start") -> None:
    graph_snapshot(zones, communities, valid_from, key).write.mode("append").parquet(path)


# --- write-backs onto dimensions ------------------------------------------

def _overlay(base: DataFrame, updates: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Existing rows only: new values where an update exists, old values elsewhere."""
    fresh = updates.select(F.col(key), *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_hit"))
    joined = base.join(fresh, key, "left")
    old = lambda c: F.col(c) if c in base.columns else F.lit(None)
    return joined.select(
        *[c for c in base.columns if c not in columns],
        *[F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(old(c)).alias(c) for c in columns],
    )


IMPORTANCE_COLUMNS = ["page_rank_score", "betweenness_score", "page_rank_normalised",
                      "betweenness_normalised", "importance_score", "importance_rank", "corridor_bias"]


def persist_importance(zones: DataFrame, scores: DataFrame) -> DataFrame:
    """Zones with the new scores; zones never scored keep theirs, unknown zones are not added."""
    return _overlay(zones, scores, "location_id", IMPORTANCE_COLUMNS)


def persist_communities(zones: DataFrame, assignments: DataFrame) -> DataFrame:
    """Zones with the new membership. One column per zone, so no stale membership can remain."""
    levels = "community_levels"
    rows = assignments if levels in assignments.columns else assignments.withColumn(levels, F.lit(0))
    return _overlay(zones, rows, "location_id", ["community_id", levels])


def persist_profiles(communities: DataFrame, profiles: DataFrame) -> DataFrame:
    """Known communities with their new figures."""
    figures = [c for c in profiles.columns if c not in ("community_id", "location_ids", "top_zones")]
    return _overlay(communities, profiles, "community_id", figures)


def prune_empty_communities(communities: DataFrame, zones: DataFrame) -> DataFrame:
    members = zones.select("community_id").where(F.col("community_id").isNotNull())
    return communities.join(members, "community_id", "left_semi")


def forecast_rows(forecasts: DataFrame, zones: DataFrame, horizon: int, slide_ms: int, version: str) -> DataFrame:
    """Publishable forecast rows, for known zones only."""
    c = F.col
    return forecasts.join(zones.select("location_id"), "location_id", "left_semi").select(
        "location_id",
        c("window_start").alias("origin_window_start"),
        (c("window_start") + F.lit(horizon * slide_ms)).alias("target_window_start"),
        c("forecast_trip_count"),
        c("forecast_lower_bound").alias("lower_bound"),
        c("forecast_upper_bound").alias("upper_bound"),
        F.lit(version).alias("model_version"),
        F.lit(horizon).alias("horizon_slots"),
    )


def publish_forecasts(forecasts: DataFrame, zones: DataFrame, path: str, horizon: int, slide_ms: int,
                      version: str) -> None:
    """Keyed upsert by (zone, target window); republishing a cycle leaves one row per key."""
    rows = with_day(forecast_rows(forecasts, zones, horizon, slide_ms, version), "target_window_start")
    upsert(rows, path, ["location_id", "target_window_start"], "origin_window_start")


def write_forecasts(forecasts: DataFrame, path: str, mode: str = "overwrite") -> None:
    write_feature_store(forecasts, path, mode)


def read_dimension(spark: SparkSession, path: str) -> DataFrame:
    finish_move(spark, path)
    return spark.read.parquet(path)


def replace_dimension(df: DataFrame, path: str) -> None:
    """Overwrite a small keyed dimension that ``df`` may itself have been read from."""
    df.write.mode("overwrite").parquet(_staged(path))
    finish_move(df.sparkSession, path)
