"""Zone polygons from a GeoJSON FeatureCollection, joined with per-zone figures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_COLLECTION = (
    "type string, features array<struct<type: string, geometry: string, properties: map<string, string>>>"
)


def load_zone_polygons(spark: SparkSession, path: str) -> DataFrame:
    """One row per feature: id (-1 when unusable), name, geometry as GeoJSON text."""
    files = spark.read.schema(_COLLECTION).option("multiLine", True).json(path)
    feature = files.select(F.explode("features").alias("f"))
    prop = lambda name: F.try_element_at("f.properties", F.lit(name))
    raw_id = F.coalesce(prop("location_id"), prop("LocationID"))
    return feature.select(
        F.coalesce(raw_id.try_cast("int"), F.lit(-1)).alias("location_id"),
        F.coalesce(prop("zone"), F.lit("")).alias("zone_label"),
        F.col("f.geometry").alias("geometry"),
    )


def write_zone_polygons(zones: DataFrame, path: str, half_side: float = 0.0625, features_per_file: int = 500) -> None:
    """Square outlines around the positions of ``zones(location_id, zone_name, latitude, longitude)`` as FeatureCollections.

    One file and collection per ``features_per_file`` neighbouring ids, so no task nests all
    zones in one document. Zones without a position have no outline.
    """
    west, east = F.col("longitude") - half_side, F.col("longitude") + half_side
    south, north = F.col("latitude") - half_side, F.col("latitude") + half_side
    ring = F.array(*[F.array(x, y) for x, y in ((west, south), (east, south), (east, north), (west, north), (west, south))])
    feature = F.struct(
        F.lit("Feature").alias("type"), F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"),
        F.struct(F.col("location_id"), F.col("zone_name").alias("zone")).alias("properties"))
    blocks = zones.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).groupBy(
        F.floor(F.col("location_id") / features_per_file).alias("block")).agg(F.collect_list(feature).alias("features"))
    blocks.select(F.lit("FeatureCollection").alias("type"), "features").write.mode("overwrite").option(
        "maxRecordsPerFile", 1).json(path)


def outline_corners(polygons: DataFrame) -> DataFrame:
    """(location_id, corners, west, east, south, north) of polygons' outer rings, point by point from their GeoJSON."""
    ring = F.from_json("geometry", "coordinates array<array<array<double>>>")["coordinates"][0]
    points = polygons.select("location_id", F.explode(ring).alias("p"))
    return points.groupBy("location_id").agg(
        F.count(F.lit(1)).alias("corners"), F.min(F.col("p")[0]).alias("west"), F.max(F.col("p")[0]).alias("east"),
        F.min(F.col("p")[1]).alias("south"), F.max(F.col("p")[1]).alias("north"))


def enrich_polygons(polygons: DataFrame, metrics: DataFrame, cols: list[str]) -> DataFrame:
    """Polygons with the named figures, 0 where a zone has none."""
    named = "zone_name" in metrics.columns
    picked = metrics.select("location_id", *cols, *(["zone_name"] if named else []))
    joined = polygons.join(picked, "location_id", "left")
    label = F.coalesce("zone_name", "zone_label") if named else F.col("zone_label")
    zero = {c: F.coalesce(F.col(c), F.lit(0).cast(dict(metrics.dtypes)[c])) for c in cols}
    return joined.withColumns(zero).withColumn("zone_name", label).drop("zone_label")
