"""Zone flows -> weighted graph (a nodes frame and an edges frame)."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odflux.functions.columns import half_open, or_zero
from odflux.operators.quantiles import exact_quantiles

NATURAL, REVERSE, UNDIRECTED = "natural", "reverse", "undirected"
_FOLD = {"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max, "count": F.count}


@dataclass(frozen=True)
class EdgeProperty:
    """``name`` = ``how(column)`` over the parallel edges of a pair, ``default`` if null."""

    name: str
    column: str
    how: str = "sum"
    default: float = 0.0

    def build(self) -> Column:
        folded = _FOLD[self.how](F.col(self.column)).cast("double")
        return F.coalesce(folded, F.lit(float(self.default))).alias(self.name)


@dataclass(frozen=True)
class GraphSpec:
    name: str
    window_from: int | None = None
    window_to: int | None = None
    min_trip_count: int = 0
    orientation: str = NATURAL
    include_internal: bool = False
    include_isolated: bool = True
    boroughs: tuple[str, ...] = ()
    service_zones: tuple[str, ...] = ()
    node_properties: dict[str, float] = field(default_factory=dict)
    edge_properties: tuple[EdgeProperty, ...] = (EdgeProperty("trip_count", "trip_count"),)

    def __post_init__(self):
        if self.orientation not in (NATURAL, REVERSE, UNDIRECTED):
            raise ValueError(f"unknown orientation {self.orientation!r}")
        if self.window_from is not None and self.window_to is not None and self.window_from >= self.window_to:
            raise ValueError("window_from must be before window_to")

    def over(self, window_from: int | None, window_to: int | None) -> "GraphSpec":
        return replace(self, window_from=window_from, window_to=window_to)


# The four projections the analytics passes use.
FLOW_VOLUME = GraphSpec(
    "zone_flow_volume", min_trip_count=1,
    node_properties={"latest_trip_count": 0.0, "peak_trip_count": 0.0, "latest_demand_per_minute": 0.0},
    edge_properties=(
        EdgeProperty("trip_count", "trip_count"),
        EdgeProperty("total_revenue", "total_revenue"),
        EdgeProperty("avg_duration_seconds", "avg_duration_seconds", "avg"),
    ),
)
COMMUNITY = GraphSpec("zone_community", min_trip_count=5, orientation=UNDIRECTED)
INBOUND_PRESSURE = GraphSpec(
    "zone_inbound_pressure", min_trip_count=1, orientation=REVERSE,
    edge_properties=(
        EdgeProperty("trip_count", "trip_count"),
        EdgeProperty("flow_share", "trip_count", "count"),
    ),
)
TRAVEL_TIME = GraphSpec(
    "zone_travel_time", min_trip_count=3,
    edge_properties=(
        EdgeProperty("avg_duration_seconds", "avg_duration_seconds", "avg"),
        EdgeProperty("avg_trip_distance_miles", "avg_trip_distance_miles", "avg"),
        EdgeProperty("trip_count", "trip_count"),
    ),
)


def _chosen_zones(zones: DataFrame, spec: GraphSpec) -> DataFrame:
    chosen = zones
    if spec.boroughs:
        chosen = chosen.where(F.col("borough").isin(*spec.boroughs))
    if spec.service_zones:
        chosen = chosen.where(F.col("service_zone").isin(*spec.service_zones))
    return chosen


def _chosen_flows(zones: DataFrame, flows: DataFrame, spec: GraphSpec) -> DataFrame:
    """Flow rows inside the spec: window and size filters sit on the scan, zones join both ends."""
    rows = flows.where(half_open(F.col("window_start"), spec.window_from, spec.window_to))
    if spec.min_trip_count > 0:
        rows = rows.where(F.coalesce("trip_count", F.lit(0)) >= spec.min_trip_count)
    if not spec.include_internal:
        rows = rows.where(F.col("origin_id") != F.col("destination_id"))
    ids = _chosen_zones(zones, spec).select("location_id")
    return (
        rows.join(ids.withColumnRenamed("location_id", "origin_id"), "origin_id", "left_semi")
        .join(ids.withColumnRenamed("location_id", "destination_id"), "destination_id", "left_semi")
    )


def project_graph(zones: DataFrame, flows: DataFrame, spec: GraphSpec) -> tuple[DataFrame, DataFrame]:
    """Nodes ``(id, ...)`` and edges ``(src, dst, ...)``; parallel edges are folded per zone pair.

    The size filter applies to each windowed edge before folding. An undirected
    graph lists every folded edge in both directions.
    """
    pairs = (
        _chosen_flows(zones, flows, spec)
        .groupBy(F.col("origin_id").alias("src"), F.col("destination_id").alias("dst"))
        .agg(*[p.build() for p in spec.edge_properties])
    )
    swapped = pairs.select(F.col("dst").alias("src"), F.col("src").alias("dst"),
                           *[p.name for p in spec.edge_properties])
    if spec.orientation == REVERSE:
        edges = swapped
    elif spec.orientation == UNDIRECTED:
        edges = pairs.unionByName(swapped)
    else:
        edges = pairs

    have = set(zones.columns)
    nodes = _chosen_zones(zones, spec).select(
        F.col("location_id").alias("id"),
        *[F.coalesce((F.col(c) if c in have else F.lit(None)).cast("double"), F.lit(d)).alias(c)
          for c, d in spec.node_properties.items()],
        *[c for c in ("zone_name", "borough", "community_id") if c in have],
    ).dropDuplicates(["id"])
    if not spec.include_isolated:
        touched = edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
        nodes = nodes.join(touched, "id", "left_semi")
    return nodes, edges


def projection_cardinality(zones: DataFrame, flows: DataFrame, spec: GraphSpec) -> DataFrame:
    """Zones, windowed edges and distinct zone pairs that match the spec."""
    pairs = _chosen_flows(zones, flows, spec).groupBy("origin_id", "destination_id").agg(
        F.count(F.lit(1)).alias("edges"))
    figures = pairs.agg(
        F.coalesce(F.sum("edges"), F.lit(0)).cast("long").alias("relationship_count"),
        F.count(F.lit(1)).alias("pair_count"),
    )
    counted = _chosen_zones(zones, spec).agg(F.count(F.lit(1)).alias("node_count"))
    return figures.select(counted.scalar().alias("node_count"), "relationship_count", "pair_count")


def distribution(frame: DataFrame, column: str, exact: bool = False) -> DataFrame:
    """Min, mean, max, spread and percentiles of a per-node column.

    Percentiles come from a mergeable sketch; ``exact`` ranks all values, range by range.
    """
    # The reported percentiles.
    marks = {"p50": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95, "p99": 0.99, "p999": 0.999}
    value = F.col(column).cast("double")
    wanted = F.array(*[F.lit(p) for p in marks.values()])
    figures = [F.min(value).alias("min"), F.avg(value).alias("mean"), F.max(value).alias("max"), F.stddev_pop(value).alias("std_dev")]
    if exact:
        row = frame.agg(*figures).withColumn("_p", exact_quantiles(frame, value, list(marks.values())).scalar())
    else:
        row = frame.agg(*figures, F.percentile_approx(value, wanted, 100_000).alias("_p"))
    return row.select("min", "mean", "max", *[F.col("_p")[i].alias(n) for i, n in enumerate(marks)], "std_dev")


def projection_summary(nodes: DataFrame, edges: DataFrame, exact: bool = False) -> DataFrame:
    """Node and edge counts, density, out-degree distribution and the empty flag."""
    degrees = edges.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("degree"))
    per_node = nodes.select("id").join(degrees, "id", "left").select(
        F.coalesce("degree", F.lit(0)).alias("degree"))
    counts = per_node.agg(F.count(F.lit(1)).alias("node_count"), F.sum("degree").alias("_edges"))
    n, m = F.col("node_count").cast("double"), F.col("relationship_count").cast("double")
    spread = distribution(per_node, "degree", exact).select(
        *[F.col(c).alias(f"degree_{c}") for c in ("min", "mean", "max", "p50", "p90", "p99")])
    return (
        counts.select("node_count", F.coalesce("_edges", F.lit(0)).cast("long").alias("relationship_count"))
        .select("*", or_zero(F.try_divide(m, n * (n - 1.0))).alias("density"),
                (F.col("node_count") == 0).alias("is_empty"),
                *[spread.select(c).scalar().alias(c) for c in spread.columns])
    )


# --- stored generations ----------------------------------------------------

def _generation_folders(spark, base: str) -> dict[int, str]:
    jvm = spark._jvm
    location = jvm.org.apache.hadoop.fs.Path(base)
    fs = location.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(location):
        return {}
    names = [s.getPath().getName() for s in fs.listStatus(location) if s.isDirectory()]
    return {int(n[2:]): f"{base}/{n}" for n in names if n.startswith("g=") and n[2:].isdigit()}


def generations_of(spark, root: str, name: str) -> list[int]:
    """Complete generations, newest first (both parts carry Spark's success marker)."""
    from odflux.sources.tables import path_exists

    found = _generation_folders(spark, f"{root}/{name}")
    done = [g for g, p in found.items() if all(path_exists(spark, f"{p}/{x}/_SUCCESS") for x in ("nodes", "edges"))]
    return sorted(done, reverse=True)


def _drop_folder(spark, path: str) -> None:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)


def refresh_projection(spec: GraphSpec, nodes: DataFrame, edges: DataFrame, root: str, retain: int = 1) -> int:
    """Write the next generation, then retire all but the ``retain`` newest.

    Readers of the previous generation are undisturbed until the new one is whole.
    """
    spark = nodes.sparkSession
    base = f"{root}/{spec.name}"
    generation = max(_generation_folders(spark, base), default=0) + 1
    nodes.write.mode("overwrite").parquet(f"{base}/g={generation}/nodes")
    edges.write.mode("overwrite").parquet(f"{base}/g={generation}/edges")
    for stale in generations_of(spark, root, spec.name)[max(retain, 1):]:
        _drop_folder(spark, f"{base}/g={stale}")
    return generation


def active_projection(spark, root: str, name: str) -> tuple[DataFrame, DataFrame]:
    found = generations_of(spark, root, name)
    if not found:
        raise LookupError(f"no stored projection named {name!r} under {root}")
    base = f"{root}/{name}/g={found[0]}"
    return spark.read.parquet(f"{base}/nodes"), spark.read.parquet(f"{base}/edges")


def drop_projection(spark, root: str, name: str) -> None:
    for path in _generation_folders(spark, f"{root}/{name}").values():
        _drop_folder(spark, path)
