"""The scheduled jobs: ingest, stream, graph cycle, training cycle, inference cycle."""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field, replace

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from odflux.operators import community, projection
from odflux.operators.centrality import analyse_centrality
from odflux.operators.evaluation import validation_report
from odflux.operators.features import (
    FeatureConfig,
    FeatureSources,
    assemble_vector,
    feature_health,
    inference_matrix,
    training_matrix,
)
from odflux.operators.forecast import (
    TrainConfig,
    feature_importances,
    forecast,
    load_model,
    save_model,
    saved_version,
    train,
    walk_forward_validate,
)
from odflux.operators.ingest import (
    ZONE_RANGE,
    assess_trips,
    ingest_summary,
    publish_events,
    reject_breakdown,
    split_assessed,
)
from odflux.sources import tables
from odflux.sources.trip_files import scan_trip_csv
from odflux.streaming.queries import read_event_stream, start_demand_query, start_flow_query, trip_stream


@dataclass(frozen=True)
class JobConfig:
    """Folders of one deployment, all below ``root`` on shared storage, and the job settings."""

    root: str
    lookback_hours: int = 24
    slots_to_score: int = 1
    model_version: str = "v1"
    folds: int = 4
    #: Pivots of the betweenness pass, None for all zones; the choice for graphs of more than some thousand zones.
    betweenness_sample: int | None = None
    betweenness_seed: int = 42
    train_from: int | None = None
    train_to: int | None = None
    features: FeatureConfig = field(default_factory=FeatureConfig)
    training: TrainConfig = field(default_factory=TrainConfig)

    def at(self, name: str) -> str:
        return f"{self.root}/{name}"


def ingest_job(spark: SparkSession, cfg: JobConfig, raw_path: str, service_type: str,
               tz: str = "America/New_York", zone_range: tuple[int, int] = ZONE_RANGE, fail_fast: bool = False,
               limit: int | None = None, sink: dict[str, str] | None = None) -> None:
    """Trip files -> event payloads, rejects, summary and reject breakdown.

    The text is read and parsed once: accepted and rejected rows go to the two
    partitions of one staged table, and everything else reads that. With
    ``fail_fast`` a single rejected row stops the job before anything is sent.
    ``limit`` sends only so many trips, and ``sink`` says where to, as in
    ``publish_events``; the default is this deployment's event files.
    """
    staged = cfg.at("ingest_staged")
    assessed = assess_trips(scan_trip_csv(spark, raw_path), service_type, tz, zone_range)
    (assessed.withColumn("outcome", F.when(F.col("reason").isNull(), "accepted").otherwise("rejected"))
     .write.mode("overwrite").partitionBy("outcome").parquet(staged))
    stored = spark.read.schema(assessed.schema.add("outcome", "string")).parquet(staged)
    accepted, _ = split_assessed(stored.where(F.col("outcome") == "accepted"))
    _, rejected = split_assessed(stored.where(F.col("outcome") == "rejected"))
    if fail_fast and (worst := rejected.select("source_file", "source_line", "reason", "detail").first()):
        raise ValueError(f"{worst.source_file}, line {worst.source_line}: {worst.reason} ({worst.detail}); nothing was sent")
    publish_events(accepted.limit(limit) if limit else accepted, sink or {"path": cfg.at("events"), "mode": "overwrite"})
    rejected.write.mode("overwrite").parquet(cfg.at("rejects"))
    reject_breakdown(rejected).write.mode("overwrite").parquet(cfg.at("reject_breakdown"))
    ingest_summary(stored).write.mode("overwrite").parquet(cfg.at("ingest_summary"))


def stream_job(spark: SparkSession, cfg: JobConfig, source: dict[str, str], trigger: dict | None = None,
               mode: str = "update", watermark: str = "10 minutes", **read_options):
    """Both windowed queries over one source, each with its own checkpoint."""
    trips = trip_stream(read_event_stream(spark, source, **read_options), watermark)
    return (
        start_demand_query(trips, cfg.at("demand_windows"), cfg.at("checkpoints/demand"), mode, trigger),
        start_flow_query(trips, cfg.at("zone_flows"), cfg.at("checkpoints/flows"), mode, trigger),
    )


def _latest(spark: SparkSession, cfg: JobConfig) -> int:
    windows = spark.read.parquet(cfg.at("demand_windows"))
    day = windows.agg(F.max(tables.PARTITION)).first()[0]  # from the folders' names alone
    found = windows.where(F.col(tables.PARTITION) == day).agg(F.max("window_start")).first()[0] if day is not None else None
    if found is None:
        raise LookupError("the demand table holds no window; let the stream job write some before this cycle")
    return found


def _projected(spark, cfg, spec, zones, flows):
    count = projection.projection_cardinality(zones, flows, spec).first()
    if count["relationship_count"] == 0:
        raise LookupError(f"{spec.name} has no edge between {spec.window_from} and {spec.window_to}; look back further or ask for fewer trips")
    nodes, edges = projection.project_graph(zones, flows, spec)
    projection.refresh_projection(spec, nodes, edges, cfg.at("projections"))
    return projection.active_projection(spark, cfg.at("projections"), spec.name)


def graph_cycle(spark: SparkSession, cfg: JobConfig) -> None:
    """Rescore zones and communities over the trailing window, then snapshot the result."""
    latest = _latest(spark, cfg)
    start, end = latest - cfg.lookback_hours * 3_600_000, latest + cfg.features.slide_ms
    zones = tables.read_dimension(spark, cfg.at("zones"))
    flows = tables.in_days(spark.read.parquet(cfg.at("zone_flows")), start, end)

    spec = projection.FLOW_VOLUME.over(start, end)
    ranked = analyse_centrality(*_projected(spark, cfg, spec, zones, flows), betweenness_args={
        "sample": cfg.betweenness_sample, "seed": cfg.betweenness_seed, "weight": None})
    zones = tables.persist_importance(zones, ranked)
    tables.replace_dimension(zones, cfg.at("zones"))
    zones = tables.read_dimension(spark, cfg.at("zones"))

    spec = projection.COMMUNITY.over(start, end)
    nodes, edges = _projected(spark, cfg, spec, zones, flows)
    assignments, profiles, drift, levels = community.analyse_communities(spec, nodes, edges, zones, flows)
    levels.write.mode("overwrite").parquet(cfg.at("community_levels"))
    # Profiles and drift are still plans over the stored zones, so they are written before those change.
    tables.replace_dimension(profiles, cfg.at("communities"))
    drift.write.mode("overwrite").parquet(cfg.at("community_drift"))
    tables.replace_dimension(tables.persist_communities(zones, assignments), cfg.at("zones"))
    zones = tables.read_dimension(spark, cfg.at("zones"))
    tables.write_graph_snapshot(zones, tables.read_dimension(spark, cfg.at("communities")), cfg.at("graph_snapshots"), end)


def _sources(spark: SparkSession, cfg: JobConfig) -> FeatureSources:
    optional = lambda name: spark.read.parquet(cfg.at(name)) if tables.path_exists(spark, cfg.at(name)) else None
    tables.finish_move(spark, cfg.at("communities"))  # a copy that a dead writer left ready
    return FeatureSources(spark.read.parquet(cfg.at("demand_windows")), tables.read_dimension(spark, cfg.at("zones")),
                          optional("communities"), optional("zone_flows"), optional("graph_snapshots"))


def training_cycle(spark: SparkSession, cfg: JobConfig) -> None:
    """Matrix -> health -> feature store -> walk-forward -> refit on everything -> saved model."""
    matrix = training_matrix(_sources(spark, cfg), cfg.features, cfg.train_from, cfg.train_to)
    tables.write_feature_store(matrix, cfg.at("feature_store"))
    stored = tables.read_feature_store(spark, cfg.at("feature_store"))
    if stored.isEmpty():
        raise LookupError("no slot has both its history and its target; widen train_from and train_to or shorten the lookback")
    feature_health(stored).write.mode("overwrite").parquet(cfg.at("feature_health"))
    # A scaler is a stage of the model, fitted with it, stored with it and only applied at inference.
    training = replace(cfg.training, embargo_ms=cfg.features.horizon * cfg.features.slide_ms,
                       scale=cfg.training.scale or cfg.features.scale)
    rows = assemble_vector(stored).persist()
    try:
        folds = walk_forward_validate(rows, training, cfg.folds)
        report = validation_report(folds).first()
        if not report["beats_baseline"]:
            warnings.warn("yesterday's count forecasts these rows better than the model; keep the deployed one")
        model = train(rows, training)
        feature_importances(model).write.mode("overwrite").parquet(cfg.at("feature_importances"))
        folds.write.mode("overwrite").parquet(cfg.at("validation_folds"))
        save_model(model, cfg.at("model"), cfg.model_version, report["mean_skill"])
    finally:
        rows.unpersist()


def inference_cycle(spark: SparkSession, cfg: JobConfig) -> None:
    """Score the newest slots with the stored model and publish under that model's version."""
    latest = _latest(spark, cfg)
    version = saved_version(spark, cfg.at("model")) or cfg.model_version
    model = load_model(cfg.at("model"), spark)
    rows = assemble_vector(inference_matrix(_sources(spark, cfg), cfg.features, latest, cfg.slots_to_score))
    produced = forecast(model, rows).persist()
    try:
        if produced.isEmpty():
            warnings.warn("nothing was forecast: no zone has rows in the newest slots of the demand table")
            return
        tables.upsert(tables.with_day(produced), cfg.at("forecast_store"), ["location_id", "window_start"])
        tables.publish_forecasts(produced, tables.read_dimension(spark, cfg.at("zones")), cfg.at("forecasts"),
                                 cfg.features.horizon, cfg.features.slide_ms, version)
    finally:
        produced.unpersist()

