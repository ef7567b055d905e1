"""Leakage-safe (zone x slot) feature matrix.

The order of the steps is chosen for shuffles. Grid completion, lags, trailing
statistics and the label all work on one zone in time order, so after a single
shuffle on the zone they run as window expressions over the same sort; the
calendar terms are a projection. Only flow pressure (joined by zone and slot)
and community peers (by community and slot) move the matrix again.

A zone's share of the matrix is bounded by the calendar: one row per slot.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odflux.functions.columns import half_open, or_zero
from odflux.functions.session import cut_lineage
from odflux.operators.series import slot_writer
from odflux.sources.tables import (
    COMMUNITY_FIGURES,
    PARTITION,
    ZONE_SCORES,
    community_features,
    demand_features,
    flow_edges,
    in_days,
    with_day,
    zone_graph_features,
)

# How an empty slot is filled.
ZERO_IN_EMPTY_SLOT = ["trip_count", "passenger_total", "demand_per_minute", "total_revenue", "total_tips",
                      "distinct_destinations", "is_surge"]
CARRIED_INTO_EMPTY_SLOT = ["avg_trip_distance_miles", "avg_duration_seconds", "avg_speed_mph", "avg_fare_amount",
                           "baseline_demand_per_minute", "surge_ratio"]
FLOW_COLUMNS = ["inbound_trip_count", "inbound_zone_count", "outbound_trip_count", "outbound_zone_count", "net_flow"]
NON_FEATURES = ["location_id", "window_start", "window_end", "target_trip_count", "target_window_start",
                PARTITION, "features", "scaled_features"]

DISABLED, CURRENT, SNAPSHOTS = "disabled", "current", "snapshots"


@dataclass(frozen=True)
class FeatureConfig:
    slide_seconds: int = 300
    window_seconds: int = 900
    horizon: int = 3
    lags: tuple[int, ...] = (1, 2, 3, 6, 12)
    spans: tuple[int, ...] = (6, 12, 36)
    daily_lag: bool = True
    weekly_lag: bool = True
    use_flows: bool = True
    graph: str = CURRENT
    tz: str = "America/New_York"
    min_observed: int = 1
    scale: bool = False

    def __post_init__(self):
        if self.slide_seconds < 1 or self.window_seconds < self.slide_seconds:
            raise ValueError("window_seconds must be at least slide_seconds, and both positive")
        if not self.lags or min(self.lags) < 1 or len(set(self.lags)) != len(self.lags):
            raise ValueError("lags must be unique and positive, at least one")
        if any(s < 2 for s in self.spans) or len(set(self.spans)) != len(self.spans):
            raise ValueError("spans must be unique and cover at least two slots")
        if self.horizon < 1 or self.min_observed < 0:
            raise ValueError("horizon must be at least 1 and min_observed non-negative")
        if self.daily_lag and 86_400 % self.slide_seconds:
            raise ValueError("a daily lag needs slide_seconds to divide one day")
        if self.graph not in (DISABLED, CURRENT, SNAPSHOTS):
            raise ValueError(f"unknown graph feature mode {self.graph!r}")

    @property
    def slide_ms(self) -> int:
        return self.slide_seconds * 1000

    @property
    def slots_per_day(self) -> int:
        return 86_400 // self.slide_seconds

    @property
    def seasonal(self) -> dict[str, int]:
        day = self.slots_per_day
        return {**({"day": day} if self.daily_lag else {}), **({"week": 7 * day} if self.weekly_lag else {})}

    @property
    def lookback(self) -> int:
        return max([*self.lags, *self.spans, *self.seasonal.values()])


@dataclass(frozen=True)
class FeatureSources:
    """The frames a matrix is built from; only ``demand`` and ``zones`` are always needed.

    A graph layer that has not been run yet gives scores and flows of 0 and no community.
    """

    demand: DataFrame
    zones: DataFrame
    communities: DataFrame | None = None
    flows: DataFrame | None = None
    snapshots: DataFrame | None = None


NO_COMMUNITIES = "community_id long, size long, cohesion double"
NO_FLOWS = "origin_id int, destination_id int, window_start long, trip_count long"
NO_SNAPSHOTS = ", ".join(["location_id int", *[f"{c} double" for c in ZONE_SCORES], "community_id long",
                          *[f"{c} double" for c in COMMUNITY_FIGURES], "snapshot_start long"])


def _in_order() -> Window:
    return Window.partitionBy("location_id").orderBy("window_start")


def on_grid(demand: DataFrame, zones: DataFrame, slide_ms: int, width_ms: int, min_observed: int = 1,
            keep: list[str] | None = None, lags: tuple[int, ...] = (), seasons: dict[str, int] | None = None,
            spans: tuple[int, ...] = (), horizon: int = 0, zone_values: DataFrame | None = None,
            beside: DataFrame | None = None, snapshots: DataFrame | None = None) -> DataFrame:
    """Every slot of every active zone, from the earliest to the latest observed window, with what is asked for.

    ``keep`` names the demand columns wanted (all). ``lags``, ``seasons`` (name: slots), ``spans`` and ``horizon`` add what
    ``lag_features``, ``seasonal_lags``, ``rolling_features`` and ``target_label`` add to a grid, in the order of a matrix.
    ``zone_values`` (one row a zone) stand on all its slots; ``beside`` (one row a zone and slot) is 0 where it has
    no row; ``snapshots`` are joined as ``asof_snapshots`` does.

    Only observed rows, and the rows beside them, are shuffled and sorted by zone and time. Each stands
    for itself and the empty slots up to the next one of its zone (the first one also for those before it), and the slots
    are written out where it lies: the filled grid is never shuffled, sorted or held.
    """
    keep = ZERO_IN_EMPTY_SLOT + CARRIED_INTO_EMPTY_SLOT if keep is None else keep
    told = [*(["trip_count"] if lags or seasons or spans or horizon else []), *(["demand_per_minute"] if lags else [])]
    zeroed = [c for c in ZERO_IN_EMPTY_SLOT if c in keep or c in told]
    carried = [c for c in CARRIED_INTO_EMPTY_SLOT if c in keep]
    # Read for the bounds and for the rows, so worked out once.
    if not getattr(demand, "_cut_path", None):
        demand = cut_lineage(demand.select("location_id", "window_start", "window_end", *zeroed, *carried))
    lo = demand.agg(F.min("window_start").alias("lo")).scalar()
    hi = demand.agg(F.max("window_start").alias("hi")).scalar()
    step = F.lit(slide_ms).cast("long")
    zone_rows = Window.partitionBy("location_id")
    order = _in_order()
    carried_from = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    known = demand.where(F.col("window_start").isNotNull()).join(zones.select("location_id").distinct(), "location_id", "left_semi")
    held = {}
    if zone_values is not None:
        held = {c: t for c, t in zone_values.dtypes if c != "location_id"}
        known = known.join(zone_values, "location_id", "left").fillna(0)
    active = (
        known.withColumn("_seen", F.count(F.lit(1)).over(zone_rows))
        .where(F.col("_seen") >= min_observed)
        .withColumns({"_lo": lo, "_hi": hi})
        .withColumn("_aligned", (F.col("window_start") - F.col("_lo")) % step == 0)
        # A zone none of whose windows lies on the grid keeps one row, which only stands for its empty slots.
        .withColumns({"_any": F.max("_aligned").over(zone_rows), "_nth_seen": F.row_number().over(order)})
        .where(F.col("_aligned") | (~F.col("_any") & (F.col("_nth_seen") == 1)))
        .withColumn("window_start", F.when(F.col("_aligned"), F.col("window_start")).otherwise(F.col("_lo")))
    )
    at, nth = F.col("window_start"), F.row_number().over(order)
    first_slot = F.when(F.col("_nth") == 1, F.col("_lo")).otherwise(F.col("_at"))
    end_slot = F.coalesce(F.col("_next") - step, F.col("_hi"))
    runs_on = end_slot >= F.col("_at")
    rows = active.select(
        "location_id", at.alias("_at"), F.coalesce("window_end", at + F.lit(width_ms)).alias("_end"),
        *[or_zero(F.col(c)).alias(c) for c in zeroed],
        *[or_zero(F.last(c, ignorenulls=True).over(carried_from)).alias(c) for c in carried],
        *held, nth.alias("_nth"), F.lead("window_start").over(order).alias("_next"), "_lo", "_hi", F.col("_aligned").alias("_on"),
    ).select(
        F.col("location_id").cast("int").alias("location_id"), "_at", F.lit(0).alias("_side"),
        F.when(runs_on, F.floor((end_slot - first_slot) / step) + 1).otherwise(1).cast("long").alias("_emit"),
        F.when(runs_on, first_slot).otherwise(F.col("_at")).alias("_first"), "_end", "_on", *zeroed, *carried, *held)
    names = lambda frame, *but: [c for c in frame.columns if c not in ("location_id", *but)]
    more, dated = {}, {}
    sides = []
    if beside is not None:
        more = {c: "double" for c in names(beside, "window_start")}
        sides.append(beside.select("location_id", F.col("window_start").alias("_at"), F.lit(1).alias("_side"), *[or_zero(F.col(c)).alias(c) for c in more]))
    if snapshots is not None:
        dated = {c: ("bigint" if c == "community_id" else "double") for c in names(snapshots, "snapshot_start")}
        blank = {c: -1 if c == "community_id" else 0 for c in dated}
        sides.append(asof_states(snapshots).select("location_id", F.col("snapshot_start").alias("_at"), F.lit(2).alias("_side"), *[
            F.coalesce(F.col(c).cast(t), F.lit(blank[c])).cast(t).alias(c) for c, t in dated.items()]))
    if sides:
        kinds = dict(rows.dtypes) | more | dated
        empty = lambda have: [F.col(c).cast(t).alias(c) if c in have else F.lit(0).cast("int").cast(t).alias(c) for c, t in kinds.items()]
        merged = rows.select(*empty(rows.columns))
        for side in sides:
            merged = merged.unionByName(side.where("location_id is not null and _at is not null").select(*empty(side.columns)))
        rows = merged.repartition("location_id")
    wanted = [c for c in zeroed + carried if c in keep]
    lagged = [(c, n, f"{c}_lag_{n}") for n in lags for c in ("trip_count", "demand_per_minute")]
    lagged += [("trip_count", n, f"trip_count_lag_{name}") for name, n in (seasons or {}).items()]
    fields = [("location_id", "int"), ("window_start", "bigint"), ("window_end", "bigint"), *[(c, "double") for c in wanted]]
    fields += [(f"trip_count_{kind}_{n}", "double") for n in spans for kind in ("mean", "stddev", "max", "min", "trend")]
    fields += [(name, "double") for _, _, name in lagged]
    fields += [("target_trip_count", "double"), ("target_window_start", "bigint")] if horizon else []
    fields += [*held.items(), *dated.items(), *more.items()]
    write = slot_writer(slide_ms, width_ms, fields, zeroed, carried, list(held), list(more),
                        {c: -1 if c == "community_id" else 0.0 for c in dated}, lagged, list(spans), horizon)
    return rows.sortWithinPartitions("location_id", "_at").mapInArrow(write, ", ".join(f"`{n}` {t}" for n, t in fields))


def complete_grid(demand: DataFrame, zones: DataFrame, slide_ms: int, width_ms: int,
                  min_observed: int = 1) -> DataFrame:
    """Every slot of every active zone, from the earliest to the latest observed window."""
    return on_grid(demand, zones, slide_ms, width_ms, min_observed)


def calendar_features(df: DataFrame, tz: str = "America/New_York") -> DataFrame:
    """Local hour, minute of day, weekday (0 = Sunday), weekend flag and their cyclic pairs."""
    local = F.from_utc_timestamp(F.timestamp_millis("window_start"), tz)
    minutes = (F.hour(local) * 60 + F.minute(local)).cast("double")
    weekday = (F.dayofweek(local) - 1).cast("double")
    turn = lambda value, period: value * F.lit(2 * math.pi / period)
    return df.withColumns({
        "hour_of_day": F.hour(local).cast("double"),
        "minute_of_day": minutes,
        "day_of_week": weekday,
        "is_weekend": F.when(weekday.isin(0.0, 6.0), 1.0).otherwise(0.0),
        "hour_sin": F.sin(turn(minutes, 1440)),
        "hour_cos": F.cos(turn(minutes, 1440)),
        "weekday_sin": F.sin(turn(weekday, 7)),
        "weekday_cos": F.cos(turn(weekday, 7)),
    })


# --- columns over one zone in time order (all share one sort) -------------

def _lagged(column: str, slots: int, suffix: str) -> Column:
    return or_zero(F.lag(column, slots).over(_in_order())).alias(f"{column}_lag_{suffix}")


def _lag_columns(lags) -> list[Column]:
    return [_lagged(c, n, str(n)) for n in lags for c in ("trip_count", "demand_per_minute")]


def _seasonal_columns(seasons: dict[str, int]) -> list[Column]:
    return [_lagged("trip_count", slots, name) for name, slots in seasons.items()]


def _with_trailing(df: DataFrame, spans) -> DataFrame:
    """Statistics over the ``span`` slots before the current one; the current slot is never inside.

    Sums and sums of squares are differences of running totals, exact because counts
    are whole (up to 2**53). Extremes of 4, 16, 64, ... slots are each made of four of a
    quarter of the length, and a span is covered by four at most, so the work per row
    grows with the logarithm of the span only, and so do the passes over a zone's rows.
    """
    if not spans:
        return df
    order = _in_order()
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    back = lambda c, n: F.lag(c, n).over(order) if n else F.col(c)
    trips = F.col("trip_count")
    # A missing neighbour before the zone's first slot is passed over by both.
    joined = lambda c, n: {f"_max_{4 * n}": F.greatest(*[back(c.format("max"), i * n) for i in range(4)]),
                           f"_min_{4 * n}": F.least(*[back(c.format("min"), i * n) for i in range(4)])}
    out = df.withColumns({
        "_nth": F.row_number().over(order), "_sum": F.sum(trips).over(so_far), "_squares": F.sum(trips * trips).over(so_far),
        "_max_1": trips, "_min_1": trips, **(joined("trip_count", 1) if max(spans) >= 4 else {})})
    lengths = [1, 4] if max(spans) >= 4 else [1]
    while 4 * lengths[-1] <= max(spans):
        n = lengths[-1]
        out = out.withColumns(joined(f"_{{}}_{n}", n))
        lengths.append(4 * n)
    lagged, parts = {}, {}
    for span in spans:
        block = max(n for n in lengths if n <= span)
        offsets = sorted({1 + min(i * block, span - block) for i in range(-(-span // block))})
        for c in ("_sum", "_squares"):
            lagged[f"{c}_at_1"] = F.coalesce(back(c, 1), F.lit(0.0))
            lagged[f"{c}_at_{span + 1}"] = F.coalesce(back(c, span + 1), F.lit(0.0))
        for c in (f"_max_{block}", f"_min_{block}"):
            lagged.update({f"{c}_at_{n}": back(c, n) for n in offsets})
            # The last slot twice where one block is the whole span: greatest and least take two columns at least.
            parts[span, c[1:4]] = [f"{c}_at_{n}" for n in (offsets if len(offsets) > 1 else offsets * 2)]
    out = out.withColumns(lagged)
    made: list[Column] = []
    for span in spans:
        n = F.least(F.col("_nth") - 1, F.lit(span)).cast("double")
        total, squares = F.col("_sum_at_1") - F.col(f"_sum_at_{span + 1}"), F.col("_squares_at_1") - F.col(f"_squares_at_{span + 1}")
        mean = F.when(n > 0, total / n).otherwise(0.0)
        spread = F.sqrt(F.greatest(n * squares - total * total, F.lit(0.0)) / (n * (n - 1.0)))
        made += [
            mean.alias(f"trip_count_mean_{span}"),
            F.when(n > 1, spread).otherwise(0.0).alias(f"trip_count_stddev_{span}"),
            or_zero(F.greatest(*parts[span, "max"])).alias(f"trip_count_max_{span}"),
            or_zero(F.least(*parts[span, "min"])).alias(f"trip_count_min_{span}"),
            (trips - mean).alias(f"trip_count_trend_{span}"),
        ]
    return out.select(*df.columns, *made)


def _target_columns(horizon: int) -> list[Column]:
    ahead = lambda c, name: F.lead(c, horizon).over(_in_order()).alias(name)
    return [ahead("trip_count", "target_trip_count"), ahead("window_start", "target_window_start")]


def lag_features(df: DataFrame, lags=(1, 2, 3, 6, 12)) -> DataFrame:
    return df.select("*", *_lag_columns(lags))


def seasonal_lags(df: DataFrame, slots_per_day: int, daily: bool = True, weekly: bool = True) -> DataFrame:
    seasons = {**({"day": slots_per_day} if daily else {}), **({"week": 7 * slots_per_day} if weekly else {})}
    return df.select("*", *_seasonal_columns(seasons))


def rolling_features(df: DataFrame, spans=(6, 12, 36)) -> DataFrame:
    return _with_trailing(df, spans)


def target_label(df: DataFrame, horizon: int) -> DataFrame:
    """Trip count ``horizon`` slots ahead; rows whose target is past the end are dropped."""
    return df.select("*", *_target_columns(horizon)).where(F.col("target_trip_count").isNotNull())


# --- joined features -------------------------------------------------------

def _fill_graph(df: DataFrame) -> DataFrame:
    scores = [c for c in ZONE_SCORES + COMMUNITY_FIGURES if c in df.columns]
    return df.fillna(0.0, scores).fillna(-1, ["community_id"])


def graph_features_current(df: DataFrame, zones: DataFrame, communities: DataFrame) -> DataFrame:
    """Today's zone and community scores on every row (for scoring, not for backtests)."""
    return _fill_graph(df.join(_zone_side(zones, communities), "location_id", "left"))


def _zone_side(zones: DataFrame, communities: DataFrame) -> DataFrame:
    return zone_graph_features(zones).join(community_features(communities), "community_id", "left")


def asof_snapshots(df: DataFrame, snapshots: DataFrame, key: str = "snapshot_start") -> DataFrame:
    """The latest snapshot of the row's zone that starts no later than the row.

    Rows and snapshots are laid in one timeline per zone and the last snapshot
    is carried forward: linear in both sides. Snapshots at the same instant are
    settled by their values, the greatest winning.
    """
    carried = [c for c in snapshots.columns if c not in ("location_id", key)]
    kinds = {f.name: f.dataType for f in snapshots.schema.fields}
    state = T.StructType([T.StructField(c, kinds[c]) for c in carried])
    rows = df.select("location_id", F.col("window_start").alias("_at"), F.lit(1).alias("_side"),
                     F.lit(None).cast(state).alias("_state"), F.struct(*df.columns).alias("_row"))
    marks = snapshots.select("location_id", F.col(key).cast("long").alias("_at"), F.lit(0).alias("_side"),
                             F.struct(*carried).alias("_state"), F.lit(None).cast(rows.schema["_row"].dataType).alias("_row"))
    timeline = (
        Window.partitionBy("location_id").orderBy("_at", "_side", "_state")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = rows.unionByName(marks).select("_side", "_row", F.last("_state", ignorenulls=True).over(timeline).alias("_s"))
    joined = placed.where(F.col("_side") == 1).select("_row.*", *[F.col(f"_s.{c}").alias(c) for c in carried])
    return _fill_graph(joined)


def _slot_totals(df: DataFrame) -> DataFrame:
    """Trips and zones of each community in each slot."""
    return df.groupBy(F.col("community_id").alias("_c"), F.col("window_start").alias("_w")).agg(
        F.sum("trip_count").alias("_all"), F.count(F.lit(1)).alias("_n"))


def asof_states(snapshots: DataFrame) -> DataFrame:
    """One row a zone and instant: of snapshots at the same instant the one of the greatest values."""
    carried = [c for c in snapshots.columns if c not in ("location_id", "snapshot_start")]
    return (snapshots.groupBy("location_id", F.col("snapshot_start").cast("long").alias("snapshot_start"))
            .agg(F.max(F.struct(*carried)).alias("_s")).select("location_id", "snapshot_start", *[F.col(f"_s.{c}").alias(c) for c in carried]))


def community_peers(df: DataFrame, totals: DataFrame | None = None, beside: list[str] | None = None) -> DataFrame:
    """Mean demand of the zone's community peers in the slot, and the zone's share.

    Sums and counts are folded before the shuffle and joined back, so zones without
    a community, which all share one, need not meet in one task. ``totals`` are
    ``_slot_totals`` of the same rows where the caller has them, whose columns ``beside`` the totals come along.
    """
    if "community_id" not in df.columns:
        return df
    trips = F.col("trip_count")
    folded = _slot_totals(df) if totals is None else totals
    same = df["community_id"].eqNullSafe(F.col("_c")) & (df["window_start"] == F.col("_w"))
    return df.join(folded, same).select(
        *df.columns,
        F.when(F.col("_n") > 1, (F.col("_all") - trips) / (F.col("_n") - 1)).otherwise(0.0)
        .alias("community_peer_mean_demand"),
        F.when(F.col("_all") > 0, trips / F.col("_all")).otherwise(0.0).alias("community_demand_share"),
        *(beside or []),
    )


def zone_pressure(flows: DataFrame) -> DataFrame:
    """Inbound and outbound trips and peer zones per (zone, window), from one pass over the flows."""
    sides = F.array(
        F.struct(F.col("destination_id").alias("location_id"), F.col("origin_id").alias("peer"), F.lit(True).alias("inward")),
        F.struct(F.col("origin_id").alias("location_id"), F.col("destination_id").alias("peer"), F.lit(False).alias("inward")),
    )
    per_peer = (
        flow_edges(flows).select("window_start", "edge_trips", F.inline(sides))
        .groupBy("location_id", "window_start", "inward", "peer").agg(F.sum("edge_trips").alias("trips"))
    )
    inward = F.col("inward")
    total = lambda side: F.coalesce(F.sum(F.when(side, F.col("trips"))), F.lit(0.0))
    return per_peer.groupBy("location_id", "window_start").agg(
        total(inward).alias("inbound_trip_count"),
        F.count_if(inward).cast("double").alias("inbound_zone_count"),
        total(~inward).alias("outbound_trip_count"),
        F.count_if(~inward).cast("double").alias("outbound_zone_count"),
    ).withColumn("net_flow", F.col("inbound_trip_count") - F.col("outbound_trip_count"))


def flow_features(df: DataFrame, flows: DataFrame) -> DataFrame:
    return df.join(zone_pressure(flows), ["location_id", "window_start"], "left").fillna(0.0, FLOW_COLUMNS)


# --- trimming, splitting, assembling --------------------------------------

def trim_warm_up(df: DataFrame, lookback: int, slide_ms: int, origin: Column | None = None) -> DataFrame:
    """Drops the first ``lookback`` slots, whose history is only padding.

    ``origin`` is the first slot when the caller knows it more cheaply than by
    aggregating ``df`` itself.
    """
    first = df.agg(F.min("window_start").alias("lo")).scalar() if origin is None else origin
    return df.where(F.col("window_start") >= first + F.lit(lookback * slide_ms))


def chronological_split(df: DataFrame, fraction: float, embargo_ms: int) -> tuple[DataFrame, DataFrame]:
    """Rows before the cutoff, and rows at least one embargo after it."""
    if not 0 < fraction < 1:
        raise ValueError("fraction must be within (0, 1)")
    lo, hi = F.min("window_start"), F.max("window_start")
    cutoff = df.agg((lo + F.floor((hi - lo).cast("double") * F.lit(fraction)).cast("long")).alias("cut")).scalar()
    at = F.col("window_start")
    return df.where(at < cutoff), df.where(at >= cutoff + F.lit(embargo_ms))


def feature_names(df: DataFrame) -> list[str]:
    return sorted(c for c in df.columns if c not in NON_FEATURES)


def fit_scaler(df: DataFrame):
    """Mean and spread of every feature of ``df``, from one pass, as a stage that is stored and only applied later."""
    from pyspark.ml.feature import StandardScaler

    rows = df if "features" in df.columns else assemble_vector(df)
    return StandardScaler(inputCol="features", outputCol="scaled_features", withMean=True, withStd=True).fit(rows)


def assemble_vector(df: DataFrame, scale: bool = False, scaler=None) -> DataFrame:
    """``features`` from the sorted feature columns; a null there is an error, never a skipped row.

    ``scaler``, from ``fit_scaler`` on other rows or from storage, adds ``scaled_features``
    on the scales it was fitted on; ``scale`` alone fits one on these rows.
    """
    from pyspark.ml.feature import VectorAssembler

    out = VectorAssembler(inputCols=feature_names(df), outputCol="features", handleInvalid="error").transform(df)
    if scaler is None and scale:
        scaler = fit_scaler(out)
    return scaler.transform(out) if scaler is not None else out


def feature_profile(df: DataFrame) -> DataFrame:
    """(feature, null_count, stddev) for every feature column, from one aggregation."""
    names = feature_names(df)
    row = df.agg(*[
        F.struct(F.count_if(F.col(c).isNull()).alias("null_count"), or_zero(F.stddev_samp(c)).alias("stddev")).alias(c)
        for c in names
    ])
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`.null_count").alias("null_count"),
                               F.col(f"`{c}`.stddev").alias("stddev")) for c in names])
    return row.select(F.inline(pairs))


def feature_health(df: DataFrame) -> DataFrame:
    """Features that carry no signal (constant) or still hold nulls."""
    profile = feature_profile(df)
    return profile.select("feature", "null_count", (F.col("stddev") == 0).alias("is_constant")).where(
        (F.col("null_count") > 0) | F.col("is_constant"))


# --- composed matrices -----------------------------------------------------

def _enriched(sources: FeatureSources, cfg: FeatureConfig, start: int | None, end: int | None,
              target: bool) -> tuple[DataFrame, DataFrame]:
    demand = cut_lineage(demand_features(sources.demand, start, end))
    given = lambda frame, schema: demand.sparkSession.createDataFrame([], schema) if frame is None else frame
    scores, snapshots, flows = None, None, None
    if cfg.graph == CURRENT:
        if target:
            import warnings
            warnings.warn("current graph scores on past rows reflect later trips; backtests will look too good")
        scores = _fill_graph(_zone_side(sources.zones, given(sources.communities, NO_COMMUNITIES)))
    elif cfg.graph == SNAPSHOTS:
        snapshots = given(sources.snapshots, NO_SNAPSHOTS)
    if cfg.use_flows:
        rows = given(sources.flows, NO_FLOWS)
        flows = zone_pressure(in_days(rows, start, end).where(half_open(F.col("window_start"), start, end)))
    grid = lambda scores, snapshots, **more: on_grid(
        demand, sources.zones, cfg.slide_ms, cfg.window_seconds * 1000, cfg.min_observed, zone_values=scores, snapshots=snapshots, **more)
    matrix = grid(scores, snapshots, lags=cfg.lags, seasons=cfg.seasonal, spans=cfg.spans, horizon=cfg.horizon if target else 0, beside=flows)
    graph = [c for c in (scores if scores is not None else snapshots).columns if c not in ("location_id", "snapshot_start")] if cfg.graph != DISABLED else []
    pressure = FLOW_COLUMNS if cfg.use_flows else []
    own = [c for c in matrix.columns if c not in graph and c not in pressure]
    peers, calendar = [], None
    if "community_id" in graph:
        # Of the grid once more, but only its trips; as a table it brings its size, one row a community and slot.
        only = lambda frame, *keys: None if frame is None else frame.select(*keys, "community_id")
        later = None if snapshots is None else asof_states(snapshots).select("location_id", "snapshot_start", "community_id")
        totals = _slot_totals(grid(only(scores, "location_id"), later, keep=["trip_count"]))
        # The calendar is that of a slot, so it comes with the totals and is not worked out row by row.
        told = calendar_features(totals.withColumnRenamed("_w", "window_start"), cfg.tz).withColumnRenamed("window_start", "_w")
        calendar = [c for c in told.columns if c not in totals.columns]
        matrix = community_peers(matrix, cut_lineage(told), calendar)
        peers = ["community_peer_mean_demand", "community_demand_share"]
    if calendar is None:
        before, matrix = matrix.columns, calendar_features(matrix, cfg.tz)
        calendar = [c for c in matrix.columns if c not in before]
    return matrix.select(*own, *calendar, *graph, *peers, *pressure), demand


def training_matrix(sources: FeatureSources, cfg: FeatureConfig, start: int | None = None,
                    end: int | None = None) -> DataFrame:
    """Labelled rows past the warm-up, with the day slot."""
    matrix, demand = _enriched(sources, cfg, start, end, target=True)
    # Every active zone starts at the first demand slot, so the origin is read from
    # the narrow demand scan and not by aggregating the finished matrix.
    origin = demand.agg(F.min("window_start").alias("lo")).scalar()
    labelled = matrix.where(F.col("target_trip_count").isNotNull())
    return with_day(trim_warm_up(labelled, cfg.lookback, cfg.slide_ms, origin))


def inference_matrix(sources: FeatureSources, cfg: FeatureConfig, latest: int, slots: int = 1) -> DataFrame:
    """Unlabelled rows of the newest ``slots`` slots, their history read but not kept."""
    if slots < 1:
        raise ValueError("slots must be at least 1")
    start = latest - (cfg.lookback + slots) * cfg.slide_ms
    matrix, _ = _enriched(sources, cfg, start, latest + cfg.slide_ms, target=False)
    return with_day(matrix.where(F.col("window_start") >= latest - (slots - 1) * cfg.slide_ms))
