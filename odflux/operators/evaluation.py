"""Regression metrics, baselines, residual quantiles, fold bounds and interval arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odflux.functions.columns import or_zero
from odflux.operators.quantiles import exact_quantiles

LABEL = "target_trip_count"
DEVIANCE_FLOOR = 1e-9


def forecast_metrics(df: DataFrame, label: str = LABEL, prediction: str = "prediction", also: dict[str, Column] | None = None) -> DataFrame:
    """All error measures from one pass over the rows; zeros on an empty frame. ``also`` are further aggregates of that pass."""
    also = also or {}
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    e = p - y
    q = F.greatest(p, F.lit(DEVIANCE_FLOOR))
    relative = or_zero(F.try_divide(F.abs(e), F.abs(y) + F.abs(p)))
    deviance = 2.0 * (F.when(y > 0, y * F.log(y / q)).otherwise(0.0) - (y - q))
    sums = df.agg(
        F.count(F.lit(1)).alias("row_count"), F.sum(y).alias("sy"), F.sum(y * y).alias("syy"), F.sum(p).alias("sp"),
        F.sum(e * e).alias("see"), F.sum(F.abs(e)).alias("sae"), F.sum(relative).alias("srel"),
        F.sum(deviance).alias("sdev"), *[c.alias(name) for name, c in also.items()],
    )
    n = F.col("row_count").cast("double")
    per_row = lambda c: or_zero(F.try_divide(F.col(c), n))
    spread = F.col("syy") - F.try_divide(F.col("sy") * F.col("sy"), n)
    return sums.select(
        "row_count",
        F.sqrt(per_row("see")).alias("rmse"),
        per_row("sae").alias("mae"),
        F.when(spread > 0, 1.0 - F.col("see") / spread).otherwise(0.0).alias("r2"),
        (200.0 * per_row("srel")).alias("smape"),
        per_row("sdev").alias("poisson_deviance"),
        per_row("sy").alias("mean_label"),
        per_row("sp").alias("mean_prediction"),
        *also,
    ).select(
        "*",
        (F.col("mean_prediction") - F.col("mean_label")).alias("bias"),
        F.when(F.col("mean_label") > 0, F.col("rmse") / F.col("mean_label")).otherwise(0.0).alias("normalised_rmse"),
    )


def metrics_by_zone(df: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    e = (F.col(prediction) - F.col(label)).cast("double")
    return df.groupBy("location_id").agg(
        F.count(F.lit(1)).alias("row_count"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
        F.avg(e).alias("bias"), F.avg(label).alias("mean_label"),
    ).withColumn(
        "normalised_rmse", F.when(F.col("mean_label") > 0, F.col("rmse") / F.col("mean_label")).otherwise(0.0)
    ).orderBy(F.desc("rmse"), "location_id")


def baseline_metrics(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Seasonal naive: the same slot a day before; without that column, the current count."""
    naive = "trip_count_lag_day" if "trip_count_lag_day" in df.columns else "trip_count"
    return forecast_metrics(df, label, naive)


def skill_score(model: DataFrame, baseline: DataFrame) -> DataFrame:
    """Share of the baseline's rmse that the model removes; both frames are one metrics row."""
    base = model.select(F.col("rmse").alias("model_rmse")).withColumn(
        "baseline_rmse", baseline.select("rmse").scalar())
    return base.withColumn("skill", skill(F.col("model_rmse"), F.col("baseline_rmse")))


def skill(model_rmse: Column, baseline_rmse: Column) -> Column:
    return F.when(baseline_rmse <= 0, 0.0).otherwise(1.0 - model_rmse / baseline_rmse)


def residual_quantiles(df: DataFrame, probs=(0.05, 0.5, 0.95), exact: bool = False, label: str = LABEL,
                       prediction: str = "prediction") -> DataFrame:
    """(probability, residual) of prediction minus label; a mergeable sketch, or ranks over all rows if ``exact``."""
    residual = (F.col(prediction) - F.col(label)).cast("double")
    wanted = F.array(*[F.lit(float(p)) for p in probs])
    row = exact_quantiles(df, residual, probs) if exact else df.where(residual.isNotNull()).agg(
        F.percentile_approx(residual, wanted, 1000).alias("q"))
    return row.select(F.inline(F.arrays_zip(wanted.alias("probability"), F.col("q").alias("residual"))))


def fold_bounds(df: DataFrame, folds: int = 4, embargo_ms: int = 900_000) -> DataFrame:
    """(fold, train_cutoff, validation_start, validation_end) of equal expanding blocks."""
    if folds < 1:
        raise ValueError("folds must be at least 1")
    span = df.agg(F.min("window_start").alias("lo"), F.max("window_start").alias("hi"))
    block = F.floor((F.col("hi") - F.col("lo")) / F.lit(folds + 1)).cast("long")
    cut = F.col("lo") + F.col("block") * F.col("fold")
    return (
        span.withColumn("block", block).withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(folds))))
        .select("fold", cut.alias("train_cutoff"), (cut + F.lit(embargo_ms)).alias("validation_start"),
                (cut + F.col("block")).alias("validation_end"))
    )


def validation_report(folds: DataFrame) -> DataFrame:
    """Roll-up of fold rows (rmse, mae, skill)."""
    return folds.agg(
        F.count(F.lit(1)).alias("folds"),
        or_zero(F.avg("rmse")).alias("mean_rmse"), or_zero(F.avg("mae")).alias("mean_mae"),
        or_zero(F.avg("skill")).alias("mean_skill"), or_zero(F.stddev_samp("rmse")).alias("rmse_stddev"),
    ).withColumn("beats_baseline", F.col("mean_skill") > 0)


def forecast_intervals(predictions: DataFrame, q_low: float | Column, q_high: float | Column, clamp: bool = True) -> DataFrame:
    """Forecast, its rounding, and bounds that lie as far below and above as past errors did.

    Errors count as prediction less label; a model that errs upwards by ``q_high`` may
    stand that much too high now. With ``clamp`` nothing falls below zero trips.
    """
    floor = (lambda c: F.greatest(c, F.lit(0.0))) if clamp else (lambda c: c)
    as_column = lambda v: v if isinstance(v, Column) else F.lit(float(v))
    p = floor(F.col("prediction"))
    kept = [c for c in ("location_id", "window_start", "target_window_start", "trip_count") if c in predictions.columns]
    return predictions.select(
        *kept,
        p.alias("forecast_trip_count"),
        F.round(p, 0).cast("long").alias("forecast_trip_count_rounded"),
        floor(p - as_column(q_high)).alias("forecast_lower_bound"),
        floor(p - as_column(q_low)).alias("forecast_upper_bound"),
    )


def attribution_share(importances: DataFrame, group: list[str]) -> DataFrame:
    """Share of total importance carried by the features in ``group``, and how many carry none."""
    value = F.col("importance")
    inside = F.col("feature").isin(*group)
    return importances.agg(
        or_zero(F.try_divide(F.sum(F.when(inside, value).otherwise(0.0)), F.sum(value))).alias("group_share"),
        F.count_if(value <= 0).alias("unused_features"),
    )
