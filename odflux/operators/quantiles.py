"""Exact quantiles by rank, without one task that holds every value.

Values are folded to (value, rows) where they lie, so a value of a third of all rows
is one pair. The pairs are dealt to tasks by range and written; each range's number
of rows tells which ranges hold a wanted rank, and only those are read again, each
in a task of its own. What meets in one place is one row per range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from odflux.functions.session import cut_lineage


def _ranked_values(frame: DataFrame, value: Column, probs: Sequence[float]) -> tuple[DataFrame, DataFrame]:
    """(one row with the number of values, (rank, value) of the ranks beside each probability; ranks begin at 0)."""
    counted = frame.select(value.cast("double").alias("v")).where("v is not null").groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    placed = cut_lineage(counted.repartitionByRange("v").select("v", "n", F.spark_partition_id().alias("part")))
    sizes = placed.groupBy("part").agg(F.sum("n").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range of values
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = sizes.select("part", "rows", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"),
                           F.sum("rows").over(whole).alias("total"))
    last = (F.col("total") - 1).cast("double")
    wanted = F.array_distinct(F.flatten(F.array(*[
        F.array(F.floor(last * F.lit(float(p))), F.ceil(last * F.lit(float(p)))) for p in probs])))
    inside = lambda low, high: lambda rank: (rank >= low) & (rank < high)
    hit = offsets.select("part", "before", F.filter(wanted, inside(F.col("before"), F.col("before") + F.col("rows"))).alias("ranks"))
    upto = Window.partitionBy("part").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = placed.join(hit.where(F.size("ranks") > 0), "part").select(
        "v", "n", "ranks", (F.col("before") + F.sum("n").over(upto)).alias("end"))
    found = ranked.select("v", F.explode(F.filter("ranks", inside(F.col("end") - F.col("n"), F.col("end")))).alias("rank"))
    return sizes.agg(F.sum("rows").alias("total")), found


def exact_quantiles(frame: DataFrame, value: Column, probs: Sequence[float]) -> DataFrame:
    """One row with ``q``: the quantile of each probability, in their order, between neighbours in proportion.

    Nulls do not count; NaN is the greatest value. Without values each quantile is null.
    """
    if not probs or any(not 0 <= p <= 1 for p in probs):
        raise ValueError("probabilities must be within [0, 1], at least one")
    total, found = _ranked_values(frame, value, probs)
    # Two ranks a probability at most, so this row is small whatever the number of values.
    known = found.agg(F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("at"))
    row = known.withColumn("last", (total.scalar() - 1).cast("double"))

    def quantile(p: float) -> Column:
        place = F.col("last") * F.lit(float(p))
        low, high = F.try_element_at("at", F.floor(place)), F.try_element_at("at", F.ceil(place))
        return F.when(F.floor(place) == F.ceil(place), low).otherwise(
            low * (F.ceil(place) - place) + high * (place - F.floor(place)))

    return row.select(F.array(*[quantile(p) for p in probs]).alias("q"))
