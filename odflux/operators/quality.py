"""Key and null checks that a storage constraint would otherwise make."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dq_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their counts. Nulls are not keys."""
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return (df.where(present).groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
            .where(F.col("row_count") > 1))


def dq_not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """Null count per column, one scan, in long form."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return counted.unpivot([], cols, "column_name", "null_count")
