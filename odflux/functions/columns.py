"""Small Column builders. Everything here stays inside whole-stage codegen."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MS = 86_400_000

_UNIT_MS = {"second": 1_000, "minute": 60_000, "hour": 3_600_000}
_INTERVAL = re.compile(r"\s*(\d+)\s+(second|minute|hour)s?\s*", re.IGNORECASE)


def interval_millis(text: str) -> int:
    """Length in milliseconds of ``"N second(s)|minute(s)|hour(s)"``."""
    found = _INTERVAL.fullmatch(text)
    if not found or int(found.group(1)) == 0:
        raise ValueError(f"not a positive interval of seconds, minutes or hours: {text!r}")
    return int(found.group(1)) * _UNIT_MS[found.group(2).lower()]


def round_dp(value: Column, places: int) -> Column:
    """Half-up rounding through DECIMAL, so equal inputs round equally in any engine."""
    return F.round(value.try_cast("decimal(38,8)"), places).cast("double")


def or_zero(value: Column) -> Column:
    return F.coalesce(value.cast("double"), F.lit(0.0))


def long_or_zero(value: Column) -> Column:
    return F.coalesce(value.cast("long"), F.lit(0).cast("long"))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double; 0 when the denominator is 0 or either side is null."""
    return F.coalesce(
        F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0)
    )


def day_slot(millis: Column) -> Column:
    return F.floor(millis / F.lit(DAY_MS)).cast("long")


def half_open(millis: Column, start: int | None, end: int | None) -> Column:
    """``start <= millis < end`` on the raw column, so it reaches the Parquet scan."""
    inside = F.lit(True)
    if start is not None:
        inside = inside & (millis >= F.lit(start))
    if end is not None:
        inside = inside & (millis < F.lit(end))
    return inside
