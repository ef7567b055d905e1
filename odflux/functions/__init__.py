"""Column helpers, session helpers and lineage control shared by every operator."""

from odflux.functions.columns import (
    day_slot,
    half_open,
    interval_millis,
    long_or_zero,
    or_zero,
    round_dp,
    safe_ratio,
)
from odflux.functions.session import build_session, cut_lineage, ensure_checkpoint_dir, release

__all__ = [
    "build_session",
    "cut_lineage",
    "day_slot",
    "ensure_checkpoint_dir",
    "half_open",
    "interval_millis",
    "long_or_zero",
    "or_zero",
    "release",
    "round_dp",
    "safe_ratio",
]
