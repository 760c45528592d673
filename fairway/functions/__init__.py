"""Column functions (JVM-side expressions; no UDFs)."""

from fairway.functions.numeric import ieee_div, round_half_even, sum0
from fairway.functions.rules import (
    MAJORS,
    category,
    is_major,
    slug,
    wave,
    weighted_gain,
    whole_days_between,
)

__all__ = [
    "MAJORS",
    "category",
    "ieee_div",
    "is_major",
    "round_half_even",
    "slug",
    "sum0",
    "wave",
    "weighted_gain",
    "whole_days_between",
]
