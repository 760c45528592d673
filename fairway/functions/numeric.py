"""IEEE-754 arithmetic under ANSI mode.

Spark's ANSI mode raises ``DIVIDE_BY_ZERO`` even for doubles, while the
metrics rely on ``x/0 = ±inf`` and ``0/0 = NaN`` (an infinite PTI is kept
and sorts first, a NaN one is dropped). ``ieee_div`` restores that without
leaving the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ieee_div(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    """``numerator / denominator`` as doubles with IEEE results for a zero
    denominator; NULL in either operand gives NULL. A zero denominator is
    taken as +0 (the denominators here are counts and sums of non-negative
    weights, which are never -0.0)."""
    a = _col(numerator).cast("double")
    b = _col(denominator).cast("double")
    zero = b == F.lit(0.0)
    return (
        F.when(~zero, a / b)
        # NaN must be tested before the sign: NaN > 0 is true in Spark.
        .when(zero & ((a == F.lit(0.0)) | F.isnan(a)), F.lit(float("nan")))
        .when(zero & (a > F.lit(0.0)), F.lit(float("inf")))
        .when(zero & (a < F.lit(0.0)), F.lit(float("-inf")))
    )


def sum0(c: ColumnOrName) -> Column:
    """Sum that is 0 (not NULL) over an empty or all-null input."""
    return F.coalesce(F.sum(_col(c)), F.lit(0))


def round_half_even(c: ColumnOrName, scale: int) -> Column:
    """Banker's rounding (``0.0625 -> 0.062`` at 3 places); inf/NaN pass through."""
    return F.bround(_col(c), scale)
