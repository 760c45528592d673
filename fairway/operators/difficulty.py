"""Event difficulty (high/low round ratio) and the course factor.

Both are plain partial+final aggregations. The course factor needs the
totals over all courses; they enter as one uncorrelated scalar subquery
(computed once, inlined as a literal), so no join and no single-partition
window is involved. The per-course table (one row per course) is cached, so
the subquery reads it instead of scanning the rounds a second time.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairway.operators import joins

from fairway.functions.numeric import ieee_div, round_half_even, sum0
from fairway.functions.rules import HIGH_SCORE, LOW_SCORE, is_major

EVENT_KEYS = ("year", "event_id", "event_name", "course_name", "course_num")


def event_difficulty(rounds: DataFrame) -> DataFrame:
    """Per event and course: counts of high (>= 80) and low (< 70) rounds, all
    rounds (NULL scores included), mean score, the ratio high/low rounded
    half-even to 3 places and the major flag.

    ``x/0`` stays ``inf`` (kept); ``0/0`` is NaN and the row is dropped, as
    is any row whose mean is NaN.
    """
    return difficulty_from_counts(rounds.groupBy(*EVENT_KEYS).agg(*event_count_columns()))


def event_count_columns() -> list:
    """The per-event aggregates (usable in any grouping)."""
    return [
        F.count_if(F.col("score") >= HIGH_SCORE).alias("over_80"),
        F.count_if(F.col("score") < LOW_SCORE).alias("sub_70"),
        F.count(F.lit(1)).alias("total_rounds"),
        F.avg("score").alias("scoring_average"),
    ]


def difficulty_from_counts(agg: DataFrame) -> DataFrame:
    """Ratio, major flag and NaN filter over per-event counts (``EVENT_KEYS``
    plus the ``event_count_columns``)."""
    out = agg.select(
        *EVENT_KEYS,
        "over_80",
        "sub_70",
        "total_rounds",
        "scoring_average",
        round_half_even(ieee_div("over_80", "sub_70"), 3).alias("pti"),
        is_major("event_id").alias("major_championship"),
    )
    return out.filter(~F.isnan("pti") & ~F.isnan("scoring_average"))


def course_factor(difficulty: DataFrame) -> DataFrame:
    """Course-level factor ``100 * (high/low here) / (high/low elsewhere)`` and
    its log compression ``log10(1 + factor)``.

    ``course_name`` is the name at the course's hardest event (highest PTI,
    then latest year and event id), which is deterministic across shuffles.
    """
    by_course = difficulty.groupBy("course_num").agg(
        F.max_by("course_name", F.struct("pti", "year", "event_id")).alias("course_name"),
        sum0("over_80").alias("total_over_80"),
        sum0("sub_70").alias("total_sub_70"),
        sum0("total_rounds").alias("total_rounds"),
        ieee_div(F.coalesce(F.sum(F.col("scoring_average") * F.col("total_rounds")), F.lit(0.0)),
                 sum0("total_rounds")).alias("scoring_average"),
    )
    by_course = by_course.persist(StorageLevel.MEMORY_AND_DISK)
    joins.current_scope().keep(by_course)
    # Totals over every course: one scalar subquery returning both sums.
    totals = by_course.agg(F.struct(sum0("total_over_80").alias("o"),
                                    sum0("total_sub_70").alias("s"))).scalar()
    all_over, all_sub = totals.getField("o"), totals.getField("s")
    with_others = by_course.select(
        "course_num", "course_name", "total_over_80", "total_sub_70", "total_rounds",
        "scoring_average",
        (all_over - F.col("total_over_80")).alias("other_over_80"),
        (all_sub - F.col("total_sub_70")).alias("other_sub_70"),
    )
    # Each ratio is its own column so the IEEE division never repeats the
    # subquery operands inside its branches.
    ratios = with_others.select(
        "*",
        ieee_div("total_over_80", "total_sub_70").alias("__here"),
        ieee_div("other_over_80", "other_sub_70").alias("__elsewhere"))
    factor = F.lit(100) * ieee_div("__here", "__elsewhere")
    return ratios.select(*with_others.columns, factor.alias("course_factor"),
                         F.log10(F.lit(1.0) + factor).alias("course_factor_star"))
