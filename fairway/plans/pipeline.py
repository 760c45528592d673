"""End-to-end metrics job: rounds -> event difficulty -> course factor ->
rolling form index for several periods, plus the two report extracts.

One grouping-sets pass over the rounds yields the event counts, wave
averages and rows per player (a small table in the shared checkpoint
folder); event difficulty and the course factor are written there once (they
feed several outputs); all periods of the rolling index come from one more
pass. The rounds are scanned twice in total.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairway.operators.difficulty import course_factor, difficulty_from_counts
from fairway.operators.form import RoundStatistics, rolling_index_multi
from fairway.operators.joins import materialize, run_scope
from fairway.plans import reports
from fairway.sources import io

PERIODS = (25, 50, 75, 100)


def sorted_for_export(df: DataFrame, *cols) -> DataFrame:
    """Global order for a CSV export (range-partitioned sort)."""
    return df.orderBy(*cols)


def run_metrics(spark: SparkSession, rounds_root: str, out_root: str,
                periods: Sequence[int] = PERIODS) -> dict[str, str]:
    with run_scope():  # frees this run's tables and cached frames only
        rounds = io.read_rounds(spark, rounds_root)
        # one pass over the rounds for event counts, wave averages, player sizes
        stats = RoundStatistics(rounds)
        difficulty = materialize(difficulty_from_counts(stats.event_counts()))
        io.write_csv(sorted_for_export(difficulty, F.col("pti").desc_nulls_first(), "year",
                                       "event_id", "course_num"), f"{out_root}/pti")
        factors = materialize(course_factor(difficulty))
        io.write_csv(sorted_for_export(factors, F.col("course_factor").desc_nulls_first(),
                                       "course_num"), f"{out_root}/course_factor")
        # factors were computed from these statistics: one row per course
        long = rolling_index_multi(rounds, factors, periods, stats=stats,
                                   factor_rows_bound=stats.summary()["course_rows"])
        io.write_form_index(long, f"{out_root}/form_index", periods)
    return {"pti": f"{out_root}/pti", "course_factor": f"{out_root}/course_factor",
            "form_index": f"{out_root}/form_index"}


def run_extracts(spark: SparkSession, out_root: str, *, period: int = 50, year: int,
                 max_days: int = 730, player: int) -> dict[str, str]:
    """Current standings and one player's trend as CSV extracts."""
    form = io.read_form_index(spark, f"{out_root}/form_index", period)
    io.write_csv(reports.current_standings(form, year, max_days, stored=True), f"{out_root}/form_current")
    io.write_csv(reports.player_trend(form, player), f"{out_root}/form_player")
    return {"form_current": f"{out_root}/form_current", "form_player": f"{out_root}/form_player"}
