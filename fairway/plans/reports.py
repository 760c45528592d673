"""Report queries over the metric datasets (event difficulty, course factor,
rolling form index). Each is a DataFrame transform; extremes use
``max_by``/``min_by`` (partial aggregation) instead of a global sort, and a
limit appears only where the report is a top-k.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairway.functions.numeric import ieee_div, round_half_even, sum0
from fairway.functions.rules import weighted_gain, whole_days_between
from fairway.operators.joins import current_scope, fits_broadcast, join_keys, join_small, materialize
from fairway.operators.sequence import row_number_checked

# Ties between events: year, event and course ascending (missing ones last),
# then names descending; with these every column of the difficulty key is part of the order.
EVENT_TIE = ("year", "event_id", "course_num")
NAME_TIE = ("event_name", "course_name")


def _event_order() -> list:
    return [F.col(c).asc_nulls_last() for c in EVENT_TIE] + [F.col(c).desc() for c in NAME_TIE]


def year_as_text(difficulty: DataFrame) -> DataFrame:
    """Event difficulty table with ``year`` as text (for categorical axes)."""
    return difficulty.withColumn("year", F.col("year").cast("string"))


def zero_high_events(difficulty: DataFrame) -> DataFrame:
    """Events with no round of 80 or more."""
    return difficulty.filter(F.col("over_80") == 0)


def easiest_event(difficulty: DataFrame) -> DataFrame:
    """The event without an 80+ round that had the most sub-70 rounds."""
    return zero_high_events(difficulty).orderBy(
        F.col("sub_70").desc(), *_event_order()).limit(1)


def overall_shares(difficulty: DataFrame) -> DataFrame:
    """Share (percent, one decimal) of all rounds at 80+ and under 70, and the number of
    events without an 80+ round; one row."""
    return difficulty.agg(
        round_half_even(F.lit(100.0) * ieee_div(sum0("over_80"), sum0("total_rounds")), 1)
        .alias("pct_over_80"),
        round_half_even(F.lit(100.0) * ieee_div(sum0("sub_70"), sum0("total_rounds")), 1)
        .alias("pct_sub_70"),
        F.count_if(F.col("over_80") == 0).alias("zero_high_events"),
    )


def majors_ranked(difficulty: DataFrame) -> DataFrame:
    """Major championships ranked by PTI (1 = hardest), ties by year, event,
    course. One ordered window only within a checked row count, else the
    distributed row number."""
    majors = difficulty.filter(F.col("major_championship"))
    order = [F.col("pti").desc_nulls_first()] + _event_order()
    return row_number_checked(majors, order, "rank")


def major_extremes(difficulty: DataFrame) -> DataFrame:
    """Hardest (rank 1) and easiest (last rank) major; two rows."""
    majors = difficulty.filter(F.col("major_championship"))
    row = F.struct("year", "event_id", "event_name", "course_name", "course_num", "pti")
    # ranking order is pti desc, then year/event/course asc
    key = F.struct(F.col("pti"), -F.col("year"), -F.col("event_id"), -F.col("course_num"), *NAME_TIE)
    picked = majors.agg(F.max_by(row, key).alias("hardest"), F.min_by(row, key).alias("easiest"))
    stacked = picked.select(F.explode(F.array(
        F.struct(F.lit("hardest").alias("kind"), F.col("hardest").alias("m")),
        F.struct(F.lit("easiest").alias("kind"), F.col("easiest").alias("m")))).alias("x"))
    return stacked.filter(F.col("x.m").isNotNull()).select(
        F.col("x.kind").alias("kind"), "x.m.*")


def venue_extremes(factors: DataFrame) -> DataFrame:
    """Hardest course, easiest course with a positive factor, how many times
    more a round is worth at the first (truncated ratio), and the hardest
    course's 80+ / sub-70 shares; one row."""
    row = F.struct("course_num", "course_name", "course_factor", "total_over_80", "total_sub_70",
                   "total_rounds")
    # ties go to the smaller course number on both ends
    hard = factors.agg(F.max_by(row, F.struct(F.col("course_factor"), -F.col("course_num")))
                       .alias("h"))
    easy = factors.filter(F.col("course_factor") > 0).agg(
        F.min_by(row, F.struct("course_factor", "course_num")).alias("e"))
    both = hard.select("h", easy.select("e").scalar().alias("e"))
    ratio = ieee_div(F.col("h.course_factor"), F.col("e.course_factor"))
    return both.select(
        F.col("h.course_num").alias("hardest_course_num"),
        F.col("h.course_name").alias("hardest_course"),
        F.col("h.course_factor").alias("hardest_factor"),
        F.col("e.course_num").alias("easiest_course_num"),
        F.col("e.course_name").alias("easiest_course"),
        F.col("e.course_factor").alias("easiest_factor"),
        # int() truncation; inf/NaN have no integer value
        F.when(F.abs(ratio) < F.lit(9.0e18), ratio.cast("long")).alias("factor_ratio"),
        round_half_even(F.lit(100.0) * ieee_div(F.col("h.total_over_80"), F.col("h.total_rounds")), 1)
        .alias("hardest_pct_over_80"),
        round_half_even(F.lit(100.0) * ieee_div(F.col("h.total_sub_70"), F.col("h.total_rounds")), 1)
        .alias("hardest_pct_sub_70"),
    )


def venue_rank(factors: DataFrame) -> DataFrame:
    """Ordinal rank of courses by factor, descending (1 = hardest); ties by
    course number; a NULL factor gets a NULL rank."""
    known = factors.filter(F.col("course_factor").isNotNull()).select(
        "course_num", "course_factor")
    ranked = row_number_checked(
        known, [F.col("course_factor").desc(), F.col("course_num").asc()], "rank")
    unknown = factors.filter(F.col("course_factor").isNull()).select(
        "course_num", "course_factor", F.lit(None).cast("long").alias("rank"))
    return ranked.select("course_num", "course_factor", "rank").unionByName(unknown)


def score_distribution(rounds: DataFrame, factors: DataFrame) -> DataFrame:
    """Per course and score: rounds, percent of the course's rounds, the
    course's rank and factor, and ``log10(1 + factor)``. NULL scores are a
    score group of their own; courses without a factor keep NULLs.

    Counts are pre-aggregated (map-side) before any shuffle; course totals
    come from a window over that histogram (one row per distinct score of a
    course, so a hot course is still a small group); ranks are a small
    dimension joined after a size check.
    """
    from pyspark.sql import Window

    counts = rounds.groupBy("course_num", "score").agg(F.count(F.lit(1)).alias("rounds"))
    shares = counts.withColumn("__course_rounds",
                               F.sum("rounds").over(Window.partitionBy("course_num")))
    ranks = venue_rank(factors)
    out = join_small(shares, ranks, ["course_num"], "left")
    return out.select(
        "course_num", "score", "rounds",
        (F.lit(100.0) * ieee_div(F.col("rounds"), F.col("__course_rounds"))).alias("pct_of_rounds"),
        "rank", "course_factor",
        F.log10(F.lit(1.0) + F.col("course_factor")).alias("log_course_factor"))


def score_share_rows(rounds: DataFrame, factors: DataFrame) -> DataFrame:
    """Every round with ``count`` (percent of its course's rounds that had
    the same score), its course's rank and factor, and ``log10(1 + factor)``
    — the row-level frame behind the score-distribution chart.

    The shares come from the pre-aggregated histogram (bounded by courses x
    distinct scores) joined back after a size check, instead of two window
    counts over each course, which would put a hot course in one task.
    """
    shares = score_distribution(rounds, factors).select(
        "course_num", "score", F.col("pct_of_rounds").alias("count"), "rank", "course_factor",
        "log_course_factor")
    out = join_small(rounds, shares, ["course_num", "score"], "left", null_safe=True)
    return out.select(*rounds.columns, "count", "rank", "course_factor", "log_course_factor")


def venue_median(rounds: DataFrame) -> DataFrame:
    """Exact median score per course (mean of the two middle values for an
    even count), from a per-course score histogram: the values of a hot
    course are never gathered in one buffer."""
    hist = rounds.filter(F.col("score").isNotNull()).groupBy("course_num", "score").agg(
        F.count(F.lit(1)).alias("__n"))
    from pyspark.sql import Window

    w = Window.partitionBy("course_num").orderBy("score")
    cum = hist.select(
        "course_num", "score", "__n",
        F.sum("__n").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("__hi"),
        F.sum("__n").over(Window.partitionBy("course_num")).alias("__total"))
    lo_pos = F.floor((F.col("__total") + 1) / 2)   # 1-based middle positions
    hi_pos = F.floor(F.col("__total") / 2) + 1
    covers = lambda pos: (F.col("__hi") - F.col("__n") < pos) & (F.col("__hi") >= pos)
    picked = cum.groupBy("course_num").agg(
        F.max(F.when(covers(lo_pos), F.col("score"))).alias("__lo"),
        F.max(F.when(covers(hi_pos), F.col("score"))).alias("__hi_v"),
        F.first("__total").alias("rounds"))
    return picked.select("course_num", "rounds",
                         ((F.col("__lo") + F.col("__hi_v")) / F.lit(2.0)).alias("median_score"))


# Size of a quantile sketch, and the rank error that its quantiles keep within:
# at k = 1000 the error is below 0.28 % of the values with 99 % confidence, and
# 1 % is more than three times that.
SKETCH_K = 1000
RANK_ERROR = 0.01


def quantile_sketches(rows: DataFrame, value: str, *keys: str, k: int = SKETCH_K) -> DataFrame:
    """A mergeable sketch (``sketch``) of the values of each group, for values
    that have no bounded histogram; NULL and NaN are no values. Partial aggregation
    merges sketches of a few kilobytes, whatever the size of a group."""
    values = rows.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    return values.groupBy(*keys).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), k).alias("sketch"))


def merged_sketches(sketches: DataFrame, *keys: str) -> DataFrame:
    """One sketch for each group out of several (of batches, years, files)."""
    return sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch").alias("sketch"))


def sketched_quantile(sketches: DataFrame, q: float, name: str = "quantile") -> DataFrame:
    """``sketches`` with the number of values (``n``) and their ``q`` quantile,
    whose rank is within ``RANK_ERROR`` of ``q`` (``SKETCH_K`` and larger)."""
    return sketches.select(*[c for c in sketches.columns if c != "sketch"],
                           F.kll_sketch_get_n_double("sketch").alias("n"),
                           F.kll_sketch_get_quantile_double("sketch", F.lit(float(q))).alias(name))


def rank_of(rows: DataFrame, value: str, quantiles: DataFrame, name: str, *keys: str) -> DataFrame:
    """``quantiles`` (one row a group) with the shares of each group's values below
    (``below``) and up to (``up_to``) the quantile: exact, by one pass over the rows."""
    values = rows.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    joined = join_small(values.select(*keys, F.col(value).alias("__v")), quantiles, list(keys), "inner", null_safe=True)
    n = F.count(F.lit(1))
    shares = joined.groupBy(*keys).agg(ieee_div(F.count_if(F.col("__v") < F.col(name)), n).alias("below"),
                                       ieee_div(F.count_if(F.col("__v") <= F.col(name)), n).alias("up_to"))
    return join_small(quantiles, shares, list(keys), "inner", null_safe=True)


def _in_year(ts: str, year: int):
    """Calendar-year test written as a half-open range so it reaches the
    Parquet reader as a pushed filter (``year(ts) = k`` does not)."""
    # bounds from text: no Python local-time or session-zone conversion
    start = F.lit(f"{year:04d}-01-01 00:00:00").cast("timestamp_ntz")
    end = F.lit(f"{year + 1:04d}-01-01 00:00:00").cast("timestamp_ntz")
    return (F.col(ts) >= start) & (F.col(ts) < end)


def no_impact_rounds(form: DataFrame, year: int) -> DataFrame:
    """Rounds in ``year`` at zero-factor courses (they carry no weight)."""
    return form.filter((F.col("course_factor_star") == 0.0) & _in_year("teetime", year)).select(
        F.col("player_name").alias("Name"), F.col("score").alias("Score"),
        F.col("event_name").alias("Event"))


def no_impact_top(form: DataFrame, year: int, k: int = 10) -> DataFrame:
    """The ``k`` lowest such rounds (top-k report)."""
    return no_impact_rounds(form, year).orderBy("Score", "Name", "Event").limit(k)


def no_impact_count(form: DataFrame, year: int, below: int = 65) -> DataFrame:
    return no_impact_rounds(form, year).agg(
        F.count_if(F.col("Score") < below).alias("rounds_below"))


def latest_per_player(form: DataFrame, stored: bool = False) -> DataFrame:
    """Each player's latest form row (by tee time). The form rows are written
    once, unless they are ``stored`` already: they are read twice, never framed
    twice. The latest time is a fixed-width ``max`` (hash aggregation with
    map-side combine); the rows are fetched by a hash join, broadcast within the
    checked size and shuffled beyond, so form rows are never sorted. About one row
    per player is left, of which ``max_by`` takes the last by name and window start."""
    form = form if stored else materialize(form, "form")
    cols = [c for c in form.columns if c != "dg_id"]
    times = form.groupBy("dg_id").agg(F.max("teetime").alias("teetime"))
    times = current_scope().keep(times.persist(StorageLevel.MEMORY_AND_DISK))
    fits = fits_broadcast(times, times.count())
    last = join_keys(form, times if fits else times.hint("shuffle_hash"), ["dg_id", "teetime"], "inner",
                     broadcast_right=fits, null_safe=True)
    order = F.struct("player_name", "first_tee_time_in_group",
                     *[c for c in cols if c not in ("player_name", "first_tee_time_in_group")])
    latest = last.groupBy("dg_id").agg(F.max_by(F.struct(*cols), order).alias("__r"))
    return latest.select("dg_id", *[F.col(f"__r.{c}").alias(c) for c in cols]).select(
        *form.columns)


def current_standings(form: DataFrame, year: int, max_days: int, stored: bool = False) -> DataFrame:
    """Latest row per player, kept when it falls in ``year`` and its window
    spans at most ``max_days`` whole days. Filters apply after taking the
    latest row, as in the source report."""
    latest = latest_per_player(form, stored)
    return latest.filter(
        _in_year("teetime", year)
        & (whole_days_between("first_tee_time_in_group", "teetime") <= max_days))


def largest_gap(standings: DataFrame) -> DataFrame:
    """The player whose index trails strokes gained the most (lowest
    ``ppi - sg_total``), NaN and NULL excluded; top-1 report."""
    return standings.filter(F.col("ppi_sg_diff").isNotNull() & ~F.isnan("ppi_sg_diff")) \
        .orderBy(F.col("ppi_sg_diff").asc(), F.col("dg_id").asc()).limit(1)


def player_trend(form: DataFrame, dg_id: int) -> DataFrame:
    """One player's form rows in time order with the per-round weighted gain."""
    return form.filter(F.col("dg_id") == dg_id).withColumn(
        "weighted_score", weighted_gain()).orderBy("teetime")


def trend_bounds(trend: DataFrame, pad_days: int = 120) -> DataFrame:
    """Time bounds of a trend (the upper one padded for a chart)."""
    return trend.agg(F.min("teetime").alias("start"),
                     (F.max("teetime") + F.make_dt_interval(F.lit(pad_days))).alias("end"))
