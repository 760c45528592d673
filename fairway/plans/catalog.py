"""Registry of driver queries (Spark) and their DuckDB oracle SQL.

Each query takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
driver's tables. Computed doubles are rounded to 6 places here (and in the
SQL) only to absorb summation-order noise between the two engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fairway.operators import difficulty, joins
from fairway.sources import testdata
from fairway.sources.testdata import DENSE_ROUNDS_SQL, LANDED_ROUNDS_SQL, REPORT_ROUNDS_SQL, ROUNDS_SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _fresh(fn):
    """Frames that earlier queries cached outside any run scope are released
    first (they are only recomputed if their query is still read)."""
    def run(spark, sf_dir):
        while joins._DEFAULT.frames:
            joins._DEFAULT.frames.pop().unpersist()
        return fn(spark, sf_dir)
    return run


def register(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = _fresh(fn)
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return wrap


def rnd(c):
    """Two-stage rounding (9 then 6 places): summation-order noise near a
    6-place tie settles the same way in both engines; ``+ 0.0`` folds -0.0."""
    return F.round(F.round(c, 9), 6) + F.lit(0.0)


def R(expr: str) -> str:
    """SQL twin of ``rnd``."""
    return f"(round(round({expr}, 9), 6) + 0.0)"


def r6(df: DataFrame) -> DataFrame:
    """Round every double column (inf/NaN pass through)."""
    return df.select([rnd(F.col(f.name)).alias(f.name)
                      if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
                      for f in df.schema.fields])


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# ---------------------------------------------------------------- difficulty
DIFFICULTY_SQL = """difficulty AS (
  SELECT year, event_id, event_name, course_name, course_num, over_80, sub_70, total_rounds,
         scoring_average, pti, major_championship
  FROM (
    SELECT year, event_id, event_name, course_name, course_num,
           count(*) FILTER (WHERE score >= 80) AS over_80,
           count(*) FILTER (WHERE score < 70) AS sub_70,
           count(*) AS total_rounds,
           avg(score) AS scoring_average,
           round_even(CAST(count(*) FILTER (WHERE score >= 80) AS DOUBLE)
                      / count(*) FILTER (WHERE score < 70), 3) AS pti,
           coalesce(event_id IN (14, 536, 33, 26, 100), false) AS major_championship
    FROM rounds
    GROUP BY year, event_id, event_name, course_name, course_num)
  WHERE NOT coalesce(isnan(pti), false) AND NOT coalesce(isnan(scoring_average), false))"""

COURSE_FACTOR_SQL = """course_agg AS (
  SELECT course_num,
         arg_max(course_name, (pti, year, event_id)) AS course_name,
         CAST(coalesce(sum(over_80), 0) AS BIGINT) AS total_over_80,
         CAST(coalesce(sum(sub_70), 0) AS BIGINT) AS total_sub_70,
         CAST(coalesce(sum(total_rounds), 0) AS BIGINT) AS total_rounds,
         coalesce(sum(scoring_average * total_rounds), 0.0) / coalesce(sum(total_rounds), 0)
           AS scoring_average
  FROM difficulty GROUP BY course_num),
course_factor AS (
  SELECT course_num, course_name, total_over_80, total_sub_70, total_rounds, scoring_average,
         other_over_80, other_sub_70,
         100 * ((CAST(total_over_80 AS DOUBLE) / total_sub_70)
                / (CAST(other_over_80 AS DOUBLE) / other_sub_70)) AS course_factor,
         log10(1.0 + 100 * ((CAST(total_over_80 AS DOUBLE) / total_sub_70)
                / (CAST(other_over_80 AS DOUBLE) / other_sub_70))) AS course_factor_star
  FROM (SELECT c.*,
               (SELECT CAST(coalesce(sum(over_80), 0) AS BIGINT) FROM difficulty) - total_over_80 AS other_over_80,
               (SELECT CAST(coalesce(sum(sub_70), 0) AS BIGINT) FROM difficulty) - total_sub_70 AS other_sub_70
        FROM course_agg c))"""


def rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testdata.rounds(spark, sf_dir)


def difficulty_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return difficulty.event_difficulty(rounds(spark, sf_dir))


def course_factor_of(spark: SparkSession, sf_dir: str, source: DataFrame | None = None
                     ) -> DataFrame:
    src = source if source is not None else rounds(spark, sf_dir)
    return difficulty.course_factor(difficulty.event_difficulty(src))


@register("event_difficulty", _with(ROUNDS_SQL, DIFFICULTY_SQL) + """
SELECT year, event_id, event_name, course_name, course_num, over_80, sub_70, total_rounds,
       (round(round(scoring_average, 9), 6) + 0.0) AS scoring_average, pti, major_championship
FROM difficulty""")
def q_event_difficulty(spark, sf_dir):
    return r6(difficulty_of(spark, sf_dir))


@register("course_factor", _with(ROUNDS_SQL, DIFFICULTY_SQL, COURSE_FACTOR_SQL) + """
SELECT course_num, course_name, total_over_80, total_sub_70, total_rounds,
       (round(round(scoring_average, 9), 6) + 0.0) AS scoring_average, other_over_80, other_sub_70,
       (round(round(course_factor, 9), 6) + 0.0) AS course_factor, (round(round(course_factor_star, 9), 6) + 0.0) AS course_factor_star
FROM course_factor""")
def q_course_factor(spark, sf_dir):
    return r6(course_factor_of(spark, sf_dir))


# ------------------------------------------------------------ rolling index
from fairway.operators import form  # noqa: E402

SCORED_SQL = """scored AS (
  SELECT r.*, cf.course_factor_star,
         CASE WHEN hour(r.teetime) < 12 THEN 'morning' ELSE 'afternoon' END AS wave
  FROM rounds r LEFT JOIN course_factor cf ON r.course_num = cf.course_num
  WHERE r.score IS NOT NULL),
waved AS (
  SELECT *, avg(score) OVER (PARTITION BY event_id, year, round, wave) AS wave_average,
         row_number() OVER (ORDER BY dg_id NULLS FIRST, teetime NULLS FIRST, year NULLS FIRST,
                                     event_id NULLS FIRST, round NULLS FIRST,
                                     player_name NULLS FIRST, course_num NULLS FIRST,
                                     score NULLS FIRST, event_name NULLS FIRST,
                                     sg_total NULLS FIRST) AS idx
  FROM scored)"""


def _framed_sql(p: int) -> str:
    return f"""framed_{p} AS (
  SELECT dg_id, player_name, teetime, score, event_name, wave_average, course_factor_star,
         coalesce(sum((wave_average - score) * course_factor_star) OVER w, 0.0)
           / coalesce(sum(course_factor_star) OVER w, 0.0) AS ppi,
         first_value(teetime) OVER w AS first_tee_time_in_group,
         count(*) OVER w AS n,
         avg(sg_total) OVER w AS sg_total
  FROM waved
  WINDOW w AS (PARTITION BY dg_id, player_name ORDER BY idx
               RANGE BETWEEN {p - 1} PRECEDING AND CURRENT ROW))"""


def _period_select(p: int, with_period: bool = False) -> str:
    period = f"CAST({p} AS BIGINT) AS period, " if with_period else ""
    return f"""SELECT {period}dg_id, player_name, (round(round(ppi, 9), 6) + 0.0) AS ppi, teetime,
       first_tee_time_in_group, (round(round(sg_total, 9), 6) + 0.0) AS sg_total, score, event_name,
       (round(round(wave_average, 9), 6) + 0.0) AS wave_average, (round(round(course_factor_star, 9), 6) + 0.0) AS course_factor_star,
       CASE WHEN sg_total >= 0 AND ppi > sg_total THEN 'Proper Player'
            WHEN sg_total >= 0 AND ppi <= sg_total THEN 'Imposter'
            WHEN sg_total < 0 AND ppi > sg_total THEN 'Gamer'
            ELSE 'Mule' END AS category,
       (round(round(ppi - sg_total, 9), 6) + 0.0) AS ppi_sg_diff
FROM framed_{p} WHERE n = {p}"""


def _form_cte(p: int) -> str:
    """Unrounded form-index dataset for period ``p`` (needs framed_p)."""
    return f"""form_{p} AS (
  SELECT dg_id, player_name, ppi, teetime, first_tee_time_in_group, sg_total, score, event_name,
         wave_average, course_factor_star,
         CASE WHEN sg_total >= 0 AND ppi > sg_total THEN 'Proper Player'
              WHEN sg_total >= 0 AND ppi <= sg_total THEN 'Imposter'
              WHEN sg_total < 0 AND ppi > sg_total THEN 'Gamer'
              ELSE 'Mule' END AS category,
         ppi - sg_total AS ppi_sg_diff
  FROM framed_{p} WHERE n = {p})"""


def _form_ctes(p: int, rounds_sql: str = ROUNDS_SQL) -> list[str]:
    return [rounds_sql, DIFFICULTY_SQL, COURSE_FACTOR_SQL, SCORED_SQL, _framed_sql(p),
            _form_cte(p)]


def _rolling_ctes(periods, rounds_sql=ROUNDS_SQL) -> list[str]:
    return [rounds_sql, DIFFICULTY_SQL, COURSE_FACTOR_SQL, SCORED_SQL, *map(_framed_sql, periods)]


def _rolling_sql(periods, with_period=False, rounds_sql=ROUNDS_SQL) -> str:
    return _with(*_rolling_ctes(periods, rounds_sql)) + "\nUNION ALL\n".join(_period_select(p, with_period) for p in periods)


def rolling_inputs(spark, sf_dir, src=None):
    """Rounds, course factors and the one-pass round statistics."""
    src = rounds(spark, sf_dir) if src is None else src
    stats = form.RoundStatistics(src)
    factors = difficulty.course_factor(difficulty.difficulty_from_counts(stats.event_counts()))
    return src, factors, stats


def rolling_of(spark, sf_dir, period, src=None):
    src, factors, stats = rolling_inputs(spark, sf_dir, src)
    # factors come from these statistics: one row per course
    return form.rolling_index(src, factors, period, stats=stats,
                              factor_rows_bound=stats.summary()["course_rows"])


def _rolling_query(p):
    def q(spark, sf_dir):
        return r6(rolling_of(spark, sf_dir, p))
    q.__name__ = f"q_rolling_index_{p}"
    return q


for _p in (10, 25, 50):
    register(f"rolling_index_{_p}", _rolling_sql([_p]))(_rolling_query(_p))

MULTI_PERIODS = (10, 25, 50)


@register("rolling_index_multi", _rolling_sql(MULTI_PERIODS, with_period=True))
def q_rolling_index_multi(spark, sf_dir):
    src, factors, stats = rolling_inputs(spark, sf_dir)
    return r6(form.rolling_index_multi(src, factors, MULTI_PERIODS, stats=stats,
                                       factor_rows_bound=stats.summary()["course_rows"]))


@register("rolling_index_dense", _rolling_sql((60, 100), with_period=True, rounds_sql=DENSE_ROUNDS_SQL))
def q_rolling_index_dense(spark, sf_dir):
    """Long periods over long histories: frames made by block scans."""
    src, factors, stats = rolling_inputs(spark, sf_dir, testdata.dense_rounds(spark, sf_dir))
    return r6(form.rolling_index_multi(src, factors, (60, 100), stats=stats,
                                       factor_rows_bound=stats.summary()["course_rows"]))


@register("wave_average", _with(ROUNDS_SQL) + """
SELECT year, event_id, dg_id, player_name, round, teetime, score, wave,
       (round(round(avg(score) OVER (PARTITION BY event_id, year, round, wave), 9), 6) + 0.0) AS wave_average
FROM (SELECT *, CASE WHEN hour(teetime) < 12 THEN 'morning' ELSE 'afternoon' END AS wave
      FROM rounds WHERE score IS NOT NULL)""")
def q_wave_average(spark, sf_dir):
    df = form.with_wave_average(rounds(spark, sf_dir))
    return r6(df.select("year", "event_id", "dg_id", "player_name", "round", "teetime", "score",
                        "wave", "wave_average"))


@register("weighted_index_by_course", _with(ROUNDS_SQL, DIFFICULTY_SQL, COURSE_FACTOR_SQL,
                                            SCORED_SQL) + """
SELECT course_num, count(*) AS rounds,
       (round(round(coalesce(sum((wave_average - score) * course_factor_star), 0.0)
             / coalesce(sum(course_factor_star), 0.0), 9), 6) + 0.0) AS ppi
FROM waved GROUP BY course_num""")
def q_weighted_index_by_course(spark, sf_dir):
    src = rounds(spark, sf_dir)
    prepared = form.prepare_rounds(src, course_factor_of(spark, sf_dir, src))
    out = prepared.groupBy("course_num").agg(
        F.count(F.lit(1)).alias("rounds"),
        form.weighted_index(F.col("score"), F.col("wave_average"),
                            F.col("course_factor_star")).alias("ppi"))
    return r6(out)


# ------------------------------------------------------------------ reports
from fairway.plans import reports  # noqa: E402

# Report parameters for the driver data (tee times fall in January 2023 and 2024).
REPORT_YEAR = 2024
MAX_DAYS = 18
FORM_PERIOD = 25
TREND_PLAYER = 7

DIFF_COLS = ("year, event_id, event_name, course_name, course_num, over_80, sub_70, "
             "total_rounds, " + R("scoring_average") + " AS scoring_average, pti, "
             "major_championship")
FORM_COLS = ", ".join(
    [c if c in ("dg_id", "player_name", "teetime", "first_tee_time_in_group", "score",
                "event_name", "category") else f"{R(c)} AS {c}"
     for c in ("dg_id", "player_name", "ppi", "teetime", "first_tee_time_in_group", "sg_total",
               "score", "event_name", "wave_average", "course_factor_star", "category",
               "ppi_sg_diff")])
YEAR_RANGE = (f"teetime >= TIMESTAMP '{REPORT_YEAR}-01-01' "
              f"AND teetime < TIMESTAMP '{REPORT_YEAR + 1}-01-01'")


def form_of(spark, sf_dir):
    return rolling_of(spark, sf_dir, FORM_PERIOD, testdata.report_rounds(spark, sf_dir))


@register("year_as_text", _with(ROUNDS_SQL, DIFFICULTY_SQL) + f"""
SELECT CAST(year AS VARCHAR) AS year, event_id, event_name, course_name, course_num, over_80,
       sub_70, total_rounds, {R("scoring_average")} AS scoring_average, pti, major_championship
FROM difficulty""")
def q_year_as_text(spark, sf_dir):
    return r6(reports.year_as_text(difficulty_of(spark, sf_dir)))


@register("zero_high_events", _with(ROUNDS_SQL, DIFFICULTY_SQL) + f"""
SELECT {DIFF_COLS} FROM difficulty WHERE over_80 = 0""")
def q_zero_high_events(spark, sf_dir):
    return r6(reports.zero_high_events(difficulty_of(spark, sf_dir)))


@register("easiest_event", _with(ROUNDS_SQL, DIFFICULTY_SQL) + f"""
SELECT {DIFF_COLS} FROM difficulty WHERE over_80 = 0
ORDER BY sub_70 DESC, year, event_id, course_num, event_name DESC, course_name DESC LIMIT 1""")
def q_easiest_event(spark, sf_dir):
    return r6(reports.easiest_event(difficulty_of(spark, sf_dir)))


@register("overall_shares", _with(ROUNDS_SQL, DIFFICULTY_SQL) + f"""
SELECT round_even(100.0 * (CAST(coalesce(sum(over_80), 0) AS DOUBLE) / coalesce(sum(total_rounds), 0)), 1)
         AS pct_over_80,
       round_even(100.0 * (CAST(coalesce(sum(sub_70), 0) AS DOUBLE) / coalesce(sum(total_rounds), 0)), 1)
         AS pct_sub_70,
       count(*) FILTER (WHERE over_80 = 0) AS zero_high_events
FROM difficulty""")
def q_overall_shares(spark, sf_dir):
    return r6(reports.overall_shares(difficulty_of(spark, sf_dir)))


@register("majors_ranked", _with(ROUNDS_SQL, DIFFICULTY_SQL) + f"""
SELECT {DIFF_COLS},
       row_number() OVER (ORDER BY pti DESC NULLS FIRST, year, event_id, course_num,
                          event_name DESC, course_name DESC) AS rank
FROM difficulty WHERE major_championship""")
def q_majors_ranked(spark, sf_dir):
    return r6(reports.majors_ranked(difficulty_of(spark, sf_dir)))


@register("major_extremes", _with(ROUNDS_SQL, DIFFICULTY_SQL) + """
SELECT * FROM (SELECT 'hardest' AS kind, year, event_id, event_name, course_name, course_num, pti
               FROM difficulty WHERE major_championship
               ORDER BY pti DESC, year, event_id, course_num, event_name DESC, course_name DESC
               LIMIT 1)
UNION ALL
SELECT * FROM (SELECT 'easiest' AS kind, year, event_id, event_name, course_name, course_num, pti
               FROM difficulty WHERE major_championship
               ORDER BY pti ASC, year DESC NULLS FIRST, event_id DESC NULLS FIRST,
                        course_num DESC NULLS FIRST, event_name, course_name
               LIMIT 1)""")
def q_major_extremes(spark, sf_dir):
    return r6(reports.major_extremes(difficulty_of(spark, sf_dir)))


@register("venue_extremes", _with(ROUNDS_SQL, DIFFICULTY_SQL, COURSE_FACTOR_SQL) + f"""
, h AS (SELECT * FROM course_factor ORDER BY course_factor DESC, course_num LIMIT 1),
e AS (SELECT * FROM course_factor WHERE course_factor > 0 ORDER BY course_factor, course_num
      LIMIT 1)
SELECT h.course_num AS hardest_course_num, h.course_name AS hardest_course,
       {R("h.course_factor")} AS hardest_factor,
       e.course_num AS easiest_course_num, e.course_name AS easiest_course,
       {R("e.course_factor")} AS easiest_factor,
       CAST(trunc(h.course_factor / e.course_factor) AS BIGINT) AS factor_ratio,
       round_even(100.0 * (CAST(h.total_over_80 AS DOUBLE) / h.total_rounds), 1) AS hardest_pct_over_80,
       round_even(100.0 * (CAST(h.total_sub_70 AS DOUBLE) / h.total_rounds), 1) AS hardest_pct_sub_70
FROM h LEFT JOIN e ON true""")
def q_venue_extremes(spark, sf_dir):
    return r6(reports.venue_extremes(course_factor_of(spark, sf_dir)))


RANKS_SQL = """ranks AS (
  SELECT course_num, course_factor,
         CASE WHEN course_factor IS NULL THEN NULL
              ELSE row_number() OVER (ORDER BY course_factor DESC NULLS LAST, course_num) END
           AS rank
  FROM course_factor)"""


@register("venue_rank", _with(ROUNDS_SQL, DIFFICULTY_SQL, COURSE_FACTOR_SQL, RANKS_SQL) + f"""
SELECT course_num, {R("course_factor")} AS course_factor, rank FROM ranks""")
def q_venue_rank(spark, sf_dir):
    return r6(reports.venue_rank(course_factor_of(spark, sf_dir)))


@register("score_distribution", _with(ROUNDS_SQL, DIFFICULTY_SQL, COURSE_FACTOR_SQL, RANKS_SQL) + f"""
, counts AS (SELECT course_num, score, count(*) AS rounds FROM rounds GROUP BY course_num, score)
SELECT c.course_num, c.score, c.rounds,
       {R("100.0 * (CAST(c.rounds AS DOUBLE) / sum(c.rounds) OVER (PARTITION BY c.course_num))")}
         AS pct_of_rounds,
       k.rank, {R("k.course_factor")} AS course_factor,
       {R("log10(1.0 + k.course_factor)")} AS log_course_factor
FROM counts c LEFT JOIN ranks k ON c.course_num = k.course_num""")
def q_score_distribution(spark, sf_dir):
    src = rounds(spark, sf_dir)
    return r6(reports.score_distribution(src, course_factor_of(spark, sf_dir, src)))


@register("venue_median", _with(ROUNDS_SQL) + """
SELECT course_num, count(*) AS rounds, CAST(median(score) AS DOUBLE) AS median_score
FROM rounds WHERE score IS NOT NULL GROUP BY course_num""")
def q_venue_median(spark, sf_dir):
    return r6(reports.venue_median(rounds(spark, sf_dir)))


NO_IMPACT_SQL = f"""no_impact AS (
  SELECT player_name AS Name, score AS Score, event_name AS Event FROM form_{FORM_PERIOD}
  WHERE course_factor_star = 0.0 AND {YEAR_RANGE})"""


@register("venue_gained_median", _with(ROUNDS_SQL) + """
SELECT course_num, count(sg_total) AS rounds, true AS within_error
FROM rounds WHERE sg_total IS NOT NULL GROUP BY course_num""")
def q_venue_gained_median(spark, sf_dir):
    """Median strokes gained by venue from sketches of each year, merged; whether
    its true rank is within the stated error."""
    src = rounds(spark, sf_dir)
    merged = reports.merged_sketches(reports.quantile_sketches(src, "sg_total", "course_num", "year"), "course_num")
    medians = joins.materialize(reports.sketched_quantile(merged, 0.5, "median"), "medians")
    placed = reports.rank_of(src, "sg_total", medians, "median", "course_num")
    within = (F.col("below") <= 0.5 + reports.RANK_ERROR) & (F.col("up_to") >= 0.5 - reports.RANK_ERROR)
    return placed.select("course_num", F.col("n").alias("rounds"), within.alias("within_error"))


@register("no_impact_rounds", _with(*_form_ctes(FORM_PERIOD, REPORT_ROUNDS_SQL), NO_IMPACT_SQL) + """
SELECT * FROM no_impact""")
def q_no_impact_rounds(spark, sf_dir):
    return reports.no_impact_rounds(form_of(spark, sf_dir), REPORT_YEAR)


@register("no_impact_top10", _with(*_form_ctes(FORM_PERIOD, REPORT_ROUNDS_SQL), NO_IMPACT_SQL) + """
SELECT * FROM no_impact ORDER BY Score, Name, Event LIMIT 10""")
def q_no_impact_top10(spark, sf_dir):
    return reports.no_impact_top(form_of(spark, sf_dir), REPORT_YEAR, 10)


@register("no_impact_count", _with(*_form_ctes(FORM_PERIOD, REPORT_ROUNDS_SQL), NO_IMPACT_SQL) + """
SELECT count(*) FILTER (WHERE Score < 65) AS rounds_below FROM no_impact""")
def q_no_impact_count(spark, sf_dir):
    return reports.no_impact_count(form_of(spark, sf_dir), REPORT_YEAR, 65)


STANDINGS_SQL = f"""standings AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY dg_id ORDER BY teetime DESC NULLS LAST,
                                 player_name DESC NULLS LAST,
                                 first_tee_time_in_group DESC NULLS LAST) AS rn
    FROM form_{FORM_PERIOD})
  WHERE rn = 1 AND {YEAR_RANGE}
    AND date_sub('day', first_tee_time_in_group, teetime) <= {MAX_DAYS})"""


@register("current_standings", _with(*_form_ctes(FORM_PERIOD, REPORT_ROUNDS_SQL), STANDINGS_SQL) + f"""
SELECT {FORM_COLS} FROM standings""")
def q_current_standings(spark, sf_dir):
    return r6(reports.current_standings(form_of(spark, sf_dir), REPORT_YEAR, MAX_DAYS))


@register("largest_gap", _with(*_form_ctes(FORM_PERIOD, REPORT_ROUNDS_SQL), STANDINGS_SQL) + f"""
SELECT {FORM_COLS} FROM standings
WHERE ppi_sg_diff IS NOT NULL AND NOT isnan(ppi_sg_diff)
ORDER BY ppi_sg_diff, dg_id LIMIT 1""")
def q_largest_gap(spark, sf_dir):
    standings = reports.current_standings(form_of(spark, sf_dir), REPORT_YEAR, MAX_DAYS)
    return r6(reports.largest_gap(standings))


@register("player_trend", _with(*_form_ctes(FORM_PERIOD, REPORT_ROUNDS_SQL)) + f"""
SELECT {FORM_COLS}, {R("(wave_average - score) * course_factor_star")} AS weighted_score
FROM form_{FORM_PERIOD} WHERE dg_id = {TREND_PLAYER}""")
def q_player_trend(spark, sf_dir):
    return r6(reports.player_trend(form_of(spark, sf_dir), TREND_PLAYER))


@register("trend_bounds", _with(*_form_ctes(FORM_PERIOD, REPORT_ROUNDS_SQL)) + f"""
SELECT min(teetime) AS start, max(teetime) + INTERVAL 120 DAY AS "end"
FROM form_{FORM_PERIOD} WHERE dg_id = {TREND_PLAYER}""")
def q_trend_bounds(spark, sf_dir):
    return reports.trend_bounds(reports.player_trend(form_of(spark, sf_dir), TREND_PLAYER), 120)


# ------------------------------------------------------------------- ingest
from fairway.session import scratch_dir  # noqa: E402
from fairway.sources import ingest, io  # noqa: E402
from fairway.sources.schemas import CORRUPT, EVENT_DIFFICULTY  # noqa: E402
from fairway.sources.testdata import ROUNDS_RAW_SQL  # noqa: E402


def _events(spark, sf_dir):
    return testdata.table(spark, sf_dir, "events")


def _event_list(spark, sf_dir):
    return ingest.parse_event_list(testdata.event_list_documents(_events(spark, sf_dir)))


def _ingested(spark, sf_dir):
    payloads = ingest.parse_payloads(testdata.payload_documents(_events(spark, sf_dir)))
    events = ingest.pga_events(_event_list(spark, sf_dir))
    return ingest.rounds_from_payloads(payloads, events)


@register("tour_filter", """
SELECT CAST(year(ts) AS BIGINT) AS calendar_year, strftime(max(ts), '%Y-%m-%d') AS date,
       CAST(day(ts) AS BIGINT) AS event_id, 'day_' || CAST(day(ts) AS VARCHAR) AS event_name,
       'yes' AS sg_categories, 'yes' AS traditional_stats, 'pga' AS tour
FROM events GROUP BY year(ts), day(ts) HAVING day(ts) % 2 = 1""")
def q_tour_filter(spark, sf_dir):
    return ingest.pga_events(_event_list(spark, sf_dir))


INGEST_SRC_SQL = """ingest_src AS (
  SELECT *, CAST(ts AS DATE) AS completed,
         CASE isodow(CAST(ts AS DATE)) WHEN 1 THEN -5 WHEN 7 THEN -4 WHEN 6 THEN -3 END AS off,
         CASE WHEN event_type = 'signup' THEN 'none'
              WHEN event_type = 'error' AND dg_id % 7 = 3 THEN 'bad' ELSE 'ok' END AS tee_kind
  FROM rounds_raw)"""


@register("ingest_rounds", _with(ROUNDS_RAW_SQL, INGEST_SRC_SQL) + f"""
SELECT year, event_id, event_name, dg_id, player_name, round, course_name, course_num,
       course_par, score, sg_app, sg_arg, sg_ott, sg_putt, sg_t2g,
       {R("sg_total")} AS sg_total,
       CASE tee_kind WHEN 'none' THEN CAST(completed + CAST(round + off AS INTEGER) AS TIMESTAMP)
            ELSE CAST(completed + CAST(round + off AS INTEGER) AS TIMESTAMP)
                 + (date_trunc('minute', ts) - date_trunc('day', ts)) END AS teetime
FROM ingest_src WHERE event_id % 2 = 1 AND off IS NOT NULL AND tee_kind <> 'bad'""")
def q_ingest_rounds(spark, sf_dir):
    return r6(_ingested(spark, sf_dir).rounds)


QUARANTINE_SQL = """
SELECT year, event_id, CASE WHEN event_id % 2 = 1 THEN event_name END AS event_name, dg_id,
       player_name, round,
       CASE tee_kind WHEN 'none' THEN NULL WHEN 'bad' THEN 'tbd'
            ELSE lower(strftime(ts, '%-I:%M%p')) END AS teetime_text,
       strftime(completed, '%Y-%m-%d') AS event_completed,
       CAST(NULL AS VARCHAR) AS document,
       CASE WHEN event_id % 2 = 0 THEN 'event not in the list'
            WHEN off IS NULL THEN 'completed on ' || strftime(completed, '%A')
                 || ', expected Saturday to Monday'
            ELSE 'malformed tee time ''tbd''' END AS reason
FROM ingest_src WHERE event_id % 2 = 0 OR off IS NULL OR tee_kind = 'bad'"""


@register("ingest_quarantine", _with(ROUNDS_RAW_SQL, INGEST_SRC_SQL) + QUARANTINE_SQL)
def q_ingest_quarantine(spark, sf_dir):
    return _ingested(spark, sf_dir).quarantine


MIXED_SQL = """mixed AS (
  SELECT event_id AS key, event_id % 20 AS k, CAST(day(ts) AS BIGINT) AS day, ts, event_type,
         user_id, CAST(event_id % 4 + 1 AS BIGINT) AS slot,
         event_id % 20 = 0 OR (event_id % 20 = 1 AND event_type <> 'signup') AS broken,
         CASE WHEN event_type = 'signup' THEN NULL
              WHEN (event_id % 37) % 9 = 0 THEN 62 + CAST(floor(value) AS BIGINT) % 18
              ELSE 62 + CAST(floor(value) AS BIGINT) % 24 END AS score
  FROM events)"""


def _mixed(spark, sf_dir):
    docs = testdata.mixed_documents(_events(spark, sf_dir))
    return ingest.parse_payloads(docs)


@register("rounds_unpivot", _with(MIXED_SQL) + """
SELECT day AS event_id, CAST(year(ts) AS BIGINT) AS payload_year, dg_id, player_name, round, score
FROM (SELECT *, user_id AS dg_id, 'first' AS player_name, slot AS round FROM mixed
      UNION ALL SELECT *, user_id, 'first', slot % 4 + 1 FROM mixed
      UNION ALL SELECT *, user_id + 1000000, 'second', (slot + 1) % 4 + 1 FROM mixed)
WHERE NOT broken""")
def q_rounds_unpivot(spark, sf_dir):
    readable = _mixed(spark, sf_dir).where(F.col(CORRUPT).isNull())
    return ingest.unpivot_rounds(readable).select(
        "event_id", "payload_year", "dg_id", "player_name", "round", F.col("r.score").alias("score"))


@register("ingest_accounting", _with(MIXED_SQL) + """
SELECT reason, CAST(sum(n) AS BIGINT) AS rows FROM (
  SELECT CASE WHEN broken THEN 1 ELSE 3 END AS n,
         CASE WHEN broken THEN 'unreadable document'
              WHEN k = 2 THEN 'other tour'
              WHEN day % 2 = 0 THEN 'event not in the list'
              WHEN day % 10 = 1 THEN 'event listed under several names'
              WHEN k IN (3, 4) THEN 'no usable completion date'
              WHEN isodow(CAST(ts AS DATE)) NOT IN (1, 6, 7) THEN 'completed on '
                   || strftime(ts, '%A') || ', expected Saturday to Monday'
              WHEN event_type = 'error' AND user_id % 7 = 3 THEN 'malformed tee time ''tbd'''
              ELSE 'valid' END AS reason
  FROM mixed) GROUP BY reason""")
def q_ingest_accounting(spark, sf_dir):
    """Rounds that landed, by what became of them."""
    staged = ingest.staged_rounds(_mixed(spark, sf_dir), testdata.mixed_event_list(_events(spark, sf_dir)))
    return staged.groupBy(F.coalesce("reason", F.lit("valid")).alias("reason")).agg(
        F.count(F.lit(1)).alias("rows"))


@register("split_documents", _with(MIXED_SQL) + """
SELECT reason, CAST(sum(n) AS BIGINT) AS rows FROM (
  SELECT CASE WHEN broken THEN 1 ELSE 3 END AS n,
         CASE WHEN broken THEN 'unreadable document'
              WHEN k = 2 THEN 'other tour'
              WHEN day % 2 = 0 THEN 'event not in the list'
              WHEN day % 10 = 1 THEN 'event listed under several names'
              WHEN k IN (3, 4) THEN 'no usable completion date'
              WHEN isodow(CAST(ts AS DATE)) NOT IN (1, 6, 7) THEN 'completed on '
                   || strftime(ts, '%A') || ', expected Saturday to Monday'
              WHEN event_type = 'error' AND user_id % 7 = 3 THEN 'malformed tee time ''tbd'''
              ELSE 'valid' END AS reason
  FROM mixed WHERE k <> 0) GROUP BY reason""")
def q_split_documents(spark, sf_dir):
    """Rounds of documents that lie in large pretty-printed arrays, read in byte
    ranges, by what became of them (documents cut in half are left out: they have
    no end)."""
    root = scratch_dir(spark, "arrays")
    events = _events(spark, sf_dir)
    testdata.write_array_files(testdata.mixed_documents(testdata.spread(events)).where("key % 20 <> 0"), root)
    payloads = ingest.read_split_payloads(spark, root, 1 << 16)
    staged = ingest.staged_rounds(payloads, testdata.mixed_event_list(events))
    return staged.groupBy(F.coalesce("reason", F.lit("valid")).alias("reason")).agg(
        F.count(F.lit(1)).alias("rows"))


@register("round_dates", """
SELECT o_orderkey, CAST(round AS BIGINT) AS round, CAST(o_orderdate AS DATE) AS completion_date,
       CAST(o_orderdate AS DATE)
         + CAST(round + CASE isodow(CAST(o_orderdate AS DATE)) WHEN 1 THEN -5 WHEN 7 THEN -4
                                                               WHEN 6 THEN -3 END AS INTEGER)
         AS round_date,
       isodow(CAST(o_orderdate AS DATE)) IN (1, 6, 7) AS valid
FROM orders, range(1, 5) t(round)""")
def q_round_dates(spark, sf_dir):
    orders = testdata.table(spark, sf_dir, "orders")
    completed = F.to_date("o_orderdate")
    per_round = orders.select("o_orderkey", completed.alias("completion_date"),
                              F.explode(F.sequence(F.lit(1).cast("long"), F.lit(4).cast("long"))).alias("round"))
    rd = ingest.round_date(F.col("completion_date"), F.col("round"))
    return per_round.select("o_orderkey", "round", "completion_date", rd.alias("round_date"),
                            rd.isNotNull().alias("valid"))


@register("teetime_parse", """
SELECT event_id,
       CASE WHEN event_type = 'signup' THEN NULL
            WHEN event_type = 'error' AND user_id % 7 = 3 THEN 'tbd'
            ELSE lower(strftime(ts, '%-I:%M%p')) END AS teetime_text,
       CASE WHEN event_type = 'signup' THEN date_trunc('day', ts)
            WHEN event_type = 'error' AND user_id % 7 = 3 THEN NULL
            ELSE date_trunc('minute', ts) END AS teetime
FROM events""")
def q_teetime_parse(spark, sf_dir):
    ev = _events(spark, sf_dir)
    text = (F.when(F.col("event_type") == "signup", F.lit(None).cast("string"))
            .when((F.col("event_type") == "error") & (F.col("user_id") % 7 == 3), F.lit("tbd"))
            .otherwise(F.lower(F.date_format("ts", "h:mma"))))
    staged = ev.select("event_id", F.to_date("ts").alias("day"), text.alias("teetime_text"))
    return staged.select("event_id", "teetime_text",
                         ingest.teetime_at(F.col("day"), F.col("teetime_text")).alias("teetime"))


ORDER_EVENTS_SQL = """order_events AS (
  SELECT CAST(year(o_orderdate) AS BIGINT) AS calendar_year,
         strftime(o_orderdate, '%Y-%m-%d') AS date, o_orderkey AS event_id,
         'Cup ' || o_orderpriority || ' ' || CAST(o_custkey AS VARCHAR) AS event_name,
         'yes' AS sg_categories, 'yes' AS traditional_stats, 'pga' AS tour, o_orderstatus
  FROM orders),
landed AS (
  SELECT calendar_year AS year, event_id,
         trim(regexp_replace(lower(event_name), '[^a-z0-9]+', '-', 'g'), '-') AS event_slug
  FROM order_events WHERE o_orderstatus = 'F')"""


def _order_events(spark, sf_dir):
    orders = testdata.table(spark, sf_dir, "orders")
    return orders.select(
        F.year("o_orderdate").cast("long").alias("calendar_year"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        F.col("o_orderkey").alias("event_id"),
        F.concat(F.lit("Cup "), F.col("o_orderpriority"), F.lit(" "),
                 F.col("o_custkey").cast("string")).alias("event_name"),
        F.lit("yes").alias("sg_categories"), F.lit("yes").alias("traditional_stats"),
        F.lit("pga").alias("tour"), "o_orderstatus")


def _landed(spark, sf_dir):
    done = _order_events(spark, sf_dir).filter(F.col("o_orderstatus") == "F")
    return ingest.landed_event_keys(done.select(
        F.col("calendar_year").alias("year"), "event_id", "event_name"))


@register("incremental_new_events", _with(ORDER_EVENTS_SQL) + """
SELECT calendar_year, date, event_id, event_name, sg_categories, traditional_stats, tour
FROM order_events o
WHERE NOT EXISTS (SELECT 1 FROM landed l WHERE l.year = o.calendar_year
                  AND l.event_id = o.event_id)""")
def q_incremental_new_events(spark, sf_dir):
    events = _order_events(spark, sf_dir).drop("o_orderstatus")
    return ingest.new_events(events, _landed(spark, sf_dir))


@register("incremental_new_events_slug", _with(ORDER_EVENTS_SQL) + """
SELECT calendar_year, date, event_id, event_name, sg_categories, traditional_stats, tour
FROM order_events o
WHERE NOT EXISTS (SELECT 1 FROM landed l WHERE l.year = o.calendar_year
                  AND l.event_slug = trim(regexp_replace(lower(o.event_name), '[^a-z0-9]+', '-',
                                                         'g'), '-'))""")
def q_incremental_new_events_slug(spark, sf_dir):
    events = _order_events(spark, sf_dir).drop("o_orderstatus")
    return ingest.new_events(events, _landed(spark, sf_dir), by_slug=True)


ROUNDS_COLS = ", ".join(
    f"{R(c)} AS {c}" if c.startswith("sg_") else c
    for c in ("year", "event_id", "event_name", "dg_id", "player_name", "round", "course_name",
              "course_num", "course_par", "score", "sg_app", "sg_arg", "sg_ott", "sg_putt",
              "sg_t2g", "sg_total", "teetime"))


@register("parquet_roundtrip", _with(ROUNDS_SQL) + f"""
SELECT {ROUNDS_COLS} FROM rounds""")
def q_parquet_roundtrip(spark, sf_dir):
    root = scratch_dir(spark, "rounds")
    io.write_rounds(rounds(spark, sf_dir), root)
    return r6(io.read_rounds(spark, root))


@register("dataset_statistics", _with(ROUNDS_SQL) + """
SELECT name, CAST(count(*) AS BIGINT) AS rows, CAST(min(v) AS DOUBLE) AS low, CAST(max(v) AS DOUBLE) AS high,
       CAST(count(*) - count(v) AS BIGINT) AS nulls
FROM (SELECT 'score' AS name, CAST(score AS DOUBLE) AS v FROM rounds
      UNION ALL SELECT 'dg_id', dg_id FROM rounds UNION ALL SELECT 'course_num', course_num FROM rounds
      UNION ALL SELECT 'sg_total', sg_total FROM rounds UNION ALL SELECT 'sg_app', sg_app FROM rounds
      UNION ALL SELECT 'teetime', CAST(epoch_us(teetime) AS DOUBLE) FROM rounds)
GROUP BY name""")
def q_dataset_statistics(spark, sf_dir):
    """Rows, extremes and nulls of columns, from the footers of a written dataset."""
    root = scratch_dir(spark, "rounds")
    io.write_rounds(rounds(spark, sf_dir), root)
    io.read_rounds(spark, root)     # the footers are kept here, and only read again below
    return io.dataset_statistics(spark, root).where(F.col("name").isin(
        "score", "dg_id", "course_num", "sg_total", "sg_app", "teetime")).select("name", "rows", "low", "high", "nulls")


@register("csv_roundtrip", _with(ROUNDS_SQL, DIFFICULTY_SQL) + f"""
SELECT {DIFF_COLS} FROM difficulty""")
def q_csv_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "difficulty-csv")
    io.write_csv(difficulty_of(spark, sf_dir), path)
    return r6(io.read_csv(spark, path, EVENT_DIFFICULTY))


@register("form_index_sink", _rolling_sql([25]))
def q_form_index_sink(spark, sf_dir):
    root = scratch_dir(spark, "form-index")
    src, factors, stats = rolling_inputs(spark, sf_dir)
    long = form.rolling_index_multi(src, factors, MULTI_PERIODS, stats=stats,
                                    factor_rows_bound=stats.summary()["course_rows"])
    io.write_form_index(long, root)
    return r6(io.read_form_index(spark, root, 25))


@register("score_share_rows", _with(ROUNDS_SQL, DIFFICULTY_SQL, COURSE_FACTOR_SQL, RANKS_SQL) + f"""
SELECT {ROUNDS_COLS.replace("teetime", "r.teetime").replace(", course_num,", ", r.course_num,")},
       k.rank, {R("k.course_factor")} AS course_factor,
       {R("(CAST(count(*) OVER (PARTITION BY r.score, r.course_num) AS DOUBLE) / "
          "count(*) OVER (PARTITION BY r.course_num)) * 100.0")} AS count,
       {R("log10(1.0 + k.course_factor)")} AS log_course_factor
FROM rounds r LEFT JOIN ranks k ON r.course_num = k.course_num""")
def q_score_share_rows(spark, sf_dir):
    src = rounds(spark, sf_dir)
    return r6(reports.score_share_rows(src, course_factor_of(spark, sf_dir, src)))


# ------------------------------------------------------- one-pass statistics
@register("event_difficulty_one_pass", _with(ROUNDS_SQL, DIFFICULTY_SQL) + f"""
SELECT {DIFF_COLS} FROM difficulty""")
def q_event_difficulty_one_pass(spark, sf_dir):
    stats = form.RoundStatistics(rounds(spark, sf_dir))
    return r6(difficulty.difficulty_from_counts(stats.event_counts()))


@register("player_scored_rounds", _with(ROUNDS_SQL) + """
SELECT dg_id, count(score) AS scored_rounds FROM rounds GROUP BY dg_id""")
def q_player_scored_rounds(spark, sf_dir):
    return form.RoundStatistics(rounds(spark, sf_dir)).player_rounds()


# ------------------------------------------- merged, versioned, kept up to date
MERGED_SQL = """merged AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY year, event_id, dg_id, who, round
                                 ORDER BY landed_at DESC, landed_file DESC, listed DESC) AS rn
    FROM (SELECT *, CASE WHEN dg_id IS NULL THEN coalesce(player_name, 'row ' || CAST(listed AS VARCHAR)) END AS who
          FROM (SELECT * REPLACE (CASE WHEN listed % 19 IN (7, 11) THEN NULL ELSE dg_id END AS dg_id,
                                  CASE WHEN listed % 19 = 11 THEN NULL ELSE player_name END AS player_name)
                FROM landed_view)))
  WHERE rn = 1)"""


@register("merged_rounds", _with(LANDED_ROUNDS_SQL, MERGED_SQL) + f"""
SELECT {ROUNDS_COLS} FROM merged""")
def q_merged_rounds(spark, sf_dir):
    """The rows land in three batches, the first twice: every round is there
    once, as it landed last, also those without a player id."""
    from fairway.streaming.landing import merge_rounds

    root, landed = scratch_dir(spark, "merged-rounds"), testdata.landed_rounds(spark, sf_dir)
    for batch in (0, 1, 0, 2):
        with joins.run_scope():
            merge_rounds(landed.where(F.col("key") % 3 == batch).drop("key"), root)
    return r6(io.read_rounds(spark, root))


@register("form_index_replaced", _with(*_rolling_ctes((10, 25))) + _period_select(10, True) + "\nUNION ALL\n"
          + _period_select(25, True) + " AND dg_id % 3 = 1")
def q_form_index_replaced(spark, sf_dir):
    """One period is replaced, the other stays as it was written first."""
    root = scratch_dir(spark, "form-index")
    src, factors, stats = rolling_inputs(spark, sf_dir)
    long = joins.materialize(form.rolling_index_multi(src, factors, (10, 25), stats=stats,
                                                      factor_rows_bound=stats.summary()["course_rows"]))
    io.write_form_index(long, root, (10, 25))
    io.write_form_index(long.where("period = 25 AND dg_id % 3 = 1"), root, (25,))
    both = [io.read_form_index(spark, root, p).select(F.lit(p).cast("long").alias("period"), "*") for p in (10, 25)]
    return r6(both[0].unionByName(both[1]))


def _landed_in_steps(spark, sf_dir, root):
    """The rounds land in four batches (late rounds of all events last), and the
    metrics are kept up to date after each; returns both."""
    from fairway.streaming.landing import merge_rounds
    from fairway.streaming.maintained import MaintainedDifficulty, MaintainedIndex

    landed = testdata.landed_rounds(spark, sf_dir)
    late = F.pmod(F.col("dg_id"), F.lit(7)).eqNullSafe(F.lit(3)) & (F.col("key") % 3 == 0)
    third = F.col("key") % 30
    sums = MaintainedDifficulty(spark, f"{root}/sums", 8)
    index = MaintainedIndex(spark, f"{root}/index", (10, 25), 8)
    for step in (~late & (third < 20), ~late & third.between(20, 24), ~late & (third > 24), late):
        with joins.run_scope():
            merged = merge_rounds(landed.where(step).drop("key"), f"{root}/rounds")
            sums.update(merged.events, merged.rounds)
            index.update(*merged, sums.factors())
    return sums, index


LANDED_CTES = (LANDED_ROUNDS_SQL, MERGED_SQL, "rounds AS (SELECT * FROM merged)", DIFFICULTY_SQL)


@register("maintained_difficulty", _with(*LANDED_CTES) + f"""
SELECT {DIFF_COLS} FROM difficulty""")
def q_maintained_difficulty(spark, sf_dir):
    """Event difficulty from the sums kept as events landed."""
    return r6(_landed_in_steps(spark, sf_dir, scratch_dir(spark, "maintained"))[0].difficulty())


@register("maintained_index", _with(*LANDED_CTES, COURSE_FACTOR_SQL, SCORED_SQL, _framed_sql(10), _framed_sql(25))
          + _period_select(10, True) + "\nUNION ALL\n" + _period_select(25, True))
def q_maintained_index(spark, sf_dir):
    """The rolling index kept up to date as events landed and factors moved."""
    return r6(_landed_in_steps(spark, sf_dir, scratch_dir(spark, "maintained"))[1].index())
