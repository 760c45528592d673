"""Difficulty-weighted rolling form index.

For every round of a player, over the player's last ``p`` rounds:

    index = sum((wave average - score) * factor*) / sum(factor*)

where the wave average is the mean score of the event round's morning or
afternoon wave and factor* the log course factor. Rows without a full window
(fewer than ``p`` rounds) are dropped.

Plan, chosen for skew: one grouping-sets aggregate yields the wave averages
(joined back after a size check; no window over a possibly huge wave) and
the rows per player. When the largest player is within
``spark.fairway.maxWindowGroupRows`` the frames run in one hash exchange on
the player. Otherwise the round order is a global row number built from
range partitioning (a hot player is split across tasks) and frames are
evaluated in fixed-size blocks of that index, each block carrying the
``p-1`` preceding rows as a halo, so no window group is larger than
``block + p - 1`` rows. The frame is RANGE over the index within
(dg_id, player_name): a player id with interleaved names only sees rows of
the same name whose index is within the last ``p`` positions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fairway.functions.numeric import ieee_div
from fairway.functions.rules import category, wave
from fairway.operators import joins
from fairway.operators.joins import join_keys, join_small
from fairway.operators.sequence import global_row_number

WAVE_KEYS = ("event_id", "year", "round", "wave")
# Total order of a player's rounds: time first, then the logical key and the
# remaining used columns as tie-breaks so numbering is deterministic.
ROUND_ORDER = ("dg_id", "teetime", "year", "event_id", "round", "player_name", "course_num",
               "score", "event_name", "sg_total")
MIN_BLOCK_ROWS = 1 << 16
# Largest player (rows) allowed to be framed whole in one task; above it the
# range-partitioned block/halo plan is used. Session setting:
# spark.fairway.maxWindowGroupRows.
DEFAULT_MAX_GROUP_ROWS = 2_000_000
# Periods from which frames are made by block scans instead of window frames.
SCAN_FROM = 48

# Column names of the form-index dataset.
OUTPUT_COLUMNS = ("dg_id", "player_name", "ppi", "teetime", "first_tee_time_in_group",
                  "sg_total", "score", "event_name", "wave_average", "course_factor_star")


def weighted_index(score: Column, wave_average: Column, factor: Column,
                   over: Window | None = None) -> Column:
    """The weighted mean ``sum((wave_average - score) * factor) / sum(factor)``
    as an aggregate (``over=None``, for ``groupBy().agg``) or over a window.

    Rows with a NULL factor leave both sums; no usable weight gives NaN; an
    infinite weight anywhere gives NaN.
    """
    gain = F.sum((wave_average - score) * factor)
    weight = F.sum(factor)
    if over is not None:
        gain, weight = gain.over(over), weight.over(over)
    return ieee_div(F.coalesce(gain, F.lit(0.0)), F.coalesce(weight, F.lit(0.0)))


def _wave_table(scored: DataFrame) -> DataFrame:
    return scored.groupBy(*WAVE_KEYS).agg(F.avg("score").alias("wave_average"))


def wave_averages(rounds: DataFrame) -> DataFrame:
    """Mean score per (event, year, round, wave) over rounds with a score."""
    return _wave_table(rounds.filter(F.col("score").isNotNull())
                       .select("*", wave("teetime").alias("wave")))


def _attach_wave_average(scored: DataFrame) -> DataFrame:
    """``scored``: rounds with a score and a ``wave`` label."""
    return join_small(scored, _wave_table(scored), list(WAVE_KEYS), "inner", null_safe=True)


def with_wave_average(rounds: DataFrame) -> DataFrame:
    """Rounds with a score, labelled with their wave and its average."""
    scored = rounds.filter(F.col("score").isNotNull()).select("*", wave("teetime").alias("wave"))
    return _attach_wave_average(scored)


def scored_rounds(rounds: DataFrame, factors: DataFrame,
                  factor_rows_bound: int | None = None) -> DataFrame:
    """Drop score-less rounds, attach factor* (left: unknown and NULL courses
    keep a NULL factor) and the wave label. ``factor_rows_bound``: a proven
    upper bound on the rows of ``factors`` (e.g. the course count of the
    ``RoundStatistics`` they were computed from); it replaces the count."""
    scored = rounds.filter(F.col("score").isNotNull()).select(
        "dg_id", "player_name", "teetime", "year", "event_id", "round", "event_name",
        "course_num", "score", "sg_total", wave("teetime").alias("wave"))
    dim = factors.select("course_num", "course_factor_star")
    if factor_rows_bound is not None:
        return join_keys(scored, dim, ["course_num"], "left",
                         broadcast_right=joins.fits_broadcast(dim, factor_rows_bound))
    return join_small(scored, dim, ["course_num"], "left")


def prepare_rounds(rounds: DataFrame, factors: DataFrame) -> DataFrame:
    """``scored_rounds`` plus the wave average."""
    return _attach_wave_average(scored_rounds(rounds, factors))


def _block_rows(max_period: int) -> int:
    return max(MIN_BLOCK_ROWS, 64 * max_period)


def _with_frames(df: DataFrame, keys: Sequence[str], periods: Sequence[int],
                 scan_from: int | None = None) -> DataFrame:
    """Add ``__ppi_p, __first_p, __n_p, __sg_p`` for each period, over the rows of
    the same ``keys`` within the last ``p`` positions of ``index``. Periods below
    ``scan_from`` are window frames, longer ones block scans (``_with_scans``). The
    sums are plain columns; the IEEE division runs in a projection above them, so
    no window expression is repeated inside its branches."""
    scan_from = SCAN_FROM if scan_from is None else scan_from
    short = [p for p in periods if p < scan_from]
    framed = _with_window_frames(df, keys, short) if short else df
    for p in periods:
        if p >= scan_from:
            framed = _with_scans(framed, keys, p)
    ratios = [ieee_div(F.coalesce(F.col(f"__num_{p}"), F.lit(0.0)),
                       F.coalesce(F.col(f"__den_{p}"), F.lit(0.0))).alias(f"__ppi_{p}")
              for p in periods]
    return framed.select("*", *ratios)


def _gain() -> Column:
    return (F.col("wave_average") - F.col("score")) * F.col("course_factor_star")


def _with_window_frames(df: DataFrame, keys: Sequence[str], periods: Sequence[int]) -> DataFrame:
    """Sums of each frame by window frames, which add every frame up anew: the
    cost is rows times period."""
    base = Window.partitionBy(*keys).orderBy("index")
    gain = _gain()
    sums = []
    for p in periods:
        w = base.rangeBetween(-(p - 1), 0)
        sums += [
            F.sum(gain).over(w).alias(f"__num_{p}"),
            F.sum("course_factor_star").over(w).alias(f"__den_{p}"),
            F.first("teetime").over(w).alias(f"__first_{p}"),
            F.count(F.lit(1)).over(w).alias(f"__n_{p}"),
            F.avg("sg_total").over(w).alias(f"__sg_{p}"),
        ]
    return df.select("*", *sums)


def _with_scans(df: DataFrame, keys: Sequence[str], p: int) -> DataFrame:
    """Sums of each full frame of ``p`` rows by block scans; the cost is rows,
    whatever the period.

    The index is cut into blocks of ``p`` positions. A running sum from each
    block's start (prefix) and one from its end (suffix) are made once; a frame
    that ends at position ``o`` of its block is the suffix of the block before, from
    position ``o + 1`` on, plus the block's prefix. Nothing is ever subtracted, so
    infinities and NaN leave with their row. Only full frames are given (others
    have ``__n_p`` 0), and the rows of a full frame follow each other: its first
    row is ``p - 1`` rows back, with an index lower by just ``p - 1``.
    """
    block = [*keys, "__block"]
    rows = df.select("*", F.floor((F.col("index") - 1) / p).cast("long").alias("__block"),
                     _gain().alias("__gain"))

    def running(order: Column, name: str) -> list[Column]:
        w = Window.partitionBy(*block).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        return [F.sum("__gain").over(w).alias(f"__{name}_num"),
                F.sum("course_factor_star").over(w).alias(f"__{name}_den"),
                F.sum("sg_total").over(w).alias(f"__{name}_sg"),
                F.count("sg_total").over(w).alias(f"__{name}_sgs")]

    rows = rows.select("*", *running(F.col("index").desc(), "suf"))
    rows = rows.select("*", *running(F.col("index"), "pre"))
    by_index = Window.partitionBy(*keys).orderBy("index")
    parts = ("num", "den", "sg", "sgs")
    back = F.lag(F.struct("index", "teetime", *[f"__suf_{x}" for x in parts]), p - 1).over(by_index)
    rows = rows.select("*", back.alias("__back"))
    full = F.col("__back.index") == F.col("index") - (p - 1)
    whole = (F.col("index") % p) == 0   # the frame is its block

    def total(x: str) -> Column:
        suffix, prefix = F.col(f"__back.__suf_{x}"), F.col(f"__pre_{x}")
        return F.when(whole, prefix).otherwise(F.coalesce(suffix + prefix, suffix, prefix))

    count = total("sgs")
    return rows.select(
        *df.columns, total("num").alias(f"__num_{p}"), total("den").alias(f"__den_{p}"),
        F.when(full, F.col("__back.teetime")).alias(f"__first_{p}"),
        F.when(full, F.lit(p)).otherwise(0).cast("long").alias(f"__n_{p}"),
        F.when(count > 0, total("sg") / F.when(count > 0, count)).alias(f"__sg_{p}"))


def max_group_rows(spark) -> int:
    value = spark.conf.get("spark.fairway.maxWindowGroupRows", None)
    return int(value) if value else DEFAULT_MAX_GROUP_ROWS


def largest_player(prepared: DataFrame) -> int:
    """Rows of the biggest player (partial aggregation; one number to the driver)."""
    biggest = prepared.groupBy("dg_id").count().agg(F.max("count")).first()[0]
    return int(biggest or 0)


def _grouping_id(cols: Sequence[str], grouped: Sequence[str]) -> int:
    """``grouping_id()`` of a grouping set: one bit per column, first column
    most significant, set when the column is not grouped."""
    n = len(cols)
    return sum(1 << (n - 1 - i) for i, c in enumerate(cols) if c not in grouped)


def wave_table_and_largest_player(prepared: DataFrame):
    """One pass over the rounds (grouping sets) for both the wave averages and
    the rows per player; returns (wave table, wave table fits a broadcast,
    rows of the largest player). Only two small statistics reach the driver."""
    keys = list(WAVE_KEYS)
    cols = keys + ["dg_id"]
    combo = prepared.groupingSets([keys, ["dg_id"]], *cols).agg(
        F.avg("score").alias("wave_average"), F.count(F.lit(1)).alias("__n"),
        F.grouping_id().alias("__g")).persist(StorageLevel.MEMORY_AND_DISK)
    joins.current_scope().keep(combo)
    wave_g, player_g = _grouping_id(cols, keys), _grouping_id(cols, ["dg_id"])
    stats = {r["__g"]: r for r in combo.groupBy("__g").agg(
        F.count(F.lit(1)).alias("rows"), F.max("__n").alias("biggest")).collect()}
    waves = combo.filter(F.col("__g") == wave_g).select(*keys, "wave_average")
    wave_rows = stats[wave_g]["rows"] if wave_g in stats else 0
    largest = stats[player_g]["biggest"] if player_g in stats else 0
    return waves, joins.fits_broadcast(waves, wave_rows), int(largest or 0)


class RoundStatistics:
    """Event counts, wave averages and rounds per player from ONE pass over
    the rounds (a grouping-sets aggregate), written once as a small table in
    the shared checkpoint folder. A pipeline computes event difficulty and
    the rolling index from it without scanning the rounds twice."""

    def __init__(self, rounds: DataFrame):
        from fairway.operators.difficulty import EVENT_KEYS, event_count_columns

        waved = rounds.select("*", wave("teetime").alias("wave"))
        self._event_keys = list(EVENT_KEYS)
        cols = list(dict.fromkeys(self._event_keys + list(WAVE_KEYS) + ["dg_id"]))
        self._gids = {name: _grouping_id(cols, keys) for name, keys in (
            ("event", self._event_keys), ("wave", list(WAVE_KEYS)), ("player", ["dg_id"]))}
        stats = waved.groupingSets(
            [self._event_keys, list(WAVE_KEYS), ["dg_id"]], *cols).agg(
            *event_count_columns(), F.count("score").alias("__scored"),
            F.grouping_id().alias("__g"))
        self.table = joins.materialize(stats, "round-stats")

    def _part(self, name: str) -> DataFrame:
        return self.table.filter(F.col("__g") == self._gids[name])

    def event_counts(self) -> DataFrame:
        """Input of ``difficulty_from_counts``."""
        return self._part("event").select(*self._event_keys, "over_80", "sub_70",
                                          "total_rounds", "scoring_average")

    def player_rounds(self) -> DataFrame:
        """Rounds with a score per player."""
        return self._part("player").select("dg_id", F.col("__scored").alias("scored_rounds"))

    def wave_table(self) -> DataFrame:
        # groups whose scores are all NULL never meet a scored round
        return self._part("wave").select(*WAVE_KEYS, F.col("scoring_average")
                                         .alias("wave_average"))

    def summary(self) -> dict[str, int]:
        """Row counts of the event and wave parts, the number of courses (the
        exact row count of their factors) and the largest player's scored
        rounds, from one small action (computed once)."""
        if not hasattr(self, "_summary"):
            row = self.table.agg(
                F.count_if(F.col("__g") == self._gids["event"]).alias("e"),
                F.count_if(F.col("__g") == self._gids["wave"]).alias("w"),
                F.max(F.when(F.col("__g") == self._gids["player"], F.col("__scored")))
                .alias("p"),
                F.count_distinct(F.when(F.col("__g") == self._gids["event"],
                                        F.struct("course_num"))).alias("c"),
            ).first()
            self._summary = {"event_rows": int(row["e"] or 0), "wave_rows": int(row["w"] or 0),
                             "largest_player": int(row["p"] or 0),
                             "course_rows": int(row["c"] or 0)}
        return self._summary

    def wave_rows_and_largest_player(self) -> tuple[int, int]:
        s = self.summary()
        return s["wave_rows"], s["largest_player"]


def _frames(prepared: DataFrame, periods: Sequence[int], skew_safe: bool | None = None,
            stats: RoundStatistics | None = None) -> DataFrame:
    """One row per scored round (``scored_rounds``) with, for each period p,
    the frame values ``ppi_p, first_p, n_p, sg_p``.

    ``skew_safe=None`` decides from the data: players up to
    ``spark.fairway.maxWindowGroupRows`` rows are framed whole (one hash
    exchange on the player); a bigger player switches to the block/halo plan.
    """
    if stats is None:
        waves, fits, largest = wave_table_and_largest_player(prepared)
    else:
        waves = stats.wave_table()
        wave_rows, largest = stats.wave_rows_and_largest_player()
        fits = joins.fits_broadcast(waves, wave_rows)

    def attach(df: DataFrame) -> DataFrame:
        return join_keys(df, waves, list(WAVE_KEYS), "inner", broadcast_right=fits,
                         null_safe=True)

    if skew_safe is None:
        skew_safe = largest > max_group_rows(prepared.sparkSession)
    if skew_safe:
        return _frames_blocked(prepared, periods, attach)
    return _frames_by_player(prepared, periods, attach)


def _frames_by_player(prepared: DataFrame, periods: Sequence[int], attach) -> DataFrame:
    """Bounded players: per-player row number (index differences inside a
    player equal those of the global index) and frames in the same
    partitioning — one exchange on ``dg_id``."""
    order = Window.partitionBy("dg_id").orderBy(*ROUND_ORDER[1:])
    indexed = attach(prepared).select(
        "*", F.row_number().over(order).cast("long").alias("index"))
    return _with_frames(indexed, ["dg_id", "player_name"], periods)


def _frames_blocked(prepared: DataFrame, periods: Sequence[int], attach) -> DataFrame:
    """Any skew: global row number from range partitioning, frames in index
    blocks with a ``p-1`` row halo (no group above ``block + p - 1`` rows)."""
    max_p = max(periods)
    block = _block_rows(max_p)
    indexed = attach(global_row_number(prepared, list(ROUND_ORDER), "index"))
    own = F.floor((F.col("index") - 1) / block).cast("long")
    in_tail = ((F.col("index") - 1) % block) >= (block - (max_p - 1))
    targets = F.when(in_tail & F.lit(max_p > 1), F.array(own, own + 1)).otherwise(F.array(own))
    spread = indexed.select("*", own.alias("__own"), F.explode(targets).alias("__blk"))
    framed = _with_frames(spread, ["dg_id", "player_name", "__blk"], periods)
    # halo copies only feed the next block's frames
    return framed.filter(F.col("__blk") == F.col("__own"))


def _finish(df: DataFrame) -> DataFrame:
    return df.select(*OUTPUT_COLUMNS, category("ppi", "sg_total").alias("category"),
                     (F.col("ppi") - F.col("sg_total")).alias("ppi_sg_diff"))


def _period_view(framed: DataFrame, p: int) -> DataFrame:
    return framed.filter(F.col(f"__n_{p}") == p).select(
        "dg_id", "player_name",
        F.col(f"__ppi_{p}").alias("ppi"),
        "teetime",
        F.col(f"__first_{p}").alias("first_tee_time_in_group"),
        F.col(f"__sg_{p}").alias("sg_total"),
        "score", "event_name", "wave_average", "course_factor_star")


def rolling_index(rounds: DataFrame, factors: DataFrame, period: int = 25,
                  skew_safe: bool | None = None,
                  stats: RoundStatistics | None = None,
                  factor_rows_bound: int | None = None) -> DataFrame:
    """Rolling form index over ``period`` rounds (one row per round that
    closes a full window). Output columns follow ``schemas.FORM_INDEX``.
    ``skew_safe``: force (True) or skip (False) the block/halo plan; by
    default it is chosen from the largest player's size. ``stats``: a
    ``RoundStatistics`` of the same rounds, when one was already computed."""
    if period < 1:
        raise ValueError("period must be >= 1")
    framed = _frames(scored_rounds(rounds, factors, factor_rows_bound), [period], skew_safe,
                     stats)
    return _finish(_period_view(framed, period))


def rolling_index_multi(rounds: DataFrame, factors: DataFrame,
                        periods: Sequence[int] = (25, 50, 75, 100),
                        skew_safe: bool | None = None,
                        stats: RoundStatistics | None = None,
                        factor_rows_bound: int | None = None) -> DataFrame:
    """All periods in one pass (one index, one window exchange), stacked long
    with a ``period`` column. Each period equals ``rolling_index`` alone."""
    periods = sorted(set(int(p) for p in periods))
    if not periods or periods[0] < 1:
        raise ValueError("periods must be >= 1")
    framed = _frames(scored_rounds(rounds, factors, factor_rows_bound), periods, skew_safe,
                     stats)
    return stacked(framed, periods)


def stacked(framed: DataFrame, periods: Sequence[int]) -> DataFrame:
    """Rows with a full window, one for each period, with a ``period`` column."""
    per = F.explode(F.array(*[
        F.struct(F.lit(p).cast("long").alias("period"),
                 F.col(f"__ppi_{p}").alias("ppi"),
                 F.col(f"__first_{p}").alias("first_tee_time_in_group"),
                 F.col(f"__n_{p}").alias("n"),
                 F.col(f"__sg_{p}").alias("sg_total"))
        for p in periods])).alias("__p")
    long = framed.select("dg_id", "player_name", "teetime", "score", "event_name",
                         "wave_average", "course_factor_star", per)
    long = long.filter(F.col("__p.n") == F.col("__p.period")).select(
        F.col("__p.period").alias("period"), "dg_id", "player_name",
        F.col("__p.ppi").alias("ppi"), "teetime",
        F.col("__p.first_tee_time_in_group").alias("first_tee_time_in_group"),
        F.col("__p.sg_total").alias("sg_total"),
        "score", "event_name", "wave_average", "course_factor_star")
    return long.select("*", category("ppi", "sg_total").alias("category"),
                       (F.col("ppi") - F.col("sg_total")).alias("ppi_sg_diff"))
