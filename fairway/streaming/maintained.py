"""Metrics kept up to date as events land, instead of computed anew.

Both states are versioned datasets (``sources.snapshots``) in buckets: an update
reads and writes only the buckets it touches and shows them by one manifest, so
readers see the state before or after it, and an update that failed can simply be
run again.

* ``MaintainedDifficulty``: mergeable sums (high and low rounds, rounds, scores) of
  every event and course. The sums of an event that landed replace its old ones,
  which makes a replayed batch harmless; event difficulty and course factors are
  derived from the sums without reading a round.
* ``MaintainedIndex``: the rolling form index of several periods, with its input
  rows beside it. A landed event changes the wave averages of its own rounds only,
  so the players to recompute are those of its rounds, before or after, each from
  the first changed tee time on; framing starts ``p - 1`` rounds before. Where the
  course factors moved, the players who played those courses are recomputed too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fairway.functions.numeric import ieee_div
from fairway.functions.rules import HIGH_SCORE, LOW_SCORE, wave
from fairway.operators import form, joins
from fairway.operators.difficulty import EVENT_KEYS, course_factor, difficulty_from_counts
from fairway.operators.joins import join_small, materialize
from fairway.sources.schemas import FORM_INDEX
from fairway.sources.snapshots import Snapshots
from fairway.streaming.landing import NO_TIME

EVENT = ["year", "event_id"]
_LONG, _DOUBLE, _TEXT, _TIME = T.LongType(), T.DoubleType(), T.StringType(), T.TimestampNTZType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


SUMS = _struct(year=_LONG, event_id=_LONG, event_name=_TEXT, course_name=_TEXT, course_num=_LONG, over_80=_LONG,
               sub_70=_LONG, total_rounds=_LONG, scored=_LONG, score_sum=_LONG)
INPUTS = _struct(dg_id=_LONG, player_name=_TEXT, teetime=_TIME, year=_LONG, event_id=_LONG, round=_LONG,
                 event_name=_TEXT, course_num=_LONG, score=_LONG, sg_total=_DOUBLE, wave_average=_DOUBLE)
INDEX = T.StructType([*FORM_INDEX.fields, T.StructField("period", _LONG)])
FACTORS = _struct(course_num=_LONG, course_factor_star=_DOUBLE)


def _bucket(buckets: int, *columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("long").alias("bucket")


def _distinct_buckets(rows: DataFrame) -> list[int]:
    """At most the number of buckets reaches the driver."""
    return sorted(r["bucket"] for r in rows.select("bucket").distinct().collect())


class MaintainedDifficulty:
    """Event difficulty and course factors of a rounds dataset, from sums."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.store, self.buckets = Snapshots(spark, root, "bucket"), buckets

    def update(self, events: DataFrame, rounds: DataFrame) -> None:
        """``events`` (year, event_id) landed; ``rounds`` are all their rounds now
        (an event without rounds vanishes)."""
        bucket = _bucket(self.buckets, *EVENT)
        events = joins.current_scope().keep(events.select(*EVENT, bucket).distinct().persist())
        touched = _distinct_buckets(events)
        sums = rounds.groupBy(*EVENT_KEYS).agg(
            F.count_if(F.col("score") >= HIGH_SCORE).alias("over_80"),
            F.count_if(F.col("score") < LOW_SCORE).alias("sub_70"),
            F.count(F.lit(1)).alias("total_rounds"), F.count("score").alias("scored"),
            F.coalesce(F.sum("score"), F.lit(0)).alias("score_sum")).select(*[f.name for f in SUMS.fields], bucket)
        before = self.store.read(SUMS, values=touched)
        before = join_small(before, events.select(*EVENT), EVENT, "left_anti", null_safe=True)
        version = self.store.write(before.unionByName(sums).repartition("bucket"))
        self.store.commit({b: version for b in touched})

    def counts(self) -> DataFrame:
        """Input of ``difficulty_from_counts``."""
        return self.store.read(SUMS).select(*EVENT_KEYS, "over_80", "sub_70", "total_rounds", F.when(
            F.col("scored") > 0, ieee_div("score_sum", "scored")).alias("scoring_average"))

    def difficulty(self) -> DataFrame:
        return difficulty_from_counts(self.counts())

    def factors(self) -> DataFrame:
        return course_factor(self.difficulty())


class MaintainedIndex:
    """Rolling form index for several periods over a growing rounds dataset."""

    def __init__(self, spark: SparkSession, root: str, periods: Sequence[int] = (25, 50, 75, 100), buckets: int = 256):
        self.spark, self.periods, self.buckets = spark, sorted({int(p) for p in periods}), buckets
        self.store = Snapshots(spark, root, "bucket")

    def index(self, period: int | None = None) -> DataFrame:
        """The index now: one period, or all with a ``period`` column."""
        names = [f.name for f in FORM_INDEX.fields]
        rows = self.store.read(INDEX, "index")
        return rows.select("period", *names) if period is None else rows.filter(F.col("period") == period).select(*names)

    def factors(self) -> DataFrame | None:
        """The factor table the index stands on (None before the first update)."""
        version = self.store.facts().get("factors")
        return None if version is None else self.spark.read.schema(FACTORS).parquet(self._factor_path(version))

    def _factor_path(self, version: str) -> str:
        return f"{self.store.root}/version={version}/factors"

    def update(self, events: DataFrame, rounds: DataFrame, touched: DataFrame, factors: DataFrame) -> list[int]:
        """``events`` (year, event_id) landed; ``rounds`` are all their rounds now;
        ``touched`` (dg_id, since) are the players to recompute and from when
        (``landing.merge_rounds`` gives all three); ``factors`` is the course factor
        table now. Returns the buckets rewritten. Call inside a ``run_scope``."""
        bucket = _bucket(self.buckets, "dg_id")
        before_factors, factors_now = self.factors(), materialize(
            factors.select(*[F.col(f.name).cast(f.dataType) for f in FACTORS.fields]), "factors")
        touched = touched.select("dg_id", "since").unionByName(
            rounds.select("dg_id", _time().alias("since")))
        if before_factors is not None:
            touched = touched.unionByName(self._moved(before_factors, factors_now))
        touched = materialize(touched.groupBy("dg_id").agg(F.min("since").alias("since")).select(
            "dg_id", "since", bucket), "touched")
        buckets = _distinct_buckets(touched)
        # inputs of the touched buckets: the landed events' rows are replaced
        scored = rounds.filter(F.col("score").isNotNull()).select("*", wave("teetime").alias("wave"))
        waves = scored.groupBy(*form.WAVE_KEYS).agg(F.avg("score").alias("wave_average"))
        names = [f.name for f in INPUTS.fields]
        landed = join_small(scored, waves, list(form.WAVE_KEYS), "inner", null_safe=True).select(*names, bucket)
        kept = join_small(self.store.read(INPUTS, "inputs", values=buckets), events.select(*EVENT).distinct(), EVENT,
                          "left_anti", null_safe=True)
        inputs = materialize(kept.select(*names, "bucket").unionByName(landed), "inputs")
        fresh = self._framed(inputs, touched, factors_now)
        # what stands: rows of other players, and rows before a player's first change
        old = self.store.read(INDEX, "index", values=buckets)
        columns = [f.name for f in INDEX.fields] + ["bucket"]
        old = join_small(old, touched.select("dg_id", "since"), ["dg_id"], "left", null_safe=True) \
            .filter(F.col("since").isNull() | (_time() < F.col("since"))).select(*columns)
        tables = {"inputs": inputs.repartition("bucket"),
                  "index": old.unionByName(fresh.select(*columns)).repartition("bucket")}
        version = self.store.write_all(tables)
        # the factor table goes with the version that stands on it
        factors_now.write.parquet(self._factor_path(version))
        self.store.commit({b: version for b in buckets}, facts={"factors": version})
        return buckets

    def _moved(self, before: DataFrame, now: DataFrame) -> DataFrame:
        """Every player (dg_id, since) of a course whose factor moved."""
        # a course that is in one table only has no factor in the other
        moved = before.unionByName(now).groupBy("course_num").agg(
            F.count(F.lit(1)).alias("n"), F.count_distinct(F.struct("course_factor_star")).alias("values"))
        moved = materialize(moved.filter((F.col("n") != 2) | (F.col("values") > 1)).select("course_num"), "moved")
        played = join_small(self.store.read(INPUTS, "inputs").select("dg_id", "teetime", "course_num"), moved,
                            ["course_num"], "left_semi")
        return played.select("dg_id", _time().alias("since"))

    def _framed(self, inputs: DataFrame, touched: DataFrame, factors: DataFrame) -> DataFrame:
        """The index rows of the touched players from their first change on."""
        own = join_small(inputs, touched.select("dg_id", "since"), ["dg_id"], "inner", null_safe=True)
        own = own.withColumn("__late", _time() >= F.col("since"))
        # of the rows before, a player's last p - 1 by the index's order (a limit
        # that Spark also applies in every map task)
        back = Window.partitionBy("dg_id").orderBy(*[F.col(c).desc_nulls_last() for c in form.ROUND_ORDER[1:]])
        lead = own.filter(~F.col("__late")).withColumn("__n", F.row_number().over(back)).filter(
            F.col("__n") < max(self.periods)).drop("__n")
        rows = materialize(join_small(own.filter("__late").unionByName(lead), factors, ["course_num"], "left"), "frame-rows")
        skew_safe = form.largest_player(rows) > form.max_group_rows(self.spark)
        frames = form._frames_blocked if skew_safe else form._frames_by_player
        framed = frames(rows, self.periods, lambda df: df).filter("__late")
        names = [f.name for f in INDEX.fields]
        return form.stacked(framed, self.periods).select(*names, _bucket(self.buckets, "dg_id"))


def _time() -> Column:
    """Tee time, before all others where missing (as the index orders it)."""
    return F.coalesce("teetime", F.lit(NO_TIME).cast("timestamp_ntz"))
