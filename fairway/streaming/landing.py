"""Incremental ingest of a landing folder with Structured Streaming.

The file source remembers in its checkpoint which documents were already
processed, which is the "skip events already collected" rule of a batch
loader without any listing or existence check on the driver. Each
micro-batch is parsed once into a staged table and split. Its rounds are merged
with what is stored for their events, so an event may come in several documents
and batches. Quarantined rows are a log with one folder per batch. ``availableNow``
drains everything that is there and stops.

*One rule for a round that lands more than once*, in one batch or in several: the
landing with the greatest (file time, file name, place in the document, content)
stays. Every stored round keeps these beside it, so the rule gives the same rows
in whatever order batches come, and a batch that is retried or replayed changes
nothing. *A round's key* is its event, player and round, where missing values are
values: a player without an id is known by the name, one without either by the
whole row.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from fairway.operators.joins import join_keys, materialize, run_scope
from fairway.sources import ingest, io
from fairway.sources.schemas import CORRUPT, LANDED, LANDED_PAYLOAD, ROUNDS

ROUND_KEY = ("year", "event_id", "dg_id", "round")
# Events of a batch whose stored folders are named one by one in the scan's filter.
NAMED_EVENTS = 1000
# Stands for "before every tee time" where a round has none.
NO_TIME = "0001-01-01 00:00:00"
_STORED = T.StructType([*ROUNDS.fields, LANDED])


def landing_stream(spark: SparkSession, landing_dir: str,
                   max_files_per_trigger: int | None = None,
                   multi_line: bool = True) -> DataFrame:
    """Stream of payload documents (one JSON object per file, or JSON Lines
    with ``multi_line=False``)."""
    reader = spark.readStream.schema(LANDED_PAYLOAD).option("multiLine", multi_line) \
        .option("columnNameOfCorruptRecord", CORRUPT)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return ingest.landed_from(reader.json(landing_dir))


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def latest_rounds(rounds: DataFrame) -> DataFrame:
    """Each round once: its greatest landing (see the module's rule)."""
    if LANDED.name not in rounds.columns:
        rounds = rounds.withColumn(LANDED.name, F.lit(None).cast(LANDED.dataType))
    names = [f.name for f in ROUNDS.fields]
    text = F.to_json(F.struct(*names))
    name = F.when(F.col("dg_id").isNull(), F.coalesce("player_name", F.concat(F.lit("\u0000"), F.md5(text))))
    keyed = rounds.select(*names, LANDED.name, name.alias("__name"), F.struct(
        F.col("landed.at"), F.col("landed.file"), F.col("landed.listed"), text).alias("__order"))
    # grouping, unlike a join, takes NULL keys as values
    best = keyed.groupBy(*ROUND_KEY, "__name").agg(F.max_by(F.struct(*names, LANDED.name), "__order").alias("r"))
    return best.select("r.*")


def stored_rounds(spark: SparkSession, root: str, events: DataFrame) -> DataFrame:
    """The stored rounds (with ``landed``) of ``events`` (year, event_id). The
    folders of a batch's few events are named in the scan's partition filter;
    beyond ``NAMED_EVENTS`` it is a join."""
    stored = spark.read.schema(_STORED).parquet(root)
    named = events.limit(NAMED_EVENTS + 1).collect()
    if len(named) > NAMED_EVENTS:
        return join_keys(stored, events, ["year", "event_id"], "left_semi", null_safe=True)
    of_year: dict = {}
    for r in named:
        of_year.setdefault(r["year"], set()).add(r["event_id"])
    keep = F.lit(False)
    for year, ids in of_year.items():
        known = [i for i in ids if i is not None]
        own = F.col("event_id").isin(known) if known else F.lit(False)
        keep = keep | (F.col("year").eqNullSafe(F.lit(year)) & (own | F.col("event_id").isNull() if None in ids else own))
    return stored.filter(keep)


class Merged(NamedTuple):
    """What a merge did: the events that landed (year, event_id), all their rounds
    now, and every player they had before or have now, from which tee time on
    (dg_id, since)."""

    events: DataFrame
    rounds: DataFrame
    touched: DataFrame


def merge_rounds(rounds: DataFrame, root: str) -> Merged:
    """Merge ``rounds`` into the dataset at ``root``; rounds of other events are
    not read. Call inside a ``run_scope``."""
    spark = rounds.sparkSession
    if LANDED.name not in rounds.columns:
        rounds = rounds.withColumn(LANDED.name, F.lit(None).cast(LANDED.dataType))
    columns = [f.name for f in _STORED.fields]
    both = rounds.select(*columns)
    events = materialize(both.select("year", "event_id").distinct(), "landed-events")
    if _exists(spark, root):
        both = both.unionByName(stored_rounds(spark, root, events).select(*columns))
    # written once before the folders it was read from are replaced
    both = materialize(both, "landings")
    merged = materialize(latest_rounds(both), "merged")
    io.write_rounds(merged, root)
    since = F.min(F.coalesce("teetime", F.lit(NO_TIME).cast("timestamp_ntz"))).alias("since")
    return Merged(events, merged, both.groupBy("dg_id").agg(since))


def open_quarantine(log: DataFrame, rounds: DataFrame) -> DataFrame:
    """The rows of the quarantine log that are still open: the latest row of
    each round (player without an id: by name) that has not landed since, and
    every row without a round."""
    name = F.when(F.col("dg_id").isNull(), F.col("player_name")).alias("__name")
    latest = Window.partitionBy(*ROUND_KEY, "__name").orderBy(F.col("batch").desc())
    named = log.where("round IS NOT NULL").select("*", name).withColumn("__n", F.row_number().over(latest)).where("__n = 1").drop("__n")
    landed = rounds.select(*ROUND_KEY, name).distinct()
    return join_keys(named, landed, [*ROUND_KEY, "__name"], "left_anti", null_safe=True).drop("__name").unionByName(
        log.where("round IS NULL").select(*log.columns))


def start_ingest(spark: SparkSession, landing_dir: str, events: DataFrame, rounds_root: str,
                 quarantine_root: str, checkpoint_location: str, *, available_now: bool = True,
                 processing_time: str | None = None,
                 max_files_per_trigger: int | None = None,
                 multi_line: bool = True, difficulty_root: str | None = None,
                 index_root: str | None = None, periods: Sequence[int] = (25, 50, 75, 100)) -> StreamingQuery:
    """Start the incremental ingest. ``events`` is the (static) event list,
    already filtered to the tour of interest. With ``difficulty_root`` every
    micro-batch also keeps the difficulty sums there up to date, with ``index_root``
    the rolling index of ``periods`` (which needs the sums for its factors). A
    batch that fails on the way is run again: each of these steps may be repeated."""
    if index_root and not difficulty_root:
        raise ValueError("index_root needs difficulty_root")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        from fairway.streaming.maintained import MaintainedDifficulty, MaintainedIndex

        spark = batch.sparkSession
        with run_scope():
            staged = materialize(ingest.staged_rounds(batch, events), "staged")
            result = ingest.split_rounds(staged, stamped=True)
            merged = merge_rounds(result.rounds, rounds_root)
            if difficulty_root:
                sums = MaintainedDifficulty(spark, difficulty_root)
                sums.update(merged.events, merged.rounds)
                if index_root:
                    MaintainedIndex(spark, index_root, periods).update(*merged, sums.factors())
            result.quarantine.withColumn("batch", F.lit(batch_id).cast("long")).write.mode("overwrite") \
                .option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(quarantine_root)

    writer = landing_stream(spark, landing_dir, max_files_per_trigger, multi_line).writeStream \
        .foreachBatch(write_batch).option("checkpointLocation", checkpoint_location)
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
