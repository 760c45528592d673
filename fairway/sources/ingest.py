"""Ingest of landed feed documents into typed rounds.

Fetching is outside the engine: documents are landed as JSON files (one
event-list array, one payload object per event) or arrive as JSON text in a
column. Everything after landing is column expressions on Spark:

* event list: keep the ``pga`` tour;
* payload: ``scores[]`` is exploded to one row per player, then the four
  optional ``round_i`` structs are unpivoted (absent or null rounds vanish;
  a round whose score is null stays);
* event metadata (year, id, name) comes from the event list, joined on
  (event_id, year) after a size check;
* round dates count back from the completion date so round 1 is a Thursday
  (Monday finish: i-5 days, Sunday: i-4, Saturday 54-hole: i-3); any other
  completion weekday is invalid;
* tee times ``h:mma`` ("3:06pm") are combined with the round date; a missing
  tee time means midnight of the round date; malformed text is invalid.

Nothing is dropped: every round of every document is either valid or in the
quarantine frame with a reason, and a document without readable rounds is one
quarantined row. ``strict=True`` fails the job on the first such row instead.
Reasons (in this order): unreadable document (malformed JSON or a value of the
wrong type), other tour, event not in the list, event listed under several
names, no usable completion date, completion on another weekday, malformed tee
time. Duplicate rows of the event list count once.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fairway.functions.rules import slug
from fairway.operators.joins import join_small
from fairway.sources.schemas import (
    CORRUPT,
    EVENT_LIST,
    LANDED,
    LANDED_EVENT_LIST,
    LANDED_PAYLOAD,
    ROUNDS,
)

PGA_TOUR = "pga"
# hour and minute with one or two digits, then am/pm, any case
TEETIME_SHAPE = r"^(1[0-2]|0?[1-9]):([0-5]?[0-9])([AaPp])[Mm]$"
# Days from the completion date to round i's date, as an offset added to i.
WEEKDAY_OFFSETS = {0: -5, 6: -4, 5: -3}   # Monday, Sunday, Saturday (weekday(): Monday = 0)
# Reasons for whole documents.
UNREADABLE, OTHER_TOUR, UNLISTED, AMBIGUOUS, NO_DATE = (
    "unreadable document", "other tour", "event not in the list", "event listed under several names",
    "no usable completion date")


class IngestResult(NamedTuple):
    rounds: DataFrame
    quarantine: DataFrame


# ------------------------------------------------------------------ readers
def _readable(events: DataFrame) -> DataFrame:
    """The event list itself must be readable: a broken entry fails the job."""
    broken = F.raise_error(F.concat(F.lit("unreadable event list: "), F.substring(CORRUPT, 1, 200)))
    return events.withColumn("tour", F.when(F.col(CORRUPT).isNull(), F.col("tour"))
                             .otherwise(broken.cast("string"))).drop(CORRUPT)


def read_event_list(spark: SparkSession, path: str) -> DataFrame:
    """Landed event-list file(s): a JSON array of events."""
    return _readable(spark.read.schema(LANDED_EVENT_LIST).option("multiLine", True)
                     .option("columnNameOfCorruptRecord", CORRUPT).json(path))


def read_payloads(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Landed per-event payload files: one (pretty-printed) JSON object per
    file, or with ``multi_line=False`` JSON Lines (one document per line),
    which Spark splits across tasks within a file. What cannot be read as
    declared is kept in the column ``_corrupt_record``."""
    return landed_from(spark.read.schema(LANDED_PAYLOAD).option("multiLine", multi_line)
                       .option("columnNameOfCorruptRecord", CORRUPT).json(path))


def landed_from(documents: DataFrame) -> DataFrame:
    """Documents of a file scan with ``landed``: time and name of their file."""
    return documents.select("*", F.struct(
        F.col("_metadata.file_modification_time").alias("at"),
        F.col("_metadata.file_path").alias("file")).alias("landed"))


def parse_event_list(text: DataFrame, column: str = "value") -> DataFrame:
    """Event list from JSON text: either an array of events or one event. Text
    that cannot be read as declared, whole or in one entry, fails the job; null
    and blank text has no events."""
    # array entries first as text, so that one bad entry cannot empty the array; inside
    # an object, so that what follows the array is read too
    text_of = F.regexp_replace(F.col(column), r"^[\s\x{FEFF}]+", "")
    listed = F.concat(F.lit('{"e":'), F.when(text_of.startswith("["), text_of).otherwise(F.concat(F.lit("["), text_of, F.lit("]"))),
                      F.lit("}"))
    whole = F.from_json(listed, T.StructType([T.StructField("e", T.ArrayType(T.StringType())),
                                              T.StructField(CORRUPT, T.StringType())]), {"columnNameOfCorruptRecord": CORRUPT})
    unreadable = F.raise_error(F.concat(F.lit("unreadable event list: "), F.substring(F.col(column), 1, 200)))
    text = text.filter(text_of != "").select(F.col(column), whole.alias("__w"))
    entries = F.when(F.col(f"__w.{CORRUPT}").isNull() & F.col("__w.e").isNotNull(), F.col("__w.e")).otherwise(
        unreadable.cast("array<string>"))
    events = text.select(F.explode(entries).alias("__entry")).select(
        F.from_json(F.col("__entry"), LANDED_EVENT_LIST, {"columnNameOfCorruptRecord": CORRUPT}).alias("e"), "__entry")
    broken = F.col("e").isNull() | F.col(f"e.{CORRUPT}").isNotNull() | F.col("__entry").isNull()
    told = F.raise_error(F.concat(F.lit("unreadable event list: "), F.substring(F.coalesce("__entry", F.lit("null")), 1, 200)))
    checked = F.when(broken, told.cast("string")).otherwise(F.col("e.tour"))
    return events.select(*[(checked if f.name == "tour" else F.col(f"e.{f.name}")).alias(f.name) for f in EVENT_LIST.fields])


def parse_payloads(text: DataFrame, column: str = "value", *keep: str) -> DataFrame:
    """Payload objects from JSON text (one document per row). ``keep``: further
    columns."""
    return text.select(F.from_json(F.col(column), LANDED_PAYLOAD, {
        "columnNameOfCorruptRecord": CORRUPT}).alias("p"), *keep).select("p.*", *keep)


def read_split_payloads(spark: SparkSession, path: str, range_bytes: int | None = None) -> DataFrame:
    """Landed payload files of any size and shape (pretty-printed, arrays of
    documents, documents one after another), each read by many tasks. A document
    that cannot be read is one row with its text in ``_corrupt_record``; the others
    of its file are not affected."""
    from fairway.sources import json_split

    documents = json_split.read_documents(spark, path, range_bytes or json_split.RANGE_BYTES)
    return parse_payloads(documents, "value", "landed")


def pga_events(events: DataFrame) -> DataFrame:
    """Keep the PGA tour's events; all fields and their order are kept."""
    return events.filter(F.col("tour") == PGA_TOUR)


# ---------------------------------------------------------------- transforms
def unpivot_rounds(payloads: DataFrame, *keep: str) -> DataFrame:
    """One row per (document, player, present round); a document without any
    gives one row without player and round. ``keep``: further columns."""
    # explode_outer + explicit filters: the same rows as explode, but Catalyst
    # does not infer a size(scores) > 0 filter that it would push below an
    # exchange (re-parsing every document there)
    players = payloads.select(
        F.col("event_id").try_cast("long").alias("event_id"),
        F.col("year").alias("payload_year"),
        F.col("event_completed"), *keep,
        F.posexplode_outer(F.filter("scores", lambda p: F.exists(
            F.array(*[p[f"round_{i}"] for i in range(1, 5)]), lambda r: r.isNotNull()))).alias("listed", "p"))
    rounds = players.select(
        "event_id", "payload_year", "event_completed", *keep, F.col("listed").cast("long").alias("listed"),
        F.col("p.dg_id").alias("dg_id"),
        F.col("p.player_name").alias("player_name"),
        F.posexplode(F.array(*[F.col(f"p.round_{i}") for i in range(1, 5)])).alias("pos", "r"),
        F.col("p").isNull().alias("__none"))
    return rounds.filter(F.col("r").isNotNull() | (F.col("__none") & (F.col("pos") == 0))).select(
        "event_id", "payload_year", "event_completed", *keep, "dg_id", "player_name",
        F.when(~F.col("__none"), (F.col("pos") + 1).cast("long")).alias("round"), "r", "listed")


def round_date(completed: F.Column, round_no: F.Column) -> F.Column:
    """Date of round ``round_no`` for an event completed on ``completed``;
    NULL when the completion weekday is not Saturday, Sunday or Monday."""
    wd = F.weekday(completed)
    offset = F.when(wd == 0, F.lit(WEEKDAY_OFFSETS[0])).when(
        wd == 6, F.lit(WEEKDAY_OFFSETS[6])).when(wd == 5, F.lit(WEEKDAY_OFFSETS[5]))
    return F.date_add(completed, (round_no + offset).cast("int"))


def teetime_at(day: F.Column, text: F.Column) -> F.Column:
    """Tee time text on ``day`` as a wall-clock timestamp (seconds 0);
    midnight when the text is missing; NULL when it is malformed or the day
    is missing. Built from its parts, so no text can fail the job."""
    part = lambda i: F.regexp_extract(text, TEETIME_SHAPE, i)
    hour = part(1).try_cast("int") % 12 + F.when(F.lower(part(3)) == "p", 12).otherwise(0)
    midnight = day.cast("timestamp_ntz")
    at = midnight + F.make_dt_interval(hours=hour, mins=part(2).try_cast("int"))
    return F.when(text.isNull(), midnight).when(text.rlike(TEETIME_SHAPE), at)


def _listed(events: DataFrame) -> DataFrame:
    """One row per (event id, year) of the list; ``names`` counts its names."""
    return events.groupBy("event_id", F.col("calendar_year").alias("payload_year")).agg(
        F.min("event_name").alias("listed_name"),
        F.count_distinct(F.struct("event_name")).alias("names"))


def staged_rounds(payloads: DataFrame, events: DataFrame, tour: str = PGA_TOUR) -> DataFrame:
    """Every round with ``valid`` and, where not, its ``reason``."""
    if CORRUPT not in payloads.columns:
        payloads = payloads.withColumn(CORRUPT, F.lit(None).cast("string"))
    # an unreadable document is one row, whatever the parser made of its parts
    readable = payloads.withColumn("scores", F.when(F.col(CORRUPT).isNull(), F.col("scores")))
    if "landed" not in readable.columns:
        readable = readable.withColumn("landed", F.lit(None).cast("struct<at:timestamp,file:string>"))
    long = unpivot_rounds(readable, "tour", CORRUPT, "landed")
    joined = join_small(long, _listed(events), ["event_id", "payload_year"], "left")
    completed = F.col("event_completed").try_cast("date")
    rd = round_date(completed, F.coalesce("round", F.lit(1).cast("long")))
    tee = teetime_at(rd, F.col("r.teetime"))
    reason = (
        F.when(F.col(CORRUPT).isNotNull(), F.lit(UNREADABLE))
        .when(F.coalesce(F.col("tour") != tour, F.lit(True)), F.lit(OTHER_TOUR))
        .when(F.col("names").isNull(), F.lit(UNLISTED))
        .when(F.col("names") > 1, F.lit(AMBIGUOUS))
        .when(completed.isNull(), F.lit(NO_DATE))
        .when(rd.isNull(), F.concat(F.lit("completed on "), F.date_format(completed, "EEEE"),
                                    F.lit(", expected Saturday to Monday")))
        .when(F.col("round").isNull(), F.lit("document without rounds"))
        .when(tee.isNull(), F.concat(F.lit("malformed tee time '"), F.coalesce("r.teetime", F.lit("")),
                                     F.lit("'"))))
    return joined.select(
        F.col("payload_year").alias("year"), "event_id", F.col("listed_name").alias("event_name"),
        "dg_id", "player_name", "round", "r", tee.alias("teetime"), "event_completed",
        F.col(CORRUPT).alias("document"), F.struct("landed.at", "landed.file", "listed").alias("landed"),
        reason.alias("reason")).withColumn("valid", F.col("reason").isNull())


def split_rounds(staged: DataFrame, stamped: bool = False) -> IngestResult:
    """Valid rounds (``schemas.ROUNDS``; ``stamped``: and ``landed``) and
    quarantined rows of staged ones."""
    valid = staged.filter("valid").select(
        "year", "event_id", "event_name", "dg_id", "player_name", "round",
        *[F.col(f"r.{c}").alias(c) for c in ("course_name", "course_num", "course_par", "score",
                                             "sg_app", "sg_arg", "sg_ott", "sg_putt", "sg_t2g",
                                             "sg_total")],
        "teetime", "landed")
    valid = valid.select([F.col(f.name).cast(f.dataType) for f in ROUNDS.fields + [LANDED] * stamped])
    quarantine = staged.filter(~F.col("valid")).select(
        "year", "event_id", "event_name", "dg_id", "player_name", "round",
        F.col("r.teetime").alias("teetime_text"), "event_completed", "document", "reason")
    return IngestResult(valid, quarantine)


def rounds_from_payloads(payloads: DataFrame, events: DataFrame, *, strict: bool = False,
                         ) -> IngestResult:
    """Typed rounds (``schemas.ROUNDS``) plus quarantined rows with a reason."""
    staged = staged_rounds(payloads, events)
    if strict:
        failed = F.raise_error(F.concat(
            F.lit("event "), F.coalesce(F.col("event_id").cast("string"), F.lit("?")), F.lit(" of "),
            F.coalesce(F.col("year").cast("string"), F.lit("?")), F.lit(": "), F.col("reason")))
        staged = staged.withColumn("valid", F.when(F.col("valid"), True).otherwise(failed.cast("boolean")))
    return split_rounds(staged)


# -------------------------------------------------------------- incremental
def event_slug(events: DataFrame) -> DataFrame:
    """The file key of an event: its year and a slug of its name."""
    return events.withColumn("event_slug", slug("event_name"))


def new_events(events: DataFrame, landed_keys: DataFrame, *, by_slug: bool = False) -> DataFrame:
    """Events not landed yet (``left_anti``). The key is (year, event_id);
    ``by_slug=True`` keys on (year, slug(name)) instead, where two events of
    a year with the same name collide, as with name-keyed files."""
    if by_slug:
        keyed = event_slug(events)
        landed = landed_keys.select(F.col("year").alias("__y"), F.col("event_slug").alias("__s"))
        cond = (F.col("calendar_year") == F.col("__y")) & (F.col("event_slug") == F.col("__s"))
        return keyed.join(landed, cond, "left_anti").drop("event_slug")
    landed = landed_keys.select(F.col("year").alias("__y"), F.col("event_id").alias("__e"))
    cond = (F.col("calendar_year") == F.col("__y")) & (F.col("event_id") == F.col("__e"))
    return events.join(landed, cond, "left_anti")


def unlanded_payloads(payloads: DataFrame, landed_keys: DataFrame) -> DataFrame:
    """Documents whose event has not landed yet; unreadable ones stay."""
    landed = landed_keys.select(F.col("year").alias("__y"), F.col("event_id").alias("__e")).distinct()
    return payloads.join(landed, (F.col("year") == F.col("__y"))
                         & (F.col("event_id").try_cast("long") == F.col("__e")), "left_anti")


def landed_event_keys(rounds: DataFrame) -> DataFrame:
    """Distinct (year, event_id, event_slug) already present in a rounds dataset."""
    return rounds.select("year", "event_id", slug("event_name").alias("event_slug")).distinct()


def course_dimension(schedule: DataFrame, events: DataFrame) -> DataFrame:
    """Course rows (``schemas.COURSE_INFO``) for scheduled events that are in
    the event list (semi join)."""
    wanted = events.select(F.col("event_id").alias("__e"))
    kept = schedule.join(wanted, F.col("event_id") == F.col("__e"), "left_semi")
    return kept.select(
        F.col("course").alias("course_name"),
        F.col("course_key").cast("long").alias("course_num"),
        F.col("latitude").cast("double").alias("latitude"),
        F.col("longitude").cast("double").alias("longitude"),
        F.col("location").alias("location"))
