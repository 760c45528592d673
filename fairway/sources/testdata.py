"""Rounds-shaped view over the driver's generated tables.

The driver ships TPC-H-like tables plus an ``events`` table, not golf
feeds. This module maps ``events`` onto the rounds schema with plain column
expressions, so every query reads real generated data and grows with it. The
same mapping is written once more as SQL (``ROUNDS_SQL``) for the DuckDB
oracle; the two must stay in step.

Mapping (``cn = event_id % 37``, ``v = floor(value)``):
year = year(ts); event_id = day of month; round = source event_id % 4 + 1;
course = cn; score NULL for sign-ups, ``62 + v % 18`` on courses with
``cn % 9 = 0`` (never 80+), else ``62 + v % 24``; sg_total NULL for errors of
users with ``user_id % 5 = 0``, else ``round((value - 50) / 50, 3)``;
teetime = ts, a year earlier for ``event_id % 4 = 1`` (so the data has two
years); ``event_id % 41 = 5`` has no course number; every 29th row carries
another spelling of the player's name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairway.session import ship_package
from fairway.sources.schemas import ROUNDS

COURSES = 37


# Declared schemas of the driver tables used here (skips footer inference).
TABLE_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
              "o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def round_columns() -> list:
    """The rounds columns as expressions over the ``events`` columns."""
    cn = F.col("event_id") % COURSES
    v = F.floor("value").cast("long")
    day = F.dayofmonth("ts").cast("long")
    score = (
        F.when(F.col("event_type") == "signup", F.lit(None).cast("long"))
        .when(cn % 9 == 0, F.lit(62) + v % 18)
        .otherwise(F.lit(62) + v % 24)
    )
    sg_total = F.when((F.col("event_type") == "error") & (F.col("user_id") % 5 == 0),
                      F.lit(None).cast("double")).otherwise(
        F.round((F.col("value") - 50) / 50, 3))
    null_double = F.lit(None).cast("double")
    exprs = {
        "year": F.year("ts"),
        "event_id": day,
        "event_name": F.concat(F.lit("day_"), day.cast("string")),
        "dg_id": F.col("user_id"),
        "player_name": F.concat(F.when(F.col("event_id") % 29 == 0, "alt_user_").otherwise("user_"),
                                F.col("user_id").cast("string")),
        "round": F.col("event_id") % 4 + 1,
        "course_name": F.concat(F.lit("course_"), cn.cast("string")),
        "course_num": F.when(F.col("event_id") % 41 != 5, cn),
        "course_par": F.lit(72),
        "score": score,
        "sg_app": null_double,
        "sg_arg": null_double,
        "sg_ott": null_double,
        "sg_putt": null_double,
        "sg_t2g": null_double,
        "sg_total": sg_total,
        "teetime": F.col("ts"),
    }
    return [exprs[f.name].cast(f.dataType).alias(f.name) for f in ROUNDS.fields]


def rounds_from_events(events: DataFrame, earlier: str = "event_id % 4 = 1") -> DataFrame:
    """``earlier`` says which rows are a year back."""
    shifted = F.when(F.expr(earlier), F.col("ts") - F.expr("INTERVAL 1 YEAR"))
    return events.withColumn("ts", F.coalesce(shifted, "ts")).select(*round_columns())


def rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rounds dataset for a driver scale-factor folder."""
    return rounds_from_events(table(spark, sf_dir, "events"))


# For the standings: a sixth of the players have played in the earlier year only.
REPORT_EARLIER = "event_id % 4 = 1 OR user_id % 6 = 1"


def report_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rounds view of the standings reports."""
    return rounds_from_events(table(spark, sf_dir, "events"), REPORT_EARLIER)


def dense_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rounds view with ten players only: long histories for long periods."""
    return rounds_from_events(table(spark, sf_dir, "events").withColumn("user_id", F.col("user_id") % 10))


def landed_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rounds view with ``landed`` (time, type and number of its row) and the
    row's number ``key``; by ``key % 19``: 7 has no player id, 11 neither id nor name."""
    view = round_columns()
    rows = table(spark, sf_dir, "events")
    shifted = F.when(F.expr("event_id % 4 = 1"), F.col("ts") - F.expr("INTERVAL 1 YEAR"))
    landed = F.struct(F.col("ts").cast("timestamp").alias("at"), F.col("event_type").alias("file"),
                      F.col("event_id").alias("listed")).alias("landed")
    out = rows.withColumn("ts", F.coalesce(shifted, "ts")).select(*view, landed, F.col("event_id").alias("key"))
    none = F.col("key") % 19
    return out.withColumn("dg_id", F.when(~none.isin(7, 11), F.col("dg_id"))).withColumn(
        "player_name", F.when(none != 11, F.col("player_name")))


# DuckDB text of the same view, used by the oracle queries.
_ROUNDS_SQL_TEMPLATE = """{name} AS (
  SELECT CAST(year(e.ts) AS BIGINT) AS year,
         CAST(day(e.ts) AS BIGINT) AS event_id,
         'day_' || CAST(day(e.ts) AS VARCHAR) AS event_name,
         e.user_id AS dg_id,
         CASE WHEN e.event_id % 29 = 0 THEN 'alt_user_' ELSE 'user_' END
           || CAST(e.user_id AS VARCHAR) AS player_name,
         CAST(e.event_id % 4 + 1 AS BIGINT) AS round,
         'course_' || CAST(e.event_id % 37 AS VARCHAR) AS course_name,
         CASE WHEN e.event_id % 41 <> 5 THEN CAST(e.event_id % 37 AS BIGINT) END AS course_num,
         CAST(72 AS BIGINT) AS course_par,
         CAST(CASE WHEN e.event_type = 'signup' THEN NULL
                   WHEN (e.event_id % 37) % 9 = 0 THEN 62 + CAST(floor(e.value) AS BIGINT) % 18
                   ELSE 62 + CAST(floor(e.value) AS BIGINT) % 24 END AS BIGINT) AS score,
         CAST(NULL AS DOUBLE) AS sg_app,
         CAST(NULL AS DOUBLE) AS sg_arg,
         CAST(NULL AS DOUBLE) AS sg_ott,
         CAST(NULL AS DOUBLE) AS sg_putt,
         CAST(NULL AS DOUBLE) AS sg_t2g,
         CASE WHEN e.event_type = 'error' AND e.user_id % 5 = 0 THEN NULL
              ELSE round((e.value - 50) / 50, 3) END AS sg_total,
         e.ts AS teetime{extra}
  FROM {source} e)"""

_SHIFTED = """(
    SELECT * REPLACE (CASE WHEN {earlier} THEN ts - INTERVAL 1 YEAR ELSE ts END AS ts)
    FROM events)"""
ROUNDS_SQL = _ROUNDS_SQL_TEMPLATE.format(name="rounds", extra="", source=_SHIFTED.format(earlier="event_id % 4 = 1"))
DENSE_ROUNDS_SQL = _ROUNDS_SQL_TEMPLATE.format(name="rounds", extra="", source="""(
    SELECT * REPLACE (CASE WHEN event_id % 4 = 1 THEN ts - INTERVAL 1 YEAR ELSE ts END AS ts, user_id % 10 AS user_id)
    FROM events)""")
REPORT_ROUNDS_SQL = _ROUNDS_SQL_TEMPLATE.format(name="rounds", extra="", source=_SHIFTED.format(earlier=REPORT_EARLIER))
# the view with what a round landed from: its row's time, type and number; some
# rows have no player id, some no name either
LANDED_ROUNDS_SQL = _ROUNDS_SQL_TEMPLATE.format(
    name="landed_view", extra=", e.ts AS landed_at, e.event_type AS landed_file, e.event_id AS listed",
    source=_SHIFTED.format(earlier="event_id % 4 = 1"))
# the view plus the raw columns the landed documents are built from
ROUNDS_RAW_SQL = _ROUNDS_SQL_TEMPLATE.format(
    name="rounds_raw", extra=", e.ts AS ts, e.event_type AS event_type", source="events")


# ------------------------------------------------------ landed-document view
def payload_documents(events: DataFrame) -> DataFrame:
    """One payload JSON document (``value``) per ``events`` row, shaped like
    the feed: string event id, completion date, one player whose round
    ``event_id % 4 + 1`` is set and the other three absent.

    Completion date is the row's calendar date, so Saturday, Sunday and
    Monday rows are valid and the rest are quarantined. Sign-ups have no tee
    time (midnight); errors of users with ``user_id % 7 = 3`` carry a
    malformed tee time.

    Real documents land as many files, which Spark reads in parallel; the
    driver's table is a single row group, so the generated documents are
    spread round-robin over the shuffle partitions to stand for that.
    """
    events = events.repartition(int(events.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    r = dict(zip([f.name for f in ROUNDS.fields], round_columns()))
    rnd = F.col("event_id") % 4 + 1
    tee = (F.when(F.col("event_type") == "signup", F.lit(None).cast("string"))
           .when((F.col("event_type") == "error") & (F.col("user_id") % 7 == 3), F.lit("tbd"))
           .otherwise(F.lower(F.date_format("ts", "h:mma"))))
    detail = F.struct(
        r["course_name"].alias("course_name"), r["course_num"].alias("course_num"),
        r["course_par"].alias("course_par"), r["score"].alias("score"),
        r["sg_app"].alias("sg_app"), r["sg_arg"].alias("sg_arg"), r["sg_ott"].alias("sg_ott"),
        r["sg_putt"].alias("sg_putt"), r["sg_t2g"].alias("sg_t2g"),
        r["sg_total"].alias("sg_total"), tee.alias("teetime"))
    rounds_by_slot = [F.when(rnd == i, detail).alias(f"round_{i}") for i in range(1, 5)]
    player = F.struct(F.col("user_id").alias("dg_id"),
                      r["player_name"].alias("player_name"), *rounds_by_slot)
    day = F.dayofmonth("ts")
    doc = F.struct(
        F.concat(F.lit("day_"), day.cast("string")).alias("event_name"),
        day.cast("string").alias("event_id"),
        F.date_format("ts", "yyyy-MM-dd").alias("event_completed"),
        F.year("ts").cast("long").alias("year"),
        F.year("ts").cast("long").alias("season"),
        F.lit("pga").alias("tour"),
        F.array(player).alias("scores"))
    return events.select(F.to_json(doc).alias("value"))


def event_list_documents(events: DataFrame) -> DataFrame:
    """One event-list JSON document per (year, day) seen in ``events``; the
    tour alternates so the tour filter has work to do (odd days: pga)."""
    day = F.dayofmonth("ts").cast("long")
    per_event = events.groupBy(F.year("ts").cast("long").alias("calendar_year"),
                               day.alias("event_id")).agg(F.max("ts").alias("last_ts"))
    doc = F.struct(
        F.col("calendar_year"),
        F.date_format("last_ts", "yyyy-MM-dd").alias("date"),
        F.col("event_id"),
        F.concat(F.lit("day_"), F.col("event_id").cast("string")).alias("event_name"),
        F.lit("yes").alias("sg_categories"),
        F.lit("yes").alias("traditional_stats"),
        F.when(F.col("event_id") % 2 == 1, F.lit("pga")).otherwise(F.lit("euro")).alias("tour"))
    return per_event.select(F.to_json(doc).alias("value"))


def mixed_documents(events: DataFrame) -> DataFrame:
    """Documents with every kind of fault, three rounds each: the row's player
    has two rounds, a second player (id + 1,000,000) a third one; the other
    rounds are absent. By ``event_id % 20``: 0 is cut in half, 1 has text for its
    scores, 2 is of another tour, 3 has no completion date, 4 one that cannot
    be read. ``key`` is the row's own id."""
    r = dict(zip([f.name for f in ROUNDS.fields], round_columns()))
    slot, k = F.col("event_id") % 4 + 1, F.col("event_id") % 20
    tee = F.when((F.col("event_type") == "error") & (F.col("user_id") % 7 == 3), "tbd").when(
        F.col("event_type") != "signup", F.lower(F.date_format("ts", "h:mma")))
    detail = F.struct(*[r[c].alias(c) for c in ("course_name", "course_num", "course_par", "score", "sg_total")],
                      tee.alias("teetime"))
    # a column of its own: it stands in eight places, which would make code too long
    # for the JVM to compile
    events = events.withColumn("__detail", detail)

    def player(shift: int, name: str, *slots):
        return F.struct((F.col("user_id") + shift).alias("dg_id"), F.lit(name).alias("player_name"),
                        *[F.when(F.array_contains(F.array(*slots), F.lit(i).cast("long")), F.col("__detail"))
                          .alias(f"round_{i}") for i in range(1, 5)])

    day = F.dayofmonth("ts")
    doc = F.to_json(F.struct(
        day.cast("string").alias("event_id"),
        F.when(k == 4, F.date_format("ts", "MM/dd/yyyy")).when(k != 3, F.date_format("ts", "yyyy-MM-dd"))
        .alias("event_completed"),
        F.year("ts").cast("long").alias("year"), F.when(k == 2, "euro").otherwise("pga").alias("tour"),
        F.array(player(0, "first", slot, slot % 4 + 1), player(1_000_000, "second", (slot + 1) % 4 + 1))
        .alias("scores")))
    text = F.when(k == 0, F.substring(doc, 1, 80)).when(
        k == 1, F.regexp_replace(doc, '"score":[0-9]+', '"score":"sixty"')).otherwise(doc)
    return events.select(F.col("event_id").alias("key"), text.alias("value"))


def mixed_event_list(events: DataFrame) -> DataFrame:
    """Event list of the odd days; days ending in 1 are listed under two
    names, days ending in 3 twice."""
    days = events.select(F.year("ts").cast("long").alias("calendar_year"),
                         F.dayofmonth("ts").cast("long").alias("event_id")).distinct().where("event_id % 2 = 1")
    names = F.when(F.col("event_id") % 10 == 1, F.array(F.lit("a"), F.lit("b"))).when(
        F.col("event_id") % 10 == 3, F.array(F.lit("a"), F.lit("a"))).otherwise(F.array(F.lit("a")))
    return days.select("calendar_year", "event_id", F.explode(names).alias("event_name"))


# Rows at least behind each generated array file.
ARRAY_DOCUMENTS = 10_000


def spread(events: DataFrame, rows_each: int = ARRAY_DOCUMENTS) -> DataFrame:
    """Rows dealt round-robin over the shuffle partitions, with fewer partitions if
    they would hold under ``rows_each`` rows: a table of one row group is one task."""
    most = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return events.repartition(max(1, min(most, events.count() // rows_each)))


def _as_array(batches):
    """Lines of one array of all documents; as many batches as came, and one."""
    import pyarrow as pa

    last, text = None, "["
    for batch in batches:
        lines = []
        for value in batch.column("value").to_pylist():
            if last is not None:
                lines.append(f"{text}  {last},")
                text = ""
            last = value
        yield pa.record_batch([pa.array(lines, pa.string())], names=["value"])
    yield pa.record_batch([pa.array([f"{text}  {last or ''}\n]"])], names=["value"])


def write_array_files(documents: DataFrame, root: str) -> None:
    """Documents (``value``) as text files that each hold one array, printed over
    many lines; one file for each partition."""
    ship_package(documents.sparkSession)
    lines = documents.select(F.replace("value", F.lit(',"'), F.lit(',\n    "')).alias("value"))
    lines.mapInArrow(_as_array, "value string").write.text(root)
