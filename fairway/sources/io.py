"""Parquet and CSV sinks/scans of the engine's datasets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fairway.session import ship_package
from fairway.sources.files import list_files, open_input
from fairway.sources.schemas import FORM_INDEX, LANDED, ROUNDS, SchemaMismatch
from fairway.sources.snapshots import Snapshots


def write_rounds(rounds: DataFrame, root: str, by_event: bool = True) -> None:
    """Rounds dataset. By event (default): folders ``year``/``event_id``, and only
    the events present in ``rounds`` are replaced, which makes a retried batch
    idempotent. Else by ``year``, replacing the whole dataset."""
    parts = ["year", "event_id"] if by_event else ["year"]
    # where rounds say what they landed from, that is stored beside them
    fields = ROUNDS.fields + ([LANDED] if LANDED.name in rounds.columns else [])
    typed = rounds.select([F.col(f.name).cast(f.dataType) for f in fields])
    # rebalance (not repartition) on the folder columns: AQE splits a hot year
    # over several tasks and merges small ones, so no task writes a whole year
    typed.hint("rebalance", *parts).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic" if by_event else "static").partitionBy(*parts).parquet(root)


# Footers of a dataset's files: one row a file, kept beside the files.
FOOTERS = "_footers"
_FOOTER_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("size", T.LongType()), T.StructField("at", T.TimestampType()),
    T.StructField("rows", T.LongType()), T.StructField("columns", T.ArrayType(T.StructType([
        T.StructField("name", T.StringType()), T.StructField("type", T.StringType()),
        T.StructField("low", T.DoubleType()), T.StructField("high", T.DoubleType()),
        T.StructField("nulls", T.LongType())])))])


def _read_footers(batches):
    """Rows, columns and the columns' minima and maxima (numbers as they are,
    times in microseconds) of each file, from its footer."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    def number(x):
        if hasattr(x, "timestamp"):
            import datetime as dt

            x = x if x.tzinfo else x.replace(tzinfo=dt.timezone.utc)
            return float((x - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1))
        return float(x) if isinstance(x, (int, float)) else None

    kind = pa.list_(pa.struct([("name", pa.string()), ("type", pa.string()), ("low", pa.float64()),
                               ("high", pa.float64()), ("nulls", pa.int64())]))
    for batch in batches:
        rows, columns = [], []
        for path in batch.column("path").to_pylist():
            with open_input(path) as file:
                whole = pq.ParquetFile(file)
                meta, found = whole.metadata, {f.name: [str(f.type), [], [], 0] for f in whole.schema_arrow}
            for g in range(meta.num_row_groups):
                for c in range(meta.num_columns):
                    column = meta.row_group(g).column(c)
                    held, stats = found.get(column.path_in_schema), column.statistics
                    if held is None:
                        continue
                    # one group without statistics leaves the file without
                    known = stats is not None and stats.has_null_count and held[3] is not None
                    held[3] = held[3] + stats.null_count if known else None
                    if stats is not None and stats.has_min_max:
                        held[1].append(number(stats.min))
                        held[2].append(number(stats.max))
                    elif not known or stats.null_count < meta.row_group(g).num_rows:
                        held[1].append(None)
            rows.append(meta.num_rows)
            columns.append([{"name": n, "type": t, "nulls": nulls,
                             "low": None if not low or None in low else min(low),
                             "high": None if not low or None in low else max(high)}
                            for n, (t, low, high, nulls) in found.items()])
        yield pa.record_batch([*(batch.column(c) for c in ("path", "size", "at")), pa.array(rows, pa.int64()),
                               pa.array(columns, kind)], names=["path", "size", "at", "rows", "columns"])


def dataset_footers(spark: SparkSession, root: str, kept: str | None = None) -> DataFrame:
    """What the footers of the dataset's files say: path, size, at, rows, columns
    (name, type, low, high, nulls). Footers read once are kept in ``_footers`` beside
    the files (or in ``kept``, where that folder may not be written); only files not seen before (by path, size and time) are opened, in
    tasks, and no list of files passes through the driver's Python."""
    ship_package(spark)
    key, kept = ["path", "size", "at"], kept or f"{root.rstrip('/')}/{FOOTERS}"
    files = list_files(spark, root, "*.parquet")
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(kept)
    stored = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)
    if stored:
        known = spark.read.schema(_FOOTER_SCHEMA).parquet(kept)
        unseen = files.join(known.select(*key), key, "left_anti")
    else:
        unseen = files
    tasks = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    if not stored or unseen.limit(1).count():
        unseen.repartition(tasks, "path").mapInArrow(_read_footers, _FOOTER_SCHEMA).coalesce(
            max(1, tasks // 16)).write.mode("append").parquet(kept)
    known = spark.read.schema(_FOOTER_SCHEMA).parquet(kept)
    return known.join(files, key, "left_semi").dropDuplicates(key)   # two readers may have added a file


def dataset_statistics(spark: SparkSession, root: str, kept: str | None = None) -> DataFrame:
    """Files, rows, and per column the lowest and highest value and the nulls of a
    whole dataset, from its footers only (folder columns have none)."""
    per = dataset_footers(spark, root, kept).select("path", "rows", F.explode("columns").alias("c")).select("path", "rows", "c.*")
    whole = lambda x: F.when(F.count_if(F.col(x).isNull() & (F.coalesce("nulls", F.lit(-1).cast("long")) < F.col("rows"))) == 0, 1)
    return per.groupBy("name").agg(
        F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"),
        F.when(whole("low") == 1, F.min("low")).alias("low"), F.when(whole("high") == 1, F.max("high")).alias("high"),
        F.when(F.count_if(F.col("nulls").isNull()) == 0, F.sum("nulls")).alias("nulls"))


def file_schemas(spark: SparkSession, root: str, kept: str | None = None) -> list[tuple[str, dict[str, str]]]:
    """(example file, physical columns) of every different schema among the
    Parquet files of a dataset; as many rows as there are schemas."""
    columns = F.array_sort(F.transform("columns", lambda c: F.concat(c["name"], F.lit("\t"), c["type"])))
    found = dataset_footers(spark, root, kept).groupBy(columns.alias("columns")).agg(F.min("path").alias("path")).collect()
    return [(r["path"], dict(c.split("\t") for c in r["columns"])) for r in found]


def read_rounds(spark: SparkSession, root: str, footers: str | None = None) -> DataFrame:
    """Scan a rounds dataset with the declared schema, after checking the
    stored schema of every file (Spark would silently NULL-fill a missing
    column; ``footers``: see ``dataset_footers``). Partition folders (``year``, ``event_id``) are typed by the
    declaration, not by inference."""
    scan = spark.read.schema(ROUNDS).parquet(root)
    problems = []
    for path, columns in file_schemas(spark, root, footers):
        folders = {part.partition("=")[0] for part in path.split("/") if "=" in part}
        for field in ROUNDS.fields:
            if field.name in folders:
                continue
            if field.name not in columns:
                problems.append(f"missing column {field.name} in {path}")
            elif not columns[field.name].startswith(_ARROW_TYPES[field.dataType.simpleString()]):
                problems.append(f"{field.name}: {columns[field.name]} in {path}")
    if problems:
        raise SchemaMismatch("; ".join(sorted(problems)))
    # partition columns come last from the reader; restore the declared order
    return scan.select(*[f.name for f in ROUNDS.fields])


# Arrow's names of the declared column types.
_ARROW_TYPES = {"bigint": "int64", "string": ("string", "large_string"), "double": "double",
                "timestamp_ntz": "timestamp"}


def form_order() -> list:
    """Order of the rolling index's rows: player, name and tee time, descending."""
    return [F.col(c).desc_nulls_first() for c in ("dg_id", "player_name", "teetime")]


def write_form_index(long: DataFrame, root: str, periods: Sequence[int] | None = None) -> None:
    """Rolling index, one folder per ``period``. ``periods`` are replaced as a
    whole, also those that have no rows now; by default the whole dataset is.

    *Atomic*: the rows become visible by one manifest (``snapshots``), so readers
    see the old periods until all new ones are written, whatever fails.

    *Ordered*: rows are range-partitioned over period and ``form_order``, with
    boundaries from one sampling pass over the keys of the staged rows, and sorted
    in each range. A period's files read in name order are therefore sorted as a
    whole, no task gets a whole period or a hot player, and a player's rows lie
    in neighbouring files that the footers' minima and maxima tell apart.
    """
    from fairway.operators.joins import materialize

    staged = materialize(long, "form-index")   # sampled and sorted without framing twice
    order = [F.col("period"), *form_order()]
    ordered = staged.repartitionByRange(*order).sortWithinPartitions(*order)
    store = Snapshots(long.sparkSession, root, "period")
    version = store.write(ordered)
    changes = {p: version for p in store.written(version)}
    if periods is not None:
        changes = {int(p): changes.get(int(p)) for p in periods}
    store.commit(changes, drop_others=periods is None)


def read_form_index(spark: SparkSession, root: str, period: int, player: int | None = None) -> DataFrame:
    """One period of the rolling index (partition pruning on ``period``), or one
    player of it (pushed down to the one or two files that hold it)."""
    where = F.col("period") == period
    if player is not None:
        where = where & (F.col("dg_id") == player)
    rows = Snapshots(spark, root, "period").read(FORM_INDEX, where=where, values=[period])
    return rows.select(*[f.name for f in FORM_INDEX.fields])


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV export with a header (inf/NaN are written as Infinity/NaN)."""
    df.write.mode(mode).option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV scan; typed when ``schema`` is given, inferred otherwise. Files
    written by other tools spell infinities ``inf``/``-inf``; by default Spark
    would read those as NULL, so both spellings are accepted."""
    reader = spark.read.option("header", True).option("positiveInf", "inf") \
        .option("negativeInf", "-inf")
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def write_event_list(events: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Keep the parsed event list as JSON lines (the landed list is fetched once)."""
    events.write.mode(mode).json(path)


def read_event_list_lines(spark: SparkSession, path: str) -> DataFrame:
    from fairway.sources.schemas import EVENT_LIST

    return spark.read.schema(EVENT_LIST).json(path)
