"""Distributed row numbering over a total order.

``row_number().over(Window.orderBy(...))`` moves every row into one task.
Here the rows are range-partitioned on the order (Spark samples the keys, so
a key holding a third of all rows is still split across tasks), sorted
within partitions, and numbered as ``offset(partition) + position``. The
per-partition counts have one row per partition, a proven bound, so they are
broadcast.

Range boundaries come from sampling, and two scans of the same plan may
sample differently; the tagged rows (partition id and position stored as
columns) are therefore written once as a Parquet table in the shared
checkpoint folder, and both the counts and the numbering read that frozen
copy. This also cuts the lineage, so a lost executor never forces a re-sort,
and the counts read a single column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fairway.operators import joins
from fairway.operators.joins import materialize

ColumnOrName = Column | str


def global_row_number(df: DataFrame, order: Sequence[ColumnOrName], name: str = "index",
                      partitions: int | None = None) -> DataFrame:
    """Add ``name``: the 1-based position of each row in ``order``.

    ``order`` should be a total order (add tie-breaks) so the numbering is
    deterministic across task retries.
    """
    # Without an explicit count AQE may merge adjacent small range partitions
    # (still a range partitioning, and positions are frozen right after), so
    # a small input does not fan out to every shuffle partition.
    ranged = (df.repartitionByRange(partitions, *order) if partitions
              else df.repartitionByRange(*order)).sortWithinPartitions(*order)
    tagged = materialize(ranged.select("*", F.spark_partition_id().alias("__pid"),
                                       F.monotonically_increasing_id().alias("__mid")),
                         "ordered")
    counts = tagged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    # At most one row per partition: a single-partition window is fine here.
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col("__pid").alias("__opid"),
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    joined = tagged.join(F.broadcast(offsets), F.col("__pid") == F.col("__opid"), "inner")
    # monotonically_increasing_id = (partition << 33) + position in partition
    position = F.col("__mid") - F.shiftleft(F.col("__pid").cast("long"), 33)
    return joined.withColumn(name, F.col("__off") + position + F.lit(1)).drop(
        "__pid", "__mid", "__opid", "__off")


def row_number_checked(df: DataFrame, order: Sequence[ColumnOrName], name: str = "index",
                       max_rows: int | None = None, rows_bound: int | None = None) -> DataFrame:
    """``global_row_number`` with a checked shortcut: the input is cached and
    counted (unless ``rows_bound``, a proven bound, is given); up to ``max_rows`` rows (default ``spark.fairway.maxWindowGroupRows``)
    one ordered window numbers them in a single task — a proven bound, like a
    broadcast — and beyond it the distributed numbering runs. ``order`` must be
    total, so that both give the same numbers."""
    spark = df.sparkSession
    if max_rows is None:
        value = spark.conf.get("spark.fairway.maxWindowGroupRows", None)
        max_rows = int(value) if value else 2_000_000
    if rows_bound is None or rows_bound > max_rows:
        df = joins.current_scope().keep(df.persist(StorageLevel.MEMORY_AND_DISK))
        rows_bound = df.count()
    cached = df
    if rows_bound <= max_rows:
        return cached.select("*", F.row_number().over(Window.orderBy(*order))
                             .cast("long").alias(name))
    return global_row_number(cached, order, name)
