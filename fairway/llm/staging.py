"""Written intermediate tables in the shared folder the cluster names.

A staged table cuts the lineage: a lost executor costs at most the tasks of
the job that was running, never a recomputation of the steps before.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairway.operators.joins import RunScope, current_scope, estimated_row_bytes
from fairway.session import ensure_checkpoint_dir, ship_package


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder name under ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str, scope: RunScope | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back. The
    table belongs to ``scope`` (by default the run it is called in), whose end
    deletes it; tables of calls outside a run go when the process ends."""
    path = shared_folder(df.sparkSession, name)
    (scope or current_scope()).paths.append((df.sparkSession, path))
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20


def small(df: DataFrame) -> DataFrame:
    """``df`` (a staged table of a few narrow columns) marked for a broadcast
    when it has at most ``BROADCAST_ROWS`` rows and, by its columns' types, about
    ``BROADCAST_BYTES``; else it is joined by shuffle."""
    rows = df.count()
    fits = rows <= BROADCAST_ROWS and rows * estimated_row_bytes(df) <= BROADCAST_BYTES
    return F.broadcast(df) if fits else df


def keyed(docs: DataFrame, id_col: str, key: str) -> DataFrame:
    """``docs`` with a key of each row in column ``key``: the id itself or, where
    ids repeat or are missing, the place in the order of id (nulls last) and
    content."""
    ids = docs.select(F.col(id_col).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    if not ids.where("n > 1 OR id IS NULL").limit(1).count():
        return docs.withColumn(key, F.col(id_col))
    ordered = docs.orderBy(F.col(id_col).asc_nulls_last(), F.xxhash64(*docs.columns), F.md5(F.to_json(F.struct(*docs.columns))))
    return stage(ordered.withColumn(key, F.monotonically_increasing_id()), "keyed")


def parts(spark: SparkSession) -> int:
    """Partitions of the packed shuffles: the session's shuffle partitions."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


# Rows of an Arrow batch sent to Python at most: rows carry whole texts, and a
# batch is held on both sides, outside the executor's heap.
BATCH_ROWS = 1000


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of every executor, and
    keep the session's Arrow batches within ``BATCH_ROWS`` rows."""
    ship_package(spark)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)
