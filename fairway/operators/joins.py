"""Joins against small dimension tables, with a checked size before any
broadcast, and lineage cuts through the shared checkpoint folder."""

from __future__ import annotations

import atexit
import contextlib
import contextvars
import uuid
from collections.abc import Iterator, Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairway.session import ensure_checkpoint_dir



class RunScope:
    """What one run keeps: cached frames and written tables. ``release`` frees
    exactly these, so runs side by side never touch each other's."""

    def __init__(self) -> None:
        self.frames: list[DataFrame] = []
        self.paths: list[tuple[object, str]] = []

    def keep(self, df: DataFrame) -> DataFrame:
        self.frames.append(df)
        return df

    def release(self) -> None:
        while self.frames:
            self.frames.pop().unpersist()
        while self.paths:
            spark, path = self.paths.pop()
            with contextlib.suppress(Exception):  # the session may have ended
                folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
                folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


# Frames and tables of calls outside any run; released when the process ends.
_DEFAULT = RunScope()
atexit.register(_DEFAULT.release)
_scope: contextvars.ContextVar[RunScope] = contextvars.ContextVar("run_scope", default=_DEFAULT)


def current_scope() -> RunScope:
    return _scope.get()


@contextlib.contextmanager
def run_scope() -> Iterator[RunScope]:
    """Everything cached or written inside belongs to this run and is
    released at its end: consume the results inside the block."""
    scope = RunScope()
    token = _scope.set(scope)
    try:
        yield scope
    finally:
        _scope.reset(token)
        scope.release()


# Rows / estimated bytes above which a "small" side is joined by shuffle
# instead of broadcast. Settable per session with spark.fairway.broadcastMaxRows
# and spark.fairway.broadcastMaxBytes.
DEFAULT_BROADCAST_MAX_ROWS = 1_000_000
DEFAULT_BROADCAST_MAX_BYTES = 256 << 20
# Per-value size assumed for variable-width columns in the byte estimate.
VARIABLE_WIDTH_BYTES = 64


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as a Parquet table under the shared checkpoint folder and
    read it back: one job, lineage cut (a lost executor never recomputes
    it), and later scans read only the columns they need."""
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/fairway-tables/{name}-{uuid.uuid4().hex[:12]}"
    df.write.mode("overwrite").parquet(path)
    current_scope().paths.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def broadcast_limit(df: DataFrame) -> int:
    value = df.sparkSession.conf.get("spark.fairway.broadcastMaxRows", None)
    return int(value) if value else DEFAULT_BROADCAST_MAX_ROWS


def broadcast_byte_limit(df: DataFrame) -> int:
    value = df.sparkSession.conf.get("spark.fairway.broadcastMaxBytes", None)
    return int(value) if value else DEFAULT_BROADCAST_MAX_BYTES


def estimated_row_bytes(df: DataFrame) -> int:
    """Row width from the schema: fixed-width types by size, strings and
    nested values at ``VARIABLE_WIDTH_BYTES``."""
    from pyspark.sql import types as T

    fixed = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4,
             T.DateType: 4, T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8,
             T.TimestampNTZType: 8}
    return 16 + sum(fixed.get(type(f.dataType), VARIABLE_WIDTH_BYTES) for f in df.schema.fields)


def fits_broadcast(df: DataFrame, rows: int) -> bool:
    """Whether ``rows`` rows of ``df`` are within both broadcast limits."""
    return rows <= broadcast_limit(df) and rows * estimated_row_bytes(df) <= \
        broadcast_byte_limit(df)


def join_keys(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner",
              *, broadcast_right: bool = False, null_safe: bool = False) -> DataFrame:
    """Equi-join on ``on``. ``null_safe``: a NULL key is a group of its own,
    for a right side that restores a grouping of ``left``; otherwise a NULL
    key matches nothing. Right-side keys are renamed first so a right side
    derived from ``left`` never makes the references ambiguous."""
    keys = set(on)
    renamed = right.select([F.col(c).alias(f"__r_{c}") if c in keys else F.col(c)
                            for c in right.columns])
    if broadcast_right:
        renamed = F.broadcast(renamed)
    cond = reduce(lambda a, b: a & b,
                  [F.col(k).eqNullSafe(F.col(f"__r_{k}")) if null_safe
                   else F.col(k) == F.col(f"__r_{k}") for k in on])
    joined = left.join(renamed, cond, how)
    return joined.drop(*[f"__r_{k}" for k in on])


def join_small(big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner",
               max_rows: int | None = None, *, null_safe: bool = False) -> DataFrame:
    """Join ``big`` to a dimension that is expected to be small.

    The small side (an aggregate of the big data, deterministic) is cached
    and counted once, and broadcast only when its row count and estimated
    size are within the limits; otherwise the join is a shuffle join, where
    AQE still splits hot keys of the big side.
    """
    limit = max_rows if max_rows is not None else broadcast_limit(big)
    small = current_scope().keep(small.persist(StorageLevel.MEMORY_AND_DISK))
    rows = small.count()
    fits = rows <= limit and fits_broadcast(small, rows)
    return join_keys(big, small, on, how, broadcast_right=fits, null_safe=null_safe)
