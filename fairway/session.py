"""Session helpers: the only Spark settings the library relies on."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Settings the metrics depend on: ANSI arithmetic is handled explicitly by
# ``functions.numeric``; wall-clock timestamps must not shift between
# sessions, so the zone is pinned.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def get_spark(master: str | None = None, app_name: str = "fairway",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build or fetch a session with the settings the library expects.

    On a cluster, ``master`` stays ``None`` and the submit settings win;
    tests pass ``local[*]`` and a small shuffle partition count.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false")
    for key, value in REQUIRED_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session. Where it is unset, a
    scratch folder is made for a ``local`` master only (tests): on a cluster
    each machine would write to its own disk, so that is refused.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="fairway-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never machine-local
    on a cluster, since the checkpoint folder is shared storage)."""
    base = ensure_checkpoint_dir(spark)
    import uuid

    return os.path.join(base, "fairway-scratch", f"{name}-{uuid.uuid4().hex[:12]}")


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of every executor: the
    driver's copy is sent once for each Spark application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(), "fairway_package.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, files in os.walk(package):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


_shipped: set[str] = set()
