"""Versioned Parquet datasets whose partitions are replaced atomically.

A dataset has one partition column (``period``, ``bucket``). Every write goes to
folders of its own version, ``version=<id>/<column>=<value>/...``, which no reader
looks at. A manifest, a small JSON file that names the version of each partition,
makes them visible: readers take the manifest with the highest number that is
complete. A job that is killed at any point, before its manifest or while it is
being written, therefore leaves all partitions as they were, and one that replaces
several partitions (or several tables) shows them together or not at all.

Manifests are numbered and created exclusively. A writer that finds its number
taken reads the newer manifest and puts its own partitions on top, so writers of
different partitions never undo each other. A version that the newest two
manifests no longer name is deleted; readers that started before the last write
still find their files.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFESTS = "_manifests"


def _named(manifest: Mapping) -> set[str]:
    """Versions that a manifest's partitions or facts stand on."""
    return set(manifest["versions"].values()) | {str(v) for v in manifest.get("facts", {}).values()}


class ConcurrentWrite(RuntimeError):
    """Other writers took every manifest number that was tried."""


class Snapshots:
    """The dataset at ``root``, partitioned by ``column`` (whole numbers)."""

    def __init__(self, spark: SparkSession, root: str, column: str):
        self.spark, self.root, self.column = spark, root.rstrip("/"), column
        context = spark.sparkContext
        self._path = context._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(context._jsc.hadoopConfiguration())

    # -------------------------------------------------------------- manifests
    def _numbers(self) -> list[int]:
        folder = self._path(f"{self.root}/{MANIFESTS}")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _read(self, number: int) -> dict | None:
        """The manifest, or None where its writer did not finish."""
        stream = self._fs.open(self._path(f"{self.root}/{MANIFESTS}/{number:08d}.json"))
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            found = json.loads(text)
        except ValueError:
            return None
        return found if "versions" in found else None

    def _current(self) -> tuple[int, dict]:
        """(highest number taken, newest complete manifest)."""
        numbers = self._numbers()
        for number in reversed(numbers):
            found = self._read(number)
            if found is not None:
                return numbers[-1], found
        return (numbers[-1] if numbers else 0), {"versions": {}, "before": [], "facts": {}}

    def versions(self) -> dict[int, str]:
        """Version of every partition."""
        return {int(k): v for k, v in self._current()[1]["versions"].items()}

    def facts(self) -> dict:
        """What the last writers noted beside the partitions."""
        return self._current()[1].get("facts", {})

    def _create(self, number: int, manifest: dict) -> bool:
        """Write the manifest; False where the number is taken."""
        try:
            stream = self._fs.create(self._path(f"{self.root}/{MANIFESTS}/{number:08d}.json"), False)
        except Exception as error:  # noqa: BLE001 - only a taken number may pass
            if "AlreadyExists" in str(error):
                return False
            raise
        try:
            stream.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
        finally:
            stream.close()
        return True

    def commit(self, changes: Mapping[int, str | None], *, drop_others: bool = False,
               facts: Mapping | None = None) -> None:
        """Show the given version of each partition (None: it has no rows), and
        none of the partitions not given with ``drop_others``."""
        for _ in range(100):
            taken, now = self._current()
            versions = {} if drop_others else dict(now["versions"])
            for value, version in changes.items():
                versions.pop(str(int(value)), None)
                if version is not None:
                    versions[str(int(value))] = version
            before = sorted(_named(now))
            made = {"versions": versions, "before": before, "facts": {**now.get("facts", {}), **(facts or {})}}
            if self._create(taken + 1, made):
                live = _named(made) | set(before)
                for old in set(now["before"]) - live:
                    self._fs.delete(self._path(f"{self.root}/version={old}"), True)
                return
        raise ConcurrentWrite(f"no free manifest number at {self.root}")

    # ----------------------------------------------------------------- tables
    def write(self, df: DataFrame, table: str = "") -> str:
        """Write ``df`` (with the partition column) as a new version that nobody
        sees yet; returns its id. ``table`` names one of several tables."""
        return self.write_all({table: df})

    def write_all(self, tables: Mapping[str, DataFrame]) -> str:
        version = uuid.uuid4().hex[:16]
        for table, df in tables.items():
            df.write.partitionBy(self.column).parquet(self._folder(version, table))
        return version

    def written(self, version: str, table: str = "") -> list[int]:
        """Partitions that a version has."""
        folder = self._path(self._folder(version, table))
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n.partition("=")[2]) for n in names if n.startswith(f"{self.column}="))

    def _folder(self, version: str, table: str) -> str:
        return f"{self.root}/version={version}" + (f"/table={table}" if table else "")

    def read(self, schema: T.StructType, table: str = "", where: Column | None = None,
             values: Iterable[int] | None = None) -> DataFrame:
        """The current partitions (``values``: only these) with the partition
        column last. Folders of other versions are pruned by the scan."""
        versions = self.versions()
        wanted = versions if values is None else {int(v): versions[int(v)] for v in values if int(v) in versions}
        fields = [T.StructField("version", T.StringType()), *([T.StructField("table", T.StringType())] if table else []),
                  T.StructField(self.column, T.LongType())]
        full = T.StructType([*schema.fields, *fields])
        names = [f.name for f in schema.fields] + [self.column]
        paths = sorted({self._folder(v, table) for v in wanted.values()})
        paths = [p for p in paths if self._fs.exists(self._path(p))]
        if not paths:
            return self.spark.createDataFrame([], full).select(*names)
        rows = self.spark.read.schema(full).option("basePath", self.root).parquet(*paths)
        by_version: dict[str, list[int]] = {}
        for value, version in wanted.items():
            by_version.setdefault(version, []).append(value)
        keep = F.lit(False)
        for version, own in sorted(by_version.items()):
            keep = keep | ((F.col("version") == version) & F.col(self.column).isin(own))
        return (rows if where is None else rows.filter(where)).filter(keep).select(*names)

    def vacuum(self) -> list[str]:
        """Delete the versions that the newest two manifests don't name: what
        killed jobs left behind. Call it while no job writes here."""
        _, now = self._current()
        live = _named(now) | set(now["before"])
        gone = []
        if self._fs.exists(self._path(self.root)):
            for status in self._fs.listStatus(self._path(self.root)):
                name = status.getPath().getName()
                if name.startswith("version=") and name[8:] not in live:
                    self._fs.delete(status.getPath(), True)
                    gone.append(name[8:])
        return sorted(gone)
