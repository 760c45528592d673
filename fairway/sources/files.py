"""Files as rows: listings without contents, and opening one inside a task."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    """``path``, ``size`` and ``at`` (modification time) of the files below ``root``;
    names beginning with ``_`` or ``.`` are left out, contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    reader = reader.option("pathGlobFilter", pattern) if pattern else reader
    return reader.load(root).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("at"))


def open_input(path: str):
    """The file at ``path`` (as Spark names it) for random reads."""
    from urllib.parse import quote

    import pyarrow.fs as pafs

    if path.startswith(("file:", "/")):
        return pafs.LocalFileSystem().open_input_file("/" + path.removeprefix("file:").lstrip("/"))
    fs, place = pafs.FileSystem.from_uri(quote(path, safe=":/@=+,"))
    return fs.open_input_file(place)
