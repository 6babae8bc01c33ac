"""Tables in versions: each build has a folder of its own, and a log says which one is live.

The log is a small parquet table beside the table's folder, to which every change of version adds
one line as one file. That file's arrival is the switch: a build or a load that breaks off before
it leaves the old version live and readable, and what it has written is never looked at. Lines
also carry what a load must remember (``state``). One writer at a time; readers need no lock, as
live folders are not deleted until ``tidy`` is called.

A table without a log is a plain folder, and live as it is.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspark.sources.storage import read_if_there

LINE = "version bigint, folder string, state string"
PREFIX = "v-"


@dataclass(frozen=True)
class Version:
    """A line of the log; ``folder`` is relative to the table's, "" is that folder itself."""

    version: int
    folder: str
    state: str | None


def _log(path: str) -> str:
    return path.rstrip("/") + "-log"


def live(spark: SparkSession, path: str) -> Version | None:
    """The newest line of the table's log, or None without any."""
    lines = read_if_there(spark, _log(path), LINE)
    if lines is None:
        return None
    newest = lines.agg(F.max(F.struct("version", "folder", "state"))).first()[0]
    return None if newest is None else Version(*newest)


def location(path: str, folder: str) -> str:
    return f"{path.rstrip('/')}/{folder}" if folder else path


def new_folder() -> str:
    """A name that no other version has."""
    return PREFIX + uuid.uuid4().hex


def commit(spark: SparkSession, path: str, folder: str, state: str | None = None) -> Version:
    """Make ``folder`` the live version, by one more line of the log."""
    last = live(spark, path)
    line = Version(last.version + 1 if last else 1, folder, state)
    rows = spark.createDataFrame([(line.version, line.folder, line.state)], LINE)
    rows.coalesce(1).write.mode("append").parquet(_log(path))
    return line


def read(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the live version."""
    now = live(spark, path)
    return spark.read.parquet(location(path, now.folder) if now else path)


def tidy(spark: SparkSession, path: str, keep: Iterable[str]) -> list[str]:
    """Delete the version folders that are not in ``keep``, and return their names.

    For a time when nobody reads an old version or writes a new one.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    kept, gone = set(keep), []
    for entry in files.listStatus(root) if files.exists(root) else []:
        name = entry.getPath().getName()
        if name.startswith(PREFIX) and name not in kept:
            files.delete(entry.getPath(), True)
            gone.append(name)
    return sorted(gone)
