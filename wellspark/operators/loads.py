"""Incremental, partition-replacing and versioned table loads on plain parquet."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspark.operators.aggregates import high_water
from wellspark.sources import versions
from wellspark.sources.storage import read_if_there, shared_dir, write_fact, write_partitioned


def new_rows(src: DataFrame, target: DataFrame, date: str, lookback_days: int = 0) -> DataFrame:
    """Source rows dated after the newest loaded date.

    The high-water mark is a scalar subquery, so the scan receives it as a literal and skips
    files and partitions. With ``lookback_days`` the last loaded days are taken again; load
    the result with :func:`delete_insert` and late rows for those days arrive as well.
    """
    mark = high_water(target, date).scalar()
    return src.where(F.col(date) > F.date_sub(mark, lookback_days))


def _same(columns: Sequence[str]) -> Column:
    """Equality of the columns of ``t`` and ``b``; nulls are equal."""
    return reduce(and_, [F.col(f"t.{c}").eqNullSafe(F.col(f"b.{c}")) for c in columns])


def delete_insert(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target without the rows whose keys are in the batch, plus the batch; a null key is a key."""
    replaced = batch.select(*keys).alias("b")
    return target.alias("t").join(replaced, _same(keys), "left_anti").unionByName(batch)


def apply_delete_insert(
    spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str], part: str
) -> None:
    """Delete+insert on a table partitioned by ``part``, rewriting only touched partitions.

    ``part`` must follow from the keys, so a key never moves between partitions. The new
    partitions are first written to a folder of their own; the target is then replaced
    from there, so nothing is read from the folder being overwritten and the step can be
    repeated from the staged copy.
    """
    stage = shared_dir(spark, "delete-insert")
    batch.write.parquet(f"{stage}/batch")
    batch = spark.read.schema(batch.schema).parquet(f"{stage}/batch")
    stored = spark.read.parquet(path)
    # Rows without a date have a folder, too, which is replaced like any other.
    parts = batch.select(part).distinct().alias("b")
    touched = stored.alias("t").join(parts, _same([part]), "left_semi")
    merged = delete_insert(touched, batch.select(*touched.columns), keys)
    merged.write.parquet(f"{stage}/merged")
    overwrite_partitions(spark.read.schema(merged.schema).parquet(f"{stage}/merged"), path, part)


def overwrite_partitions(batch: DataFrame, path: str, part: str, cluster: str = "user_id") -> None:
    """Replace exactly the partitions that occur in the batch."""
    (
        batch.hint("rebalance", F.col(part))
        .sortWithinPartitions(part, cluster)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(part)
        .parquet(path)
    )


def full_refresh(build: Callable[[], DataFrame], path: str, part: str, cluster: str = "user_id") -> None:
    """Rebuild a table from its source, dropping what was stored.

    The new table is a new version: until it is complete and takes over in one step, readers
    (:func:`wellspark.sources.versions.read`) have the old one, and keep it if the build fails or
    the write breaks off. The build may read the old version.
    """
    built = build()
    folder = versions.new_folder()
    write_partitioned(built, versions.location(path, folder), part, cluster)
    versions.commit(built.sparkSession, path, folder)


def table_load(df: DataFrame, table: str, path: str | None = None) -> None:
    """Replace the rows of a catalog table with those of ``df``; with ``path``, stored below it.

    The rows are written to a new folder first. Pointing the table there is one change of the
    catalog, so a load that breaks off leaves the old rows in place. The columns stay as they
    are: a load with others is refused.
    """
    spark = df.sparkSession
    base = path or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{table.replace('.', '/')}-versions"
    there = spark.catalog.tableExists(table)
    if there:
        held = spark.table(table).schema
        if [(f.name, f.dataType) for f in held] != [(f.name, f.dataType) for f in df.schema]:
            raise ValueError(f"{table} has other columns: {held.simpleString()}")
    folder = versions.location(base, versions.new_folder())
    df.write.parquet(folder)
    if there:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(table)
    else:
        spark.catalog.createTable(table, path=folder, source="parquet", schema=df.schema)


def run_interval(
    src: DataFrame, path: str, date: str, part: str, start: dt.date, end: dt.date
) -> None:
    """Re-run the dates start..end (inclusive): their partitions are replaced, others stay.

    With ``part`` coarser than a day, give whole partitions as interval.
    """
    overwrite_partitions(src.where(F.col(date).between(F.lit(start), F.lit(end))), path, part)


def load_incremental(
    spark: SparkSession,
    src: DataFrame,
    path: str,
    date: str,
    keys: Sequence[str],
    strategy: str = "delete_insert",
    lookback_days: int = 0,
    full: bool = False,
) -> None:
    """One run of an incremental fact stored in a folder per day of ``date``.

    The first run and a ``full`` one build the table from the whole source. Later runs take
    the rows after the newest loaded date, or from ``lookback_days`` before it, and append
    them, replace equal keys (``delete_insert``), or replace their days
    (``insert_overwrite``). The newest date is looked up first, a single value, so that it
    prunes the source scan and the target is not read while being written.

    The date is kept in the table's log of versions and moved on after a run has finished, in one
    step. A run that broke off while folders were being put in place is therefore repeated in
    full, and as every strategy replaces what it finds for its days or keys, the repetition adds
    nothing twice. A ``full`` run builds a new version; the old one stays until that is complete.
    Read the table with :func:`wellspark.sources.versions.read`.
    """
    if strategy not in ("append", "delete_insert", "insert_overwrite"):
        raise ValueError(f"unknown strategy {strategy!r}")
    if strategy == "append" and lookback_days:
        raise ValueError("appending days that are already loaded would duplicate their rows")
    now = versions.live(spark, path)
    mark = None if full else _newest_loaded(spark, path, date, now)
    if mark is None:
        folder = versions.new_folder()
        newest = high_water(src, date).first()["high_water"]
        write_fact(src, versions.location(path, folder), date)
        versions.commit(spark, path, folder, newest.isoformat())
        return
    batch = src.where(F.col(date) > F.lit(mark - dt.timedelta(days=lookback_days)))
    newest = high_water(batch, date).first()["high_water"]
    folder = now.folder if now else ""
    if strategy == "delete_insert":
        apply_delete_insert(spark, versions.location(path, folder), batch, keys, date)
    else:  # days after the newest loaded one are new folders, so appending replaces none
        overwrite_partitions(batch, versions.location(path, folder), date)
    # An empty batch leaves the mark where it is, and the log as it is.
    if now is None or newest > mark:
        versions.commit(spark, path, folder, max(newest, mark).isoformat())


def _newest_loaded(
    spark: SparkSession, path: str, date: str, now: versions.Version | None
) -> dt.date | None:
    """The newest date of the last finished run, of the table if none is recorded, or None."""
    if now is not None and now.state is not None:
        return dt.date.fromisoformat(now.state)
    target = read_if_there(spark, versions.location(path, now.folder if now else ""))
    return None if target is None else high_water(target, date).first()["high_water"]


def publish(spark: SparkSession, view: str, path: str) -> None:
    """Point a view at the parquet table in ``path``: the switch to a new version.

    Readers see the old version until then; no rows are copied.
    """
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM parquet.`{path}`")
