"""Table sources, sinks and physical layout."""

from __future__ import annotations

import tempfile
import uuid
import warnings
from collections.abc import Iterable, Mapping, Sequence
from functools import cache

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from wellspark.sources.schemas import RAW_SCHEMAS, RAW_TABLES

FORMATS = ("parquet", "csv")


@cache
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="wellspark-")


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder path below the one the cluster shares for checkpoints.

    Every run gets its own folder, so a retry never meets half-written files. Only a local
    session, as in tests, may fall back to this machine's temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        base = _local_base()
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def scan(
    spark: SparkSession, directory: str, name: str, schema: T.StructType | None = None
) -> DataFrame:
    """Table ``name`` of a directory holding one parquet file (or folder) per table."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{directory}/{name}.parquet")


def read_if_there(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame | None:
    """The parquet table at ``path``, or None where nothing has been written yet."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def scan_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header and declared types; a row that does not fit fails the read."""
    return spark.read.schema(schema).csv(path, header=True, mode="FAILFAST")


def load_sources(
    spark: SparkSession, directory: str, only: Iterable[str] | None = None
) -> dict[str, DataFrame]:
    """Raw tables by name in load order, also as temp views; a missing one is skipped."""
    wanted = set(RAW_TABLES if only is None else only)
    if unknown := wanted - set(RAW_TABLES):
        raise ValueError(f"unknown raw tables: {sorted(unknown)}")
    tables = {}
    for name in RAW_TABLES:
        if name not in wanted:
            continue
        table = read_if_there(spark, f"{directory}/{name}.parquet", RAW_SCHEMAS[name])
        if table is None:
            warnings.warn(f"skipping {name}: no file in {directory}", stacklevel=2)
            continue
        table.createOrReplaceTempView(name)
        tables[name] = table
    return tables


def write_table(df: DataFrame, name: str, directory: str, formats: Iterable[str]) -> dict[str, str]:
    """Write ``directory/name.<format>`` for each format, replacing what is there."""
    formats = tuple(formats)
    if bad := [f for f in formats if f not in FORMATS]:
        raise ValueError(f"unsupported formats: {bad}")
    paths = {f: f"{directory}/{name}.{f}" for f in formats}
    for f, path in paths.items():
        df.write.mode("overwrite").format(f).option("header", True).save(path)
    return paths


def sample_users(
    df: DataFrame, n: int | None = None, keys: DataFrame | None = None, key: str = "user_id"
) -> DataFrame:
    """Rows of users 1..n, or of the users in ``keys``; a table without the key passes whole."""
    if key not in df.columns:
        return df
    if keys is not None:
        return df.join(keys.select(key), key, "left_semi")
    return df.where(F.col(key).between(1, n))


def jdbc_load(
    df: DataFrame, url: str, table: str, batchsize: int = 50_000, **options: str
) -> None:
    """Idempotent load into a database table.

    The first load creates the table; a later one truncates and refills it instead of
    dropping it, so views on top survive. Rows travel from the executors in batches.
    """
    (
        df.write.format("jdbc")
        .options(url=url, dbtable=table, batchsize=str(batchsize), truncate="true", **options)
        .mode("overwrite")
        .save()
    )


def load_audit(tables: Mapping[str, DataFrame], loaded: Iterable[str] = ()) -> DataFrame:
    """(table_name, n_rows, mode) per table and a TOTAL line; one count job over all tables.

    ``mode`` is ``append`` for tables that were already loaded before, else ``replace``.
    """
    seen = set(loaded)
    counts = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(_mode(name, seen)).alias("mode")
        )
        counts = one if counts is None else counts.unionByName(one)
    return _with_total(counts)


def _mode(name: str, seen: set[str]) -> str:
    return "append" if name in seen else "replace"


def _with_total(counts: DataFrame) -> DataFrame:
    # Grouping sets: the lines and their total from a single pass over the counts.
    return (
        counts.rollup(F.struct("table_name", "mode").alias("line"))
        .agg(F.sum("n_rows").alias("n_rows"))
        .select(
            F.coalesce("line.table_name", F.lit("TOTAL")).alias("table_name"),
            "n_rows",
            F.coalesce("line.mode", F.lit("-")).alias("mode"),
        )
    )


def write_observed(df: DataFrame, path: str, mode: str = "errorifexists") -> int:
    """Write parquet and return the number of rows written, counted by the writing tasks."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n_rows")).write.mode(mode).parquet(path)
    return seen.get["n_rows"]


def load_all(
    spark: SparkSession, tables: Mapping[str, DataFrame], path: str, loaded: Iterable[str] = ()
) -> DataFrame:
    """Write every table to ``path/<name>.parquet``, added to those ``loaded`` before, and return
    the lines of :func:`load_audit` for what was written. Nothing is read again to be counted."""
    seen, lines = set(loaded), []
    for name, df in tables.items():
        mode = _mode(name, seen)
        n = write_observed(df, f"{path}/{name}.parquet", "append" if mode == "append" else "overwrite")
        lines.append((name, n, mode))
    return _with_total(spark.createDataFrame(lines, "table_name string, n_rows bigint, mode string"))


def write_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int) -> None:
    """A catalog table in ``buckets`` files by a hash of the keys, each sorted by them.

    Tables in the same number of buckets of their join or grouping keys are joined and grouped
    without a shuffle. The rows are dealt out by the same hash before they are written, so each
    bucket is one file of one task.
    """
    (
        df.repartition(buckets, *keys)
        .write.mode("overwrite")
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .option("path", path)
        .saveAsTable(table)
    )


def preview(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """First n rows by ``order`` together with the row count of the whole table.

    The n rows come from a distributed top-n, not a global sort; the count is a scalar
    subquery over the same plan.
    """
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return df.orderBy(*order).limit(n).withColumn("total_rows", total)


def write_scores(df: DataFrame, path: str, date: str = "activity_date") -> None:
    """Overwrite parquet in one folder per year of the date."""
    write_partitioned(df.withColumn("year", F.year(date)), path, "year", date)


def write_fact(
    df: DataFrame, path: str, date: str, granularity: str = "day", mode: str = "overwrite"
) -> None:
    """Fact layout: one folder per day or month of ``date``, rows clustered by user.

    Days are the date column itself, so a filter on it skips folders; months get a column
    ``<date>_month``.
    """
    if granularity == "day":
        write_partitioned(df, path, date, "user_id", mode)
    elif granularity == "month":
        part = f"{date}_month"
        write_partitioned(df.withColumn(part, F.trunc(date, "month")), path, part, "user_id", mode)
    else:
        raise ValueError(f"unsupported granularity {granularity!r}")


def write_partitioned(
    df: DataFrame, path: str, part: str, cluster: str, mode: str = "overwrite"
) -> None:
    """Write by ``part`` with few files per folder.

    A rebalance instead of a plain repartition: a folder holding a large share of the rows
    is split over several tasks, small ones share a task.
    """
    (
        df.hint("rebalance", F.col(part))
        .sortWithinPartitions(part, cluster)
        .write.mode(mode)
        .partitionBy(part)
        .parquet(path)
    )
