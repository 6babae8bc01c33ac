"""Raw tables to checked marts in one run."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspark.operators.expectations import Check, run_checks
from wellspark.operators.loads import publish
from wellspark.plans.marts import build_marts, stage
from wellspark.plans.quality import standing_checks
from wellspark.sources.storage import shared_dir, write_fact

# The date a fact is partitioned by, and how finely.
FACT_LAYOUT = {
    "fct_daily_activity": ("activity_date", "day"),
    "fct_nutrition": ("log_date", "day"),
    "fct_body_scan": ("scan_date", "month"),
}


@dataclass(frozen=True)
class Run:
    """Outcome of a run: the check report, whether the marts were published, and the tables."""

    report: DataFrame
    published: bool
    tables: dict[str, DataFrame]


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write once and read back: later readers start from the files, not from the lineage."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store(name: str, df: DataFrame, path: str) -> DataFrame:
    """Write a table, a fact in its layout, and read its columns back."""
    if name not in FACT_LAYOUT:
        return materialize(df, path)
    write_fact(df, path, *FACT_LAYOUT[name])
    return df.sparkSession.read.parquet(path).select(*df.columns)


def store_all(tables: Mapping[str, DataFrame], out: str) -> dict[str, DataFrame]:
    """Write independent tables side by side, so small ones do not wait for large ones."""
    with ThreadPoolExecutor(max_workers=len(tables)) as pool:
        stored = pool.map(lambda item: store(*item, f"{out}/{item[0]}"), tables.items())
        return dict(zip(tables, stored))


def build(raw: Mapping[str, DataFrame], out: str) -> dict[str, DataFrame]:
    """Write staging models and marts below ``out`` and return them as read from there.

    Staged rows are written before the marts that read them several times, and every check
    then reads the stored tables, so no source is scanned twice.
    """
    staged = store_all(stage(raw), out)
    return {**staged, **store_all(build_marts(staged), out)}


def run(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    out: str | None = None,
    checks: Iterable[Check] | None = None,
    database: str | None = None,
) -> Run:
    """Build candidates, check them, and publish the marts only if every check passes.

    ``out`` is a new folder per run. With ``database`` its views then show the new marts, as
    written and checked; otherwise the caller takes them from ``Run.tables``.
    """
    out = out or shared_dir(spark, "marts")
    tables = build(raw, f"{out}/candidate")
    checks = standing_checks() if checks is None else list(checks)
    report = materialize(run_checks(checks, tables).coalesce(1), f"{out}/report")
    passed = report.where(~F.col("passed")).isEmpty()
    if passed and database is not None:
        for name in (n for n in tables if n.startswith(("dim_", "fct_"))):
            publish(spark, f"{database}.{name}", f"{out}/candidate/{name}")
    return Run(report, passed, tables)
