"""Slowly changing dimensions: versions derived from spans or captured by comparison."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wellspark.functions.scalars import OPEN_END, surrogate_key
from wellspark.operators.windows import neighbour
from wellspark.sources import versions

#: The column that tells opened from closed versions in a stored run.
CHANGE = "change"
#: Runs whose changes are looked through before the open versions are written together.
COMPACT_AFTER = 16


def scd2_from_spans(history: DataFrame) -> DataFrame:
    """Type-2 versions: each span ends the day before the next, the last one is open-ended."""
    open_end = F.lit(OPEN_END).cast("date")
    spans = neighbour(
        history,
        ["user_id"],
        "effective_from",
        "_next",
        ties=["membership_tier", "company"],
    )
    valid_to = F.coalesce(F.date_sub("_next", 1), open_end)
    return spans.select(
        surrogate_key(["user_id", "effective_from"]).alias("user_version_key"),
        "user_id",
        "membership_tier",
        "company",
        F.col("effective_from").alias("valid_from"),
        valid_to.alias("valid_to"),
        (valid_to == open_end).alias("is_current"),
    )


def _paired(
    open_versions: DataFrame,
    current: DataFrame,
    key: str,
    check_cols: Sequence[str],
    run_at: dt.datetime | dt.date,
) -> tuple[DataFrame, Column, Column, Column]:
    """Open versions next to the current rows, whether a row changed, and both its versions.

    One full outer join on a unique key.
    """
    at = F.lit(run_at)
    old = F.struct(*check_cols, "valid_from", "valid_to").alias("old")
    cur = F.struct(F.lit(True).alias("seen"), *check_cols).alias("cur")
    paired = open_versions.select(key, old).join(current.select(key, cur), key, "full_outer")
    same = reduce(
        lambda a, b: a & b, [F.col(f"old.{c}").eqNullSafe(F.col(f"cur.{c}")) for c in check_cols]
    )
    changed = F.col("cur").isNotNull() & (F.col("old").isNull() | ~same)
    kept = F.struct(
        *[F.col(f"old.{c}").alias(c) for c in check_cols],
        F.col("old.valid_from").alias("valid_from"),
        F.when(changed, at).alias("valid_to"),
    )
    opened = F.struct(
        *[F.col(f"cur.{c}").alias(c) for c in check_cols],
        at.alias("valid_from"),
        F.lit(None).cast(_time_type(run_at)).alias("valid_to"),
    )
    return paired, changed, kept, opened


def _time_type(run_at: dt.datetime | dt.date) -> str:
    return "timestamp" if isinstance(run_at, dt.datetime) else "date"


def _nothing_open(current: DataFrame, key: str, check_cols: Sequence[str], run_at) -> DataFrame:
    none = F.lit(None).cast(_time_type(run_at))
    return current.select(key, *check_cols, none.alias("valid_from"), none.alias("valid_to")).limit(0)


def scd2_merge(
    prev: DataFrame | None,
    current: DataFrame,
    key: str,
    check_cols: Sequence[str],
    run_at: dt.datetime | dt.date,
) -> DataFrame:
    """The snapshot after comparing ``current`` (one row per key) with its open versions.

    A changed key closes its version at ``run_at`` and opens another, a new key opens one,
    an unchanged or vanished key keeps its version open. Open versions have a null valid_to.
    Every joined row yields the rows to keep.
    """
    columns = [key, *check_cols, "valid_from", "valid_to"]
    if prev is None:
        prev = _nothing_open(current, key, check_cols, run_at)
    prev = prev.select(*columns)
    still_open = prev.where(F.col("valid_to").isNull())
    paired, changed, kept, opened = _paired(still_open, current, key, check_cols, run_at)
    versions_of = F.array_compact(F.array(F.when(F.col("old").isNotNull(), kept), F.when(changed, opened)))
    merged = paired.select(key, F.explode(versions_of).alias("v")).select(key, "v.*")
    return prev.where(F.col("valid_to").isNotNull()).unionByName(merged)


def scd2_changes(
    open_versions: DataFrame | None,
    current: DataFrame,
    key: str,
    check_cols: Sequence[str],
    run_at: dt.datetime | dt.date,
) -> DataFrame:
    """What a run changes: versions ``closed`` at ``run_at`` and versions ``opened`` by it.

    Unchanged and vanished keys give no row.
    """
    if open_versions is None:
        open_versions = _nothing_open(current, key, check_cols, run_at)
    paired, changed, kept, opened = _paired(open_versions, current, key, check_cols, run_at)
    lines = F.array_compact(
        F.array(
            F.when(F.col("old").isNotNull(), F.struct(F.lit("closed").alias(CHANGE), kept.alias("v"))),
            F.struct(F.lit("opened").alias(CHANGE), opened.alias("v")),
        )
    )
    return (
        paired.where(changed)
        .select(key, F.explode(lines).alias("line"))
        .select(key, "line.v.*", f"line.{CHANGE}")
    )


def apply_snapshot(
    spark: SparkSession,
    path: str,
    current: DataFrame,
    key: str,
    check_cols: Sequence[str],
    run_at: dt.datetime | dt.date,
    compact_after: int = COMPACT_AFTER,
) -> None:
    """One run of a stored snapshot, which writes what has changed and nothing else.

    The snapshot is a log of changes over a base of open versions. A run compares ``current``
    with the versions open before it, writes the closed and opened ones to a folder of its own,
    and counts once the log names that folder; a run that breaks off earlier has not happened. A
    repetition of the last run starts from the run before it. After ``compact_after`` folders of
    changes the open versions are written as a new base; closed ones are written once and
    never again. Runs come in order of time: an earlier one than the last is refused.
    """
    now = versions.live(spark, path)
    state = json.loads(now.state) if now else None
    when = run_at.isoformat()
    if state is not None and when < state["run"]:
        raise ValueError(f"the snapshot already has the run of {state['run']}")
    if state is not None and when == state["run"]:
        state = state["before"]
    held = None if state is None else _open_versions(spark, path, state)
    changes = scd2_changes(held, current, key, check_cols, run_at)
    folder = versions.new_folder()
    written = _write_changes(changes, path, folder)
    after = {"base": [], "opened": [], "closed": [], "settled": [], **(state or {})}
    # What the run before this one left is enough to repeat this one.
    after["before"] = None if state is None else {**state, "before": None}
    after |= {"run": when, "key": key, "schema": changes.drop(CHANGE).schema.json()}
    for change in ("opened", "closed"):
        if change in written:
            after[change] = [*after[change], f"{folder}/{CHANGE}={change}"]
    if max(len(after["opened"]), len(after["closed"])) > compact_after:
        base = versions.new_folder()
        whole = _open_versions(spark, path, after).withColumn(CHANGE, F.lit("opened"))
        written = _write_changes(whole, path, base)
        after["settled"] = after["settled"] + after["closed"]
        after |= {"base": [f"{base}/{CHANGE}=opened"] if written else [], "opened": [], "closed": []}
    versions.commit(spark, path, folder, json.dumps(after))


def _write_changes(changes: DataFrame, path: str, folder: str) -> set[str]:
    """Write versions by kind of change, and return the kinds that there are."""
    where = versions.location(path, folder)
    changes.write.partitionBy(CHANGE).parquet(where)
    stored = changes.sparkSession.read.schema(changes.schema).parquet(where)
    return {r[0] for r in stored.select(CHANGE).distinct().collect()}


def snapshot(spark: SparkSession, path: str) -> DataFrame:
    """All versions of a stored snapshot as of its last finished run."""
    now = versions.live(spark, path)
    if now is None:
        raise ValueError(f"no finished run in {path}")
    state = json.loads(now.state)
    closed = _lines(spark, path, state, [*state["settled"], *state["closed"]])
    return closed.unionByName(_open_versions(spark, path, state))


def tidy_snapshot(spark: SparkSession, path: str) -> list[str]:
    """Delete folders of runs that broke off or were repeated, and of bases made anew."""
    now = versions.live(spark, path)
    state = json.loads(now.state) if now else None
    kept = {
        folder.split("/")[0]
        for known in (state, state and state["before"])
        if known
        for part in ("base", "opened", "closed", "settled")
        for folder in known[part]
    }
    return versions.tidy(spark, path, kept)


def _lines(spark: SparkSession, path: str, state: dict, folders: Sequence[str]) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(state["schema"]))
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[versions.location(path, f) for f in folders])


def _open_versions(spark: SparkSession, path: str, state: dict) -> DataFrame:
    """Versions in the base or opened since, and not closed again."""
    opened = _lines(spark, path, state, [*state["base"], *state["opened"]])
    if not state["closed"]:
        return opened
    closed = _lines(spark, path, state, state["closed"]).select(state["key"], "valid_from")
    return opened.join(closed, [state["key"], "valid_from"], "left_anti")
