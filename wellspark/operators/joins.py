"""Joins between facts and dimensions.

No broadcast hints on user-sized tables: Catalyst broadcasts a side whose estimated or, with
AQE, measured size is below spark.sql.autoBroadcastJoinThreshold and shuffles both sides
beyond it, where AQE splits skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wellspark.operators.windows import STRETCH, stretch_of

FOREVER = 2**62


def enrich(scored: DataFrame, users: DataFrame) -> DataFrame:
    """Daily rows with sex, age and country of their user; unknown users keep nulls."""
    return scored.join(users.select("user_id", "sex", "age", "country"), "user_id", "left")


def stamp_device(activity: DataFrame, users: DataFrame) -> DataFrame:
    """Daily rows with their user's primary device as device_id."""
    devices = users.select("user_id", F.col("primary_device_id").alias("device_id"))
    return activity.drop("device_id").join(devices, "user_id", "left")


def _day(date: str) -> Column:
    return F.unix_date(F.to_date(date)).cast("bigint")


def as_of_join(
    fact: DataFrame,
    dim: DataFrame,
    date: str,
    key: str = "user_id",
    start: str = "valid_from",
    end: str | None = "valid_to",
    width: int | None = None,
) -> DataFrame:
    """Fact rows with the dimension version in force on their date; none gives nulls.

    A sorted merge: facts and versions are put into one table, and in the order of their days
    every fact takes the last version before it. Each side is read and shuffled once, a version
    is one row however long it lasts, and a fact stays one row. Of versions that start
    together the last in the order of the other columns holds; without ``end`` a version lasts
    until the next. Versions of a key should not overlap: of two the later start decides.

    Without ``width`` the facts of a key are of daily grain. Where a key may have any number of
    facts, ``width`` cuts time into stretches of that many days, sorted apart from each other; a
    stretch is told the version it begins with. Facts then travel whole, so select before the
    join what is needed after it.
    """
    payload = [c for c in dim.columns if c != key]
    until = F.lit(FOREVER) if end is None else F.coalesce(_day(end), F.lit(FOREVER))
    version = F.struct(until.alias("until"), F.struct(*payload).alias("columns"))
    whole = fact.select(F.struct(*fact.columns).alias("whole")).schema["whole"].dataType
    versions = dim.dropna(subset=[key, start]).select(
        F.col(key).alias("_key"),
        _day(start).alias("_at"),
        F.lit(None).cast(whole).alias("_fact"),
        version.alias("_version"),
    )
    versions = versions.where(F.col("_at") <= F.col("_version.until"))
    facts = fact.select(
        F.col(key).alias("_key"),
        _day(date).alias("_at"),
        F.struct(*fact.columns).alias("_fact"),
        F.lit(None).cast(versions.schema["_version"].dataType).alias("_version"),
    )
    merged = facts.unionByName(versions)
    parts = ["_key"] if width is None else ["_key", STRETCH]
    if width is not None:
        merged = _dealt_by_stretch(merged, width)
    # Versions before the facts of their day, in the order of their own columns.
    order = Window.partitionBy(*parts).orderBy("_at", F.col("_fact").isNotNull(), "_version")
    newest = F.last("_version", ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    asked = merged.withColumn("_held", newest).where(F.col("_fact").isNotNull())
    held = F.col("_held")
    if width is not None:
        # The last version of each stretch, carried to the stretches after it.
        last = F.max(F.when(F.col("_fact").isNull(), F.struct("_at", "_version"))).alias("_last")
        earlier = Window.partitionBy("_key").orderBy(STRETCH)
        earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
        # Its keys are maxima of the group's keys: that the join needs them not null must not
        # become a filter below the shuffle, which would then no longer be the same one.
        ends = merged.groupBy(*parts).agg(last, F.max("_key").alias("_k"), F.max(STRETCH).alias("_s"))
        carried = ends.select(
            "_k", "_s", F.last("_last", ignorenulls=True).over(earlier).alias("_before")
        ).where(F.col("_before").isNotNull())
        same = (F.col("_key") == F.col("_k")) & (F.col(STRETCH) == F.col("_s"))
        asked = asked.join(carried, same, "left")
        held = F.coalesce("_held", "_before._version")
    in_force = F.when(held["until"] >= F.col("_at"), held["columns"])
    return asked.select("_fact", in_force.alias("_in_force")).select(
        *[F.col("_fact").getField(c).alias(c) for c in fact.columns],
        *[F.col("_in_force").getField(c).alias(c) for c in payload],
    )


def _dealt_by_stretch(merged: DataFrame, width: int) -> DataFrame:
    """The rows dealt out by key and stretch, once for all that reads them.

    A row is an element of an array from before the shuffle to after it, so every reader asks
    the shuffle for the same columns and Spark runs it a single time.
    """
    packed = merged.select(
        "_key", stretch_of(F.col("_at"), width).alias(STRETCH), F.array(F.struct("_at", "_fact", "_version")).alias("_row")
    )
    dealt = packed.repartition("_key", STRETCH).select("_key", STRETCH, F.element_at("_row", 1).alias("_r"))
    return dealt.select("_key", STRETCH, "_r.*")


def star(fact: DataFrame, dates: DataFrame, users: DataFrame) -> DataFrame:
    """Fact rows with the attributes of their date and user."""
    return fact.join(dates, "date_key", "left").join(users, "user_id", "left")
