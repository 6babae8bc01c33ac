"""Sorting, unions, spines, long form and table comparison."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspark.functions.scalars import date_key, is_weekend

HOURS = 24
# Copies of a row that are written out from one array.
STEP = 100_000


def sort_spans(history: DataFrame) -> DataFrame:
    """Spans in user and start order (a range-partitioned sort)."""
    return history.orderBy("user_id", "effective_from")


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def table_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows of one build that the other lacks, tagged ``only_in`` before or after.

    Both builds are counted together in a single aggregate over whole rows (map-side sums),
    duplicates included: a row three times in one build and once in the other comes twice.
    Copies are written out in steps: first a row for each ``STEP`` copies, spread over the
    cluster where there are many, then the copies of each step, so no array grows with the data.
    """
    columns = before.columns
    signed = before.withColumn("_sign", F.lit(-1)).unionByName(after.withColumn("_sign", F.lit(1)))
    surplus = signed.groupBy(*columns).agg(F.sum("_sign").alias("_n")).where(F.col("_n") != 0)
    one = F.lit(1).cast("bigint")
    steps = F.ceil(F.abs("_n") / F.lit(STEP))
    # Two arrays, of at most n / STEP / STEP and of STEP elements, number the steps.
    outer = F.explode(F.sequence(one, F.ceil(steps / F.lit(STEP))))
    inner = F.explode(
        F.sequence((F.col("_outer") - 1) * STEP + 1, F.least(F.col("_outer") * STEP, steps))
    )
    stepped = surplus.withColumn("_outer", outer).withColumn("_step", inner)
    left = F.least(F.lit(STEP).cast("bigint"), F.abs("_n") - (F.col("_step") - 1) * STEP)
    return (
        stepped.withColumn("_left", left)
        .hint("rebalance")
        .select(
            F.when(F.col("_n") > 0, "after").otherwise("before").alias("only_in"),
            *columns,
            F.explode(F.sequence(one, F.col("_left"))).alias("_copy"),
        )
        .drop("_copy")
    )


def to_long(df: DataFrame, values: str, index: str = "hour", value: str = "value") -> DataFrame:
    """An array column as one row per element, numbered from 0."""
    rest = [c for c in df.columns if c != values]
    return df.select(*rest, F.posexplode(values).alias(index, value))


def hourly_grid(df: DataFrame, keys: Sequence[str], hour: str, value: str) -> DataFrame:
    """The reverse: 24 hourly values per key as an array, null where an hour is missing."""
    at = [F.max(F.when(F.col(hour) == h, F.col(value))) for h in range(HOURS)]
    return df.groupBy(*keys).agg(F.array(*at).alias("hourly"))


def hr_daily(intraday: DataFrame) -> DataFrame:
    """Lowest, mean and highest heart rate per user and day, and the (first) hour of the peak."""
    rate = F.col("heart_rate")
    return intraday.groupBy("user_id", "activity_date").agg(
        F.count(rate).alias("hours"),
        F.min(rate).alias("min_hr"),
        F.round(F.sum(rate.cast("decimal(20,0)")) / F.count(rate), 2).cast("double").alias("avg_hr"),
        F.max(rate).alias("max_hr"),
        F.max_by("hour", F.struct(rate, -F.col("hour"))).alias("peak_hour"),
    )


def spine(bounds: DataFrame, start: Column, end: Column, keep: Sequence[str] = ()) -> DataFrame:
    """One row per day from start to end inclusive, for each row of ``bounds``."""
    return bounds.select(*keep, F.explode(F.sequence(start, end)).alias("date_day"))


def date_spine(spark: SparkSession, end: dt.date, months: int) -> DataFrame:
    """Days up to and including ``end``; a month counts as 30 days."""
    last = F.lit(end).cast("date")
    return spine(spark.range(1), F.date_sub(last, months * 30 - 1), last)


def date_dimension(days: DataFrame) -> DataFrame:
    """date_key and weekend flag for a column of days."""
    return days.select(
        date_key("date_day").alias("date_key"), "date_day", is_weekend("date_day").alias("is_weekend")
    )


def dim_date(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    return date_dimension(spine(spark.range(1), first, last))
