"""The rolling health score over the full history."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wellspark.operators.joins import enrich
from wellspark.operators.metrics import daily_subscore
from wellspark.operators.windows import rolling_score, rolling_score_days
from wellspark.sources.storage import scan

COLUMNS = ("user_id", "activity_date", "sex", "age", "country", "daily_score")


def rolling_health_score(activity: DataFrame, users: DataFrame, rows: int = 30) -> DataFrame:
    """Daily score, its trailing mean over ``rows`` rows, and the user's attributes."""
    scored = daily_subscore(activity).select("user_id", "activity_date", "daily_score")
    return enrich(rolling_score(scored, rows), users).select(
        *COLUMNS, f"rolling_{rows}d_score", "days_in_window"
    )


def rolling_calendar_score(activity: DataFrame, days: int = 30) -> DataFrame:
    """Daily score and its trailing mean over calendar days."""
    scored = daily_subscore(activity).select("user_id", "activity_date", "daily_score")
    return rolling_score_days(scored, days)


def rolling_interval(activity: DataFrame, start: dt.date, end: dt.date, days: int = 30) -> DataFrame:
    """Calendar rolling scores of the dates start..end only.

    Catalyst cannot push a date filter through the window, so the days the first frames
    need are kept by hand: the scan prunes everything before them.
    """
    date = F.col("activity_date")
    needed = activity.where(date.between(F.date_sub(F.lit(start), days - 1), F.lit(end)))
    return rolling_calendar_score(needed, days).where(date >= F.lit(start))


def rolling_row_interval(
    activity: DataFrame, start: dt.date, end: dt.date, rows: int = 30
) -> DataFrame:
    """Row-frame rolling scores of the dates start..end only, whatever days are missing.

    The first frames need each user's last ``rows - 1`` days before the interval, however
    far back; a rank limit leaves that many rows per user and task before the shuffle.
    """
    date = F.col("activity_date")
    scored = daily_subscore(activity).select("user_id", "activity_date", "daily_score")
    newest_first = Window.partitionBy("user_id").orderBy(date.desc(), F.col("daily_score").desc())
    before = (
        scored.where(date < F.lit(start))
        .withColumn("_rank", F.row_number().over(newest_first))
        .where(F.col("_rank") < rows)
        .drop("_rank")
    )
    needed = scored.where(date.between(F.lit(start), F.lit(end))).unionByName(before)
    return rolling_score(needed, rows).where(date >= F.lit(start))


def compute(spark: SparkSession, directory: str, rows: int = 30) -> DataFrame:
    """The score from the raw tables of a directory."""
    return rolling_health_score(
        scan(spark, directory, "daily_activity"), scan(spark, directory, "dim_user"), rows
    )
