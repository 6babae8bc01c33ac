"""Scalar expressions shared by staging, marts and scores. All are built-in, JVM-side."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
OPEN_END = dt.date(9999, 12, 31)
EPOCH_START = dt.date(1900, 1, 1)
KEY_NULL_MARKER = "_dbt_utils_surrogate_key_null_"
STEP_GOAL = 10000


def as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def date_key(date: Column | str) -> Column:
    """Date as an integer yyyymmdd."""
    date = as_col(date)
    return (F.year(date) * 10000 + F.month(date) * 100 + F.day(date)).cast("int")


def safe_ratio(num: Column | str, den: Column | str, scale: int) -> Column:
    """num / den as a decimal rounded half up; null when den is 0 or either is null."""
    wide = as_col(num).cast("decimal(18,6)")
    return F.round(wide / F.nullif(as_col(den), F.lit(0)).cast("decimal(18,0)"), scale)


def step_goal(steps: Column | str, goal: int = STEP_GOAL) -> Column:
    """True at or above the goal; an unknown step count does not meet it."""
    return F.coalesce(as_col(steps) >= goal, F.lit(False))


def is_weekend(date: Column | str) -> Column:
    return F.weekday(as_col(date)) >= 5


def clip(value: Column | str, low: float, high: float) -> Column:
    """Bound to [low, high]; null stays null (greatest/least alone would drop it)."""
    value = as_col(value)
    return F.when(value.isNotNull(), F.greatest(F.least(value, F.lit(high)), F.lit(low)))


def surrogate_key(columns: Sequence[Column | str]) -> Column:
    """md5 over the text of the columns joined by '-', nulls shown by a marker."""
    parts = [F.coalesce(as_col(c).cast("string"), F.lit(KEY_NULL_MARKER)) for c in columns]
    return F.md5(F.concat_ws("-", *parts))


def hash_bucket(salt: str, key: Column | str, buckets: int) -> Column:
    """Bucket 0..buckets-1 from md5 of 'salt:key': the same on any engine and any cluster."""
    text = F.concat(F.lit(salt + ":"), as_col(key).cast("string"))
    prefix = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return (prefix % buckets).cast("int")


def exact_mean(total: Column, count: Column, scale: int) -> Column:
    """Decimal total / count rounded half up, as double; null for an empty count.

    Works on exact decimal totals, so the result does not depend on the order in which
    tasks added the values. The quotient keeps some 20 decimals, enough not to round twice.
    """
    ratio = total.cast("decimal(24,6)") / F.nullif(count, F.lit(0)).cast("decimal(15,0)")
    return F.round(ratio, scale).cast("double")


def stable_round(value: Column | str, scale: int, digits: int = 6) -> Column:
    """Round a computed double through a decimal, so float noise cannot decide a tie."""
    return F.round(as_col(value).cast(f"decimal(28,{digits})"), scale).cast("double")


def subscore(null_policy: str = "credit") -> Column:
    """0-100 daily score from steps, sleep_minutes and resting_hr, rounded to 2 decimals.

    Steps count up to a full day's goal and have no lower bound; sleep counts by its
    closeness to the ideal; the resting heart rate between its worst and best value. With
    ``credit`` a null steps or heart rate counts as full marks and a null sleep as none,
    because least and greatest skip nulls; with ``propagate`` any null makes the score null.
    """
    # Weights 0.4, 0.3, 0.3; 10000 steps; 450 minutes; 90 to 55 beats.
    if null_policy not in ("credit", "propagate"):
        raise ValueError(f"unknown null policy {null_policy!r}")
    steps, sleep, heart = (F.col(c).cast("double") for c in ("steps", "sleep_minutes", "resting_hr"))
    zero, one = F.lit(0.0), F.lit(1.0)
    step_mark = F.least(steps / 10000.0, one)
    sleep_mark = F.greatest(1.0 - F.abs(sleep - 450.0) / 450.0, zero)
    heart_mark = F.greatest(F.least((90.0 - heart) / 35.0, one), zero)
    score = F.round((step_mark * 0.4 + sleep_mark * 0.3 + heart_mark * 0.3) * 100.0, 2)
    if null_policy == "propagate":
        return F.when(steps.isNotNull() & sleep.isNotNull() & heart.isNotNull(), score)
    return score
