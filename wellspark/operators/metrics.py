"""Derived daily, body and nutrition measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspark.functions.scalars import clip, safe_ratio, step_goal, subscore
from wellspark.operators.joins import as_of_join


def _dec(text: str) -> Column:
    return F.lit(text).cast("decimal(8,4)")


def daily_subscore(df: DataFrame, null_policy: str = "credit") -> DataFrame:
    """Add ``daily_score``; see :func:`wellspark.functions.scalars.subscore`."""
    return df.withColumn("daily_score", subscore(null_policy))


def activity_enriched(df: DataFrame) -> DataFrame:
    """Staged activity plus the share of deep and REM sleep and the step goal flag."""
    restorative = F.col("sleep_deep_minutes") + F.col("sleep_rem_minutes")
    return df.select(
        "user_id",
        "activity_date",
        "device_id",
        "steps",
        "active_minutes",
        "resting_hr",
        "calories",
        "sleep_minutes",
        "sleep_deep_minutes",
        "sleep_rem_minutes",
        "sleep_light_minutes",
        safe_ratio(restorative, "sleep_minutes", 3).alias("restorative_sleep_ratio"),
        step_goal("steps").alias("hit_step_goal"),
    )


def body_metrics(scans: DataFrame, users: DataFrame) -> DataFrame:
    """Scans with bmi from height, fat mass and fat-free mass in kg."""
    weight = F.col("weight_kg")
    fat = F.round(weight * F.col("body_fat_pct") / 100, 2)
    return scans.join(users.select("user_id", "height_cm"), "user_id", "left").select(
        "user_id",
        "scan_date",
        "weight_kg",
        "height_cm",
        F.round(weight * 10000 / (F.col("height_cm") * F.col("height_cm")), 1).alias("bmi"),
        fat.alias("fat_mass_kg"),
        (weight - fat).alias("fat_free_mass_kg"),
    )


def expected_burn(activity: DataFrame, users: DataFrame, scans: DataFrame) -> DataFrame:
    """Expected kcal per user and day from basal rate, steps and active minutes.

    Weight is the latest scan on or before the day; days before the first scan have none.
    """
    weighed = as_of_join(
        activity.select("user_id", "activity_date", "steps", "active_minutes"),
        scans.select("user_id", "scan_date", "weight_kg"),
        "activity_date",
        start="scan_date",
        end=None,
    )
    # Mifflin-St Jeor coefficients, kcal per step and per active minute.
    basal = (
        _dec("10") * F.col("weight_kg")
        + _dec("6.25") * F.col("height_cm")
        - F.col("age") * 5
        + F.when(F.col("sex") == "M", 5).otherwise(-161)
    )
    active = F.col("steps") * _dec("0.04") + F.col("active_minutes") * 4
    return weighed.join(
        users.select("user_id", "sex", "age", "height_cm"), "user_id", "left"
    ).select(
        "user_id",
        "activity_date",
        "weight_kg",
        F.round(basal, 2).alias("bmr_kcal"),
        F.round(basal + active, 2).alias("expected_kcal"),
    )


def body_fat_estimate(df: DataFrame) -> DataFrame:
    """Add ``body_fat_estimate`` in percent from bmi, age and sex, within 5..55."""
    # Deurenberg-style coefficients.
    estimate = (
        _dec("1.20") * F.col("bmi")
        + _dec("0.23") * F.col("age")
        - F.when(F.col("sex") == "M", _dec("10.8")).otherwise(_dec("0"))
        - _dec("5.4")
    )
    return df.withColumn("body_fat_estimate", clip(F.round(estimate, 1), 5, 55))


def macro_shares(daily: DataFrame) -> DataFrame:
    """kcal from protein, carbs (4 per g) and fat (9 per g), and their shares of the sum."""
    kcal = {"protein": F.col("protein_g") * 4, "carbs": F.col("carbs_g") * 4, "fat": F.col("fat_g") * 9}
    total = kcal["protein"] + kcal["carbs"] + kcal["fat"]
    with_kcal = daily.select(
        "user_id", "log_date", *[c.alias(f"{n}_kcal") for n, c in kcal.items()], total.alias("macro_kcal")
    )
    return with_kcal.select(
        "*",
        *[
            F.round(
                F.col(f"{n}_kcal").cast("decimal(18,1)")
                / F.nullif("macro_kcal", F.lit(0)).cast("decimal(18,1)"),
                4,
            ).alias(f"{n}_share")
            for n in kcal
        ],
    )
