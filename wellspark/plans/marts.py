"""Star-schema marts as lazy plans over the staged tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspark.functions.scalars import date_key
from wellspark.operators import staging
from wellspark.operators.aggregates import nutrition_daily
from wellspark.operators.history import scd2_from_spans
from wellspark.operators.metrics import activity_enriched
from wellspark.operators.reshape import date_dimension, spine
from wellspark.operators.windows import latest_by

STAGING = {
    "stg_users": ("dim_user", staging.stg_users),
    "stg_devices": ("dim_device", staging.stg_devices),
    "stg_user_attr_history": ("user_attr_history", staging.stg_user_attr_history),
    "stg_daily_activity": ("daily_activity", staging.stg_daily_activity),
    "stg_body_scan": ("body_scan", staging.stg_body_scan),
    "stg_nutrition_log": ("nutrition_log", staging.stg_nutrition_log),
    "stg_experiment_assignment": ("experiment_assignment", staging.stg_experiment),
}


def stage(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All staging models whose raw table is present."""
    return {model: cast(raw[table]) for model, (table, cast) in STAGING.items() if table in raw}


def dim_device(devices: DataFrame) -> DataFrame:
    return devices.select("device_id", "brand", "model", "category")


def dim_user(users: DataFrame, history: DataFrame) -> DataFrame:
    """Users with their newest tier and company (Type 1)."""
    newest = latest_by(history, "user_id", "effective_from").withColumnRenamed(
        "effective_from", "tier_effective_from"
    )
    return users.join(newest, "user_id", "left").select(
        *users.columns, "membership_tier", "company", "tier_effective_from"
    )


def dim_user_scd2(history: DataFrame) -> DataFrame:
    return scd2_from_spans(history)


def fct_daily_activity(enriched: DataFrame) -> DataFrame:
    rest = [c for c in enriched.columns if c != "user_id"]
    return enriched.select("user_id", date_key("activity_date").alias("date_key"), *rest)


def fct_body_scan(scans: DataFrame) -> DataFrame:
    rest = [c for c in scans.columns if c not in ("user_id", "scan_date")]
    return scans.select("user_id", date_key("scan_date").alias("date_key"), "scan_date", *rest)


def fct_nutrition(daily: DataFrame, activity: DataFrame) -> DataFrame:
    """Daily intake next to the calories burned; no activity row leaves burn and balance null."""
    burned = activity.select(
        "user_id", F.col("activity_date").alias("log_date"), F.col("calories").alias("calories_burned")
    )
    return daily.join(burned, ["user_id", "log_date"], "left").select(
        "user_id",
        date_key("log_date").alias("date_key"),
        "log_date",
        "meals_logged",
        F.col("total_calories").alias("calories_consumed"),
        "protein_g",
        "carbs_g",
        "fat_g",
        "calories_burned",
        (F.col("total_calories") - F.col("calories_burned")).alias("calorie_balance"),
    )


def dim_date_over(*dated: tuple[DataFrame, str]) -> DataFrame:
    """Date dimension spanning the dates of the given (table, column) pairs."""
    bounds = None
    for df, column in dated:
        one = df.agg(F.min(column).alias("first"), F.max(column).alias("last"))
        bounds = one if bounds is None else bounds.unionByName(one)
    bounds = bounds.agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return date_dimension(spine(bounds, F.col("first"), F.col("last")))


def build_marts(staged: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Every mart, dimensions before facts."""
    activity, scans = staged["stg_daily_activity"], staged["stg_body_scan"]
    meals, history = staged["stg_nutrition_log"], staged["stg_user_attr_history"]
    return {
        "dim_device": dim_device(staged["stg_devices"]),
        "dim_user": dim_user(staged["stg_users"], history),
        "dim_user_scd2": dim_user_scd2(history),
        "dim_date": dim_date_over(
            (activity, "activity_date"), (scans, "scan_date"), (meals, "log_date")
        ),
        "fct_daily_activity": fct_daily_activity(activity_enriched(activity)),
        "fct_body_scan": fct_body_scan(scans),
        "fct_nutrition": fct_nutrition(nutrition_daily(meals), activity),
    }
