"""Typed staging of the raw tables: one function per source, rows one to one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wellspark.sources.schemas import BIGINT, DATE, INT, TEXT, columns


def numeric(precision: int, scale: int = 1) -> T.DecimalType:
    return T.DecimalType(precision, scale)


# Staged column types, in output order. User ids are bigint, not int: a large
# population does not fit an int.
USERS = columns(
    user_id=BIGINT,
    full_name=TEXT,
    sex=TEXT,
    age=INT,
    height_cm=numeric(5),
    country=TEXT,
    primary_device_id=INT,
    signup_date=DATE,
)
DEVICES = columns(device_id=INT, brand=TEXT, model=TEXT, category=TEXT)
ATTR_HISTORY = columns(user_id=BIGINT, membership_tier=TEXT, company=TEXT, effective_from=DATE)
ACTIVITY = columns(
    user_id=BIGINT,
    activity_date=DATE,
    device_id=INT,
    steps=INT,
    active_minutes=INT,
    resting_hr=numeric(5),
    sleep_minutes=INT,
    sleep_deep_minutes=INT,
    sleep_rem_minutes=INT,
    sleep_light_minutes=INT,
    calories=INT,
)
SCANS = columns(
    user_id=BIGINT,
    scan_date=DATE,
    device_id=INT,
    weight_kg=numeric(6),
    bmi=numeric(4),
    body_fat_pct=numeric(4),
    muscle_mass_kg=numeric(5),
    visceral_fat=numeric(4),
)
MEALS = columns(
    user_id=BIGINT,
    log_date=DATE,
    meal_type=TEXT,
    calories=numeric(7),
    protein_g=numeric(6),
    carbs_g=numeric(6),
    fat_g=numeric(6),
)
ASSIGNMENTS = columns(user_id=BIGINT, experiment_name=TEXT, variant=TEXT, engaged_next_day=INT)


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema``, cast to its types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def stg_users(df: DataFrame) -> DataFrame:
    return typed(df, USERS)


def stg_devices(df: DataFrame) -> DataFrame:
    return typed(df, DEVICES)


def stg_user_attr_history(df: DataFrame) -> DataFrame:
    return typed(df, ATTR_HISTORY)


def stg_daily_activity(df: DataFrame) -> DataFrame:
    return typed(df, ACTIVITY)


def stg_body_scan(df: DataFrame) -> DataFrame:
    return typed(df, SCANS)


def stg_nutrition_log(df: DataFrame) -> DataFrame:
    """Meal names in lower case, so that grouping does not depend on their spelling."""
    return typed(df, MEALS).withColumn("meal_type", F.lower("meal_type"))


def stg_experiment(df: DataFrame) -> DataFrame:
    return typed(df, ASSIGNMENTS)
