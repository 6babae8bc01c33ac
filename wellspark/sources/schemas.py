"""Declared schemas and load order of the raw tables; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

BIGINT, INT, DOUBLE = T.LongType(), T.IntegerType(), T.DoubleType()
TEXT, DATE, BOOLEAN = T.StringType(), T.DateType(), T.BooleanType()


def columns(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


# Raw tables in load order: dimensions come before the facts that refer to them.
RAW_SCHEMAS: dict[str, T.StructType] = {
    "dim_device": columns(device_id=BIGINT, brand=TEXT, model=TEXT, category=TEXT),
    "dim_user": columns(
        user_id=BIGINT,
        full_name=TEXT,
        sex=TEXT,
        age=BIGINT,
        height_cm=DOUBLE,
        country=TEXT,
        primary_device_id=BIGINT,
        signup_date=DATE,
    ),
    "user_attr_history": columns(
        user_id=BIGINT, membership_tier=TEXT, company=TEXT, effective_from=DATE
    ),
    "daily_activity": columns(
        user_id=BIGINT,
        activity_date=DATE,
        device_id=BIGINT,
        steps=BIGINT,
        active_minutes=BIGINT,
        resting_hr=DOUBLE,
        sleep_minutes=BIGINT,
        sleep_deep_minutes=BIGINT,
        sleep_rem_minutes=BIGINT,
        sleep_light_minutes=BIGINT,
        calories=BIGINT,
    ),
    "intraday_hr": columns(user_id=BIGINT, activity_date=DATE, hour=BIGINT, heart_rate=BIGINT),
    "body_scan": columns(
        user_id=BIGINT,
        scan_date=DATE,
        device_id=BIGINT,
        weight_kg=DOUBLE,
        bmi=DOUBLE,
        body_fat_pct=DOUBLE,
        muscle_mass_kg=DOUBLE,
        visceral_fat=DOUBLE,
    ),
    "nutrition_log": columns(
        user_id=BIGINT,
        log_date=DATE,
        meal_type=TEXT,
        calories=DOUBLE,
        protein_g=DOUBLE,
        carbs_g=DOUBLE,
        fat_g=DOUBLE,
    ),
    "experiment_assignment": columns(
        user_id=BIGINT, experiment_name=TEXT, variant=TEXT, engaged_next_day=BIGINT
    ),
}

RAW_TABLES = tuple(RAW_SCHEMAS)

DATE_SEED = columns(date_key=INT, date_day=DATE, is_weekend=BOOLEAN)

# One wearable reading as published on the stream.
EVENT = columns(
    event_id=BIGINT, user_id=BIGINT, ts=DOUBLE, heart_rate=INT, steps_delta=INT, device=TEXT
)

# A record as a message source hands it over.
RECORD = columns(key=TEXT, value=TEXT, partition=INT, offset=BIGINT)
