"""The standing checks on staging models and marts."""

from __future__ import annotations

from wellspark.operators import expectations as x
from wellspark.operators.expectations import Check

# Accepted values and ranges.
TIERS = ["free", "plus", "pro"]
MEALS = ["breakfast", "lunch", "dinner", "snack"]
STEPS, HEART_RATE, BODY_FAT, WEIGHT, MEAL_COUNT = (0, 60000), (25, 120), (3, 60), (30, 250), (1, 10)


def not_null(table: str, column: str) -> Check:
    return Check(f"not_null_{table}_{column}", table, lambda: x.is_missing(column))


def unique(table: str, column: str) -> Check:
    return Check(f"unique_{table}_{column}", table, unique=(column,))


def unique_combination(table: str, *columns: str) -> Check:
    name = f"unique_combination_{table}_{'_'.join(columns)}"
    return Check(name, table, unique=columns, nulls=True)


def accepted(table: str, column: str, values: list) -> Check:
    return Check(f"accepted_values_{table}_{column}", table, lambda: x.not_accepted(column, values))


def between(table: str, column: str, bounds: tuple[float, float]) -> Check:
    return Check(f"accepted_range_{table}_{column}", table, lambda: x.out_of_range(column, *bounds))


def positive(table: str, column: str) -> Check:
    return Check(f"positive_{table}_{column}", table, lambda: x.not_positive(column))


def related(table: str, column: str, parent: str, parent_column: str) -> Check:
    name = f"relationships_{table}_{column}_{parent}"
    return Check(name, table, parent=(column, parent, parent_column))


def key(table: str, column: str) -> list[Check]:
    return [unique(table, column), not_null(table, column)]


def user_of(table: str, parent: str) -> list[Check]:
    return [not_null(table, "user_id"), related(table, "user_id", parent, "user_id")]


def standing_checks() -> list[Check]:
    """The 67 checks on staging models, marts, the date dimension, and across columns."""
    users, marts_user = "stg_users", "dim_user"
    return [
        *key("stg_users", "user_id"),
        accepted("stg_users", "sex", ["M", "F"]),
        not_null("stg_users", "primary_device_id"),
        related("stg_users", "primary_device_id", "stg_devices", "device_id"),
        *key("stg_devices", "device_id"),
        accepted("stg_devices", "category", ["wearable", "scale"]),
        *user_of("stg_user_attr_history", users),
        accepted("stg_user_attr_history", "membership_tier", TIERS),
        not_null("stg_user_attr_history", "effective_from"),
        *user_of("stg_daily_activity", users),
        not_null("stg_daily_activity", "activity_date"),
        between("stg_daily_activity", "steps", STEPS),
        between("stg_daily_activity", "resting_hr", HEART_RATE),
        unique_combination("stg_daily_activity", "user_id", "activity_date"),
        *user_of("stg_body_scan", users),
        between("stg_body_scan", "body_fat_pct", BODY_FAT),
        between("stg_body_scan", "weight_kg", WEIGHT),
        *user_of("stg_nutrition_log", users),
        accepted("stg_nutrition_log", "meal_type", MEALS),
        *key("stg_experiment_assignment", "user_id"),
        accepted("stg_experiment_assignment", "variant", ["A", "B"]),
        accepted("stg_experiment_assignment", "engaged_next_day", [0, 1]),
        *key("dim_user", "user_id"),
        accepted("dim_user", "membership_tier", TIERS),
        related("dim_user", "primary_device_id", "dim_device", "device_id"),
        *key("dim_device", "device_id"),
        *key("dim_user_scd2", "user_version_key"),
        *user_of("dim_user_scd2", marts_user),
        accepted("dim_user_scd2", "membership_tier", TIERS),
        not_null("dim_user_scd2", "is_current"),
        unique_combination("dim_user_scd2", "user_id", "valid_from"),
        *user_of("fct_daily_activity", marts_user),
        not_null("fct_daily_activity", "date_key"),
        related("fct_daily_activity", "date_key", "dim_date", "date_key"),
        between("fct_daily_activity", "restorative_sleep_ratio", (0, 1)),
        not_null("fct_daily_activity", "hit_step_goal"),
        unique_combination("fct_daily_activity", "user_id", "date_key"),
        positive("fct_daily_activity", "calories"),
        *user_of("fct_body_scan", marts_user),
        related("fct_body_scan", "date_key", "dim_date", "date_key"),
        positive("fct_body_scan", "weight_kg"),
        between("fct_body_scan", "weight_kg", WEIGHT),
        *user_of("fct_nutrition", marts_user),
        related("fct_nutrition", "date_key", "dim_date", "date_key"),
        positive("fct_nutrition", "calories_consumed"),
        between("fct_nutrition", "meals_logged", MEAL_COUNT),
        *key("dim_date", "date_key"),
        *key("dim_date", "date_day"),
        Check(
            "experiment_balanced",
            "stg_experiment_assignment",
            offenders=lambda t: x.experiment_balanced(t["stg_experiment_assignment"]),
        ),
        Check(
            "one_current_version", "dim_user_scd2", offenders=lambda t: x.one_current(t["dim_user_scd2"])
        ),
        Check("sleep_stages_within_total", "stg_daily_activity", x.stages_exceed_sleep),
    ]
