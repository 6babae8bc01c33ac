"""Group-by operators and report aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspark.functions.scalars import EPOCH_START, exact_mean, stable_round


def nutrition_daily(meals: DataFrame) -> DataFrame:
    """Meals rolled up to one row per user and day."""
    return meals.groupBy("user_id", "log_date").agg(
        F.count(F.lit(1)).alias("meals_logged"),
        F.sum("calories").alias("total_calories"),
        *[F.sum(c).alias(c) for c in ("protein_g", "carbs_g", "fat_g")],
    )


def variant_summary(df: DataFrame) -> DataFrame:
    """Engaged count, size and engagement rate per experiment and variant."""
    return (
        df.groupBy("experiment_name", "variant")
        .agg(
            F.sum("engaged_next_day").alias("engaged"),
            F.count("engaged_next_day").alias("n"),
        )
        .withColumn("rate", F.col("engaged") / F.nullif("n", F.lit(0)))
    )


def filtered_counts(df: DataFrame, key: str, **predicates: Column) -> DataFrame:
    """Rows per key satisfying each predicate."""
    return df.groupBy(key).agg(*[F.count_if(p).alias(name) for name, p in predicates.items()])


def having(df: DataFrame, keys: Sequence[str], aggregates: dict[str, Column], keep: Column) -> DataFrame:
    """Groups whose aggregates satisfy ``keep``."""
    return df.groupBy(*keys).agg(*[a.alias(n) for n, a in aggregates.items()]).where(keep)


def share_of_total(df: DataFrame, key: str) -> DataFrame:
    """Rows per key, the total, and the key's share of it.

    The total is a scalar subquery over the group counts, whose shuffle serves both: the
    source is read once, and no rows are joined.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total_n")).scalar()
    return counts.withColumn("total_n", total).withColumn("share", F.col("n") / F.col("total_n"))


def high_water(target: DataFrame, date: str) -> DataFrame:
    """One row: the newest date loaded, 1900-01-01 for an empty target."""
    return target.agg(
        F.coalesce(F.max(date), F.lit(EPOCH_START).cast("date")).alias("high_water")
    )


def arm_stats(df: DataFrame, metric: str) -> DataFrame:
    """Count, mean and sample variance of a metric per experiment and variant."""
    value = F.col(metric).cast("double")
    return df.groupBy("experiment_name", "variant").agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.var_samp(value).alias("variance")
    )


def correlation(df: DataFrame, a: str, b: str) -> DataFrame:
    """Pearson correlation of two columns, with the number of rows."""
    return df.agg(F.count(F.lit(1)).alias("n"), F.corr(a, b).alias("correlation"))


def rows_per_key(df: DataFrame, key: str) -> DataFrame:
    """Keys, and the fewest and most rows any key has."""
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.count(F.lit(1)).alias("n_keys"),
            F.min("n").alias("min_rows"),
            F.max("n").alias("max_rows"),
        )
    )


def activity_overview(
    fact: DataFrame, users: DataFrame, dates: DataFrame, tier: str | None = None
) -> DataFrame:
    """Average steps, active minutes and resting heart rate per date, for a tier if given."""
    if tier is not None:
        members = users.where(F.col("membership_tier") == tier).select("user_id")
        fact = fact.join(members, "user_id", "left_semi")
    daily = fact.groupBy("date_key").agg(
        F.count(F.lit(1)).alias("user_days"),
        *[
            exact_mean(F.sum(F.col(c).cast("decimal(20,1)")), F.count(c), 2).alias(f"avg_{c}")
            for c in ("steps", "active_minutes", "resting_hr")
        ],
    )
    # The date dimension joins the few aggregated rows, not the facts.
    return daily.join(dates.select("date_key", "date_day", "is_weekend"), "date_key", "left")


def body_trend(fact: DataFrame, users: DataFrame, cohort: str = "membership_tier") -> DataFrame:
    """Mean weight, body fat and muscle mass per cohort and month."""
    return (
        fact.join(users.select("user_id", cohort), "user_id", "left")
        .groupBy(cohort, F.trunc("scan_date", "month").alias("month"))
        .agg(
            F.count(F.lit(1)).alias("scans"),
            *[
                exact_mean(F.sum(F.col(c).cast("decimal(20,1)")), F.count(c), 2).alias(f"avg_{c}")
                for c in ("weight_kg", "body_fat_pct", "muscle_mass_kg")
            ],
        )
    )


def balance_histogram(fact: DataFrame, width: int) -> DataFrame:
    """Rows per ``width`` kcal of calorie balance; days without a balance have a null bucket."""
    low = (F.floor(F.col("calorie_balance") / width) * width).cast("bigint")
    return fact.groupBy(low.alias("balance_from")).agg(F.count(F.lit(1)).alias("n"))


def score_series(scores: DataFrame, score: str = "rolling_30d_score") -> DataFrame:
    """Mean rolling score over all users per date."""
    value = F.col(score).cast("decimal(18,6)")
    return scores.groupBy("activity_date").agg(
        F.count(score).alias("users"), exact_mean(F.sum(value), F.count(score), 2).alias("avg_score")
    )


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round computed double columns for a report."""
    return df.withColumns({c: stable_round(c, digits) for c in columns})
