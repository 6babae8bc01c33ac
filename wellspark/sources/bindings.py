"""The raw health tables as derived from a TPC-H-like star schema with an event log.

Each function reads the given tables whole and returns the columns of the raw table of the
same name. Measures are derived in decimals or integers, so every engine agrees on them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspark.functions.scalars import clip
from wellspark.operators.staging import typed
from wellspark.sources.schemas import RAW_SCHEMAS
from wellspark.sources.storage import scan

MONEY = "decimal(12,2)"


def _typed(df: DataFrame, name: str) -> DataFrame:
    return typed(df, RAW_SCHEMAS[name])


def events(spark: SparkSession, sf: str) -> DataFrame:
    return scan(spark, sf, "events").select(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        "props",
        F.to_date("ts").alias("event_date"),
        F.col("value").cast(MONEY).alias("amount"),
    )


def dim_device(spark: SparkSession, sf: str) -> DataFrame:
    region = scan(spark, sf, "region")
    return _typed(
        region.select(
            (F.col("r_regionkey") + 1).alias("device_id"),
            F.col("r_name").alias("brand"),
            F.concat("r_name", F.lit(" Band")).alias("model"),
            F.when(F.col("r_regionkey") == 3, "scale").otherwise("wearable").alias("category"),
        ),
        "dim_device",
    )


def dim_user(spark: SparkSession, sf: str) -> DataFrame:
    customer, nation = scan(spark, sf, "customer"), scan(spark, sf, "nation")
    key = F.col("c_custkey")
    return _typed(
        customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left").select(
            key.alias("user_id"),
            F.col("c_name").alias("full_name"),
            F.when(key % 2 == 0, "M").otherwise("F").alias("sex"),
            (18 + key % 47).alias("age"),
            ((1500 + key % 400) / 10).alias("height_cm"),
            F.col("n_name").alias("country"),
            (1 + key % 3).alias("primary_device_id"),
            F.date_add(F.lit("1995-01-01").cast("date"), (key % 365).cast("int")).alias(
                "signup_date"
            ),
        ),
        "dim_user",
    )


def user_segments(spark: SparkSession, sf: str) -> DataFrame:
    return scan(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment")
    )


def user_attr_history(spark: SparkSession, sf: str) -> DataFrame:
    """One span per customer and order date; of several orders a day the last one counts."""
    tier = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "pro")
        .when(F.col("o_orderpriority").isin("2-HIGH", "3-MEDIUM"), "plus")
        .otherwise("free")
    )
    newest = F.max(F.struct("o_orderkey", tier.alias("tier"), "o_orderstatus")).alias("newest")
    return _typed(
        scan(spark, sf, "orders")
        .groupBy(
            F.col("o_custkey").alias("user_id"), F.to_date("o_orderdate").alias("effective_from")
        )
        .agg(newest)
        .select(
            "user_id",
            F.col("newest.tier").alias("membership_tier"),
            F.col("newest.o_orderstatus").alias("company"),
            "effective_from",
        ),
        "user_attr_history",
    )


def daily_activity(spark: SparkSession, sf: str) -> DataFrame:
    daily = (
        events(spark, sf)
        .groupBy("user_id", F.col("event_date").alias("activity_date"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("event_type") != "error").alias("quiet"),
            F.sum("amount").alias("total"),
            F.max("amount").alias("top"),
        )
        .withColumn("sleep_minutes", F.least(F.lit(660), F.col("quiet") * 120))
        .withColumn("sleep_deep_minutes", F.expr("sleep_minutes * 20 div 100"))
        .withColumn("sleep_rem_minutes", F.expr("sleep_minutes * 22 div 100"))
    )
    return _typed(
        daily.select(
            "*",
            (1 + F.col("user_id") % 3).alias("device_id"),
            clip(F.floor(F.col("total") * 100).cast("bigint"), 200, 35000).alias("steps"),
            clip(F.col("n") * 15, 0, 400).alias("active_minutes"),
            F.round(50 + F.least(F.lit(50).cast(MONEY), F.col("top")), 1).alias("resting_hr"),
            (
                F.col("sleep_minutes") - F.col("sleep_deep_minutes") - F.col("sleep_rem_minutes")
            ).alias("sleep_light_minutes"),
            clip(1200 + F.floor(F.col("total") * 10).cast("bigint"), 1200, 20000).alias("calories"),
        ),
        "daily_activity",
    )


def intraday_hr(spark: SparkSession, sf: str) -> DataFrame:
    return _typed(
        events(spark, sf)
        .groupBy("user_id", F.col("event_date").alias("activity_date"), F.hour("ts").alias("hour"))
        .agg(clip(50 + F.floor(F.max("amount")).cast("bigint"), 35, 200).alias("heart_rate")),
        "intraday_hr",
    )


def body_scan(spark: SparkSession, sf: str) -> DataFrame:
    """One scan per user and week, on the user's last active day of that week."""
    top, low = F.col("top"), F.col("low")
    return _typed(
        events(spark, sf)
        .groupBy("user_id", F.trunc("event_date", "week").alias("week"))
        .agg(
            F.max("event_date").alias("scan_date"),
            F.max("amount").alias("top"),
            F.min("amount").alias("low"),
        )
        .select(
            "user_id",
            "scan_date",
            F.lit(4).alias("device_id"),
            F.round(40 + F.least(F.lit(160).cast(MONEY), top), 1).alias("weight_kg"),
            F.round(16 + F.least(F.lit(24).cast(MONEY), low), 1).alias("bmi"),
            F.round(5 + F.least(F.lit(50).cast(MONEY), low), 1).alias("body_fat_pct"),
            F.round(20 + F.least(F.lit(60).cast(MONEY), top), 1).alias("muscle_mass_kg"),
            F.round(1 + F.least(F.lit(29).cast(MONEY), low), 1).alias("visceral_fat"),
        ),
        "body_scan",
    )


def nutrition_log(spark: SparkSession, sf: str) -> DataFrame:
    """One meal per event, entered the day after, so some days have no activity row."""
    kcal = F.col("kcal")
    return _typed(
        events(spark, sf)
        .withColumn("kcal", F.col("amount") + 100)
        .select(
            "user_id",
            F.date_add("event_date", 1).alias("log_date"),
            F.when(F.col("event_type") == "click", "Breakfast")
            .when(F.col("event_type") == "view", "LUNCH")
            .when(F.col("event_type") == "purchase", "Dinner")
            .otherwise("Snack")
            .alias("meal_type"),
            kcal.alias("calories"),
            F.round(kcal * F.lit("0.07").cast("decimal(3,2)"), 1).alias("protein_g"),
            F.round(kcal * F.lit("0.11").cast("decimal(3,2)"), 1).alias("carbs_g"),
            F.round(kcal * F.lit("0.03").cast("decimal(3,2)"), 1).alias("fat_g"),
        ),
        "nutrition_log",
    )


def experiment_assignment(spark: SparkSession, sf: str) -> DataFrame:
    """One document per subject, one experiment per language, quality label as outcome."""
    labels = scan(spark, sf, "labels").select("doc_id", "quality")
    documents = scan(spark, sf, "documents").select("doc_id", "lang")
    return _typed(
        labels.join(documents, "doc_id").select(
            F.col("doc_id").alias("user_id"),
            F.concat(F.lit("quality_"), F.col("lang")).alias("experiment_name"),
            F.when(F.col("doc_id") % 2 == 0, "A").otherwise("B").alias("variant"),
            F.col("quality").alias("engaged_next_day"),
        ),
        "experiment_assignment",
    )


def document_lengths(spark: SparkSession, sf: str) -> DataFrame:
    """A continuous metric per experiment subject: (experiment_name, variant, n_chars)."""
    documents = scan(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    return documents.select(
        F.col("doc_id").alias("user_id"),
        F.concat(F.lit("length_"), F.col("lang")).alias("experiment_name"),
        F.when(F.col("doc_id") % 2 == 0, "A").otherwise("B").alias("variant"),
        "n_chars",
    )


def shipments(spark: SparkSession, sf: str) -> DataFrame:
    """A large fact per user and date: order lines on their ship date."""
    lines = scan(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"
    )
    orders = scan(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("user_id"),
        F.to_date("l_shipdate").alias("ship_date"),
        "l_orderkey",
        "l_linenumber",
        F.col("l_quantity").cast(MONEY).alias("quantity"),
        F.col("l_extendedprice").cast(MONEY).alias("price"),
    )


def _micros(ts: str) -> Column:
    """Microseconds since 1970 of a timestamp without zone, whatever the session's zone."""
    seconds = F.unix_date(F.to_date(ts)).cast("bigint") * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60
    return seconds * 1000000 + (F.extract(F.lit("SECOND"), ts) * 1000000).cast("bigint")


def wearable_events(spark: SparkSession, sf: str) -> DataFrame:
    """Single readings in the shape the stream publishes."""
    return events(spark, sf).select(
        "event_id",
        "user_id",
        (_micros("ts") / 1000000).alias("ts"),
        clip(40 + F.floor("amount").cast("int"), 40, 195).cast("int").alias("heart_rate"),
        F.get_json_object("props", "$.k").cast("int").alias("steps_delta"),
        F.col("event_type").alias("device"),
    )


RAW: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        dim_device,
        dim_user,
        user_attr_history,
        daily_activity,
        intraday_hr,
        body_scan,
        nutrition_log,
        experiment_assignment,
    )
}


def raw_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {name: build(spark, sf) for name, build in RAW.items()}
