"""Every operator as a query over the given tables: name -> (spark, directory) -> DataFrame.

Queries bind the operators to the raw tables of :mod:`wellspark.sources.bindings` and only
shape the output: decimals become doubles and computed doubles are rounded, so that another
engine can be compared row by row.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wellspark.functions import scalars as s
from wellspark.operators import aggregates as agg
from wellspark.operators import expectations as x
from wellspark.operators import experiment as ab
from wellspark.operators import history as h
from wellspark.operators import joins, loads, metrics, reshape, windows
from wellspark.plans import health_score, marts, pipeline, quality
from wellspark.plans import late as late_scores
from wellspark.sources import bindings as b
from wellspark.sources import storage, versions
from wellspark.sources.schemas import (
    BIGINT,
    DATE_SEED,
    DOUBLE,
    EVENT,
    RAW_SCHEMAS,
    RAW_TABLES,
    TEXT,
    columns,
)
from wellspark.streaming import events as ev
from wellspark.streaming import sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Cut-off dates of the incremental and snapshot queries, inside the range of the tables.
LOADED_TO = dt.date(2024, 1, 20)
REPLACED_FROM, REPLACED_TO = dt.date(2024, 1, 10), dt.date(2024, 1, 15)
SNAPSHOT_DAYS = (dt.date(1997, 1, 1), dt.date(1999, 1, 1), dt.date(2001, 12, 31))


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else f.name
            for f in df.schema
        ]
    )


def query(build: Query) -> Query:
    QUERIES[build.__name__] = lambda spark, sf: plain(build(spark, sf))
    return build


# Staged tables and marts over the bindings.


def activity(spark, sf):
    return marts.stage({"daily_activity": b.daily_activity(spark, sf)})["stg_daily_activity"]


def users(spark, sf):
    return marts.stage({"dim_user": b.dim_user(spark, sf)})["stg_users"]


def spans(spark, sf):
    return marts.stage({"user_attr_history": b.user_attr_history(spark, sf)})["stg_user_attr_history"]


def scans(spark, sf):
    return marts.stage({"body_scan": b.body_scan(spark, sf)})["stg_body_scan"]


def meals(spark, sf):
    return marts.stage({"nutrition_log": b.nutrition_log(spark, sf)})["stg_nutrition_log"]


def assignments(spark, sf):
    return marts.stage({"experiment_assignment": b.experiment_assignment(spark, sf)})[
        "stg_experiment_assignment"
    ]


def current_users(spark, sf):
    return marts.dim_user(users(spark, sf), spans(spark, sf))


def activity_fact(spark, sf):
    return marts.fct_daily_activity(metrics.activity_enriched(activity(spark, sf)))


def scan_fact(spark, sf):
    return marts.fct_body_scan(scans(spark, sf))


def nutrition_fact(spark, sf):
    return marts.fct_nutrition(agg.nutrition_daily(meals(spark, sf)), activity(spark, sf))


def scored(spark, sf):
    return metrics.daily_subscore(activity(spark, sf)).select(
        "user_id", "activity_date", "daily_score"
    )


# Sources, sinks, layout.


@query
def scan_parquet(spark, sf):
    return (
        storage.scan(spark, sf, "lineitem")
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.count(F.lit(1)).alias("n_lines"),
            F.sum(F.col("l_quantity").cast(b.MONEY)).alias("quantity"),
        )
    )


@query
def scan_csv_typed(spark, sf):
    path = storage.shared_dir(spark, "seed")
    storage.write_table(dim_date(spark, sf), "dim_date", path, ["csv"])
    return storage.scan_csv(spark, f"{path}/dim_date.csv", DATE_SEED)


def _stored_sources(spark, sf):
    path = storage.shared_dir(spark, "raw")
    for name, df in b.raw_tables(spark, sf).items():
        storage.write_table(df, name, path, ["parquet"])
    return path


@query
def source_registry(spark, sf):
    loaded = storage.load_sources(spark, _stored_sources(spark, sf))
    order = {name: i for i, name in enumerate(RAW_TABLES)}
    lines = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(order[name]).alias("load_order"), F.lit(name).alias("table_name"), "n_rows"
        )
        for name, df in loaded.items()
    ]
    return reshape.union_all(*lines)


@query
def write_formats(spark, sf):
    path = storage.shared_dir(spark, "formats")
    files = storage.write_table(b.body_scan(spark, sf), "body_scan", path, storage.FORMATS)
    back = [
        spark.read.parquet(files["parquet"]).withColumn("format", F.lit("parquet")),
        storage.scan_csv(spark, files["csv"], RAW_SCHEMAS["body_scan"]).withColumn(
            "format", F.lit("csv")
        ),
    ]
    return reshape.union_all(*back).select("format", "user_id", "scan_date", "weight_kg", "bmi")


@query
def sample_extract(spark, sf):
    return storage.sample_users(activity(spark, sf), 5)


@query
def load_warehouse_truncate(spark, sf):
    path = storage.shared_dir(spark, "warehouse")
    table = "wellspark_intraday_" + path.rsplit("-", 1)[-1]
    for _ in range(2):  # a second load replaces the first
        loads.table_load(b.intraday_hr(spark, sf), table, path)
    return spark.table(table)


@query
def load_audit(spark, sf):
    return storage.load_audit(b.raw_tables(spark, sf), loaded=["dim_user"])


@query
def load_audit_observed(spark, sf):
    """The same lines, from the rows counted while the tables are written."""
    return storage.load_all(
        spark, b.raw_tables(spark, sf), storage.shared_dir(spark, "loaded"), loaded=["dim_user"]
    )


@query
def write_partitioned_year(spark, sf):
    path = storage.shared_dir(spark, "scores")
    scores = b.shipments(spark, sf).select("user_id", "ship_date", "l_orderkey", "quantity")
    storage.write_scores(scores, path, "ship_date")
    return spark.read.parquet(path).groupBy("year").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("quantity").alias("quantity")
    )


@query
def layout_fact_tables(spark, sf):
    path = storage.shared_dir(spark, "facts")
    storage.write_fact(activity_fact(spark, sf), f"{path}/activity", "activity_date", "day")
    storage.write_fact(scan_fact(spark, sf), f"{path}/scan", "scan_date", "month")
    parts = [
        spark.read.parquet(f"{path}/{name}")
        .groupBy(F.lit(name).alias("table_name"), F.col(part).alias("partition_date"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        for name, part in (("activity", "activity_date"), ("scan", "scan_date_month"))
    ]
    return reshape.union_all(*parts)


@query
def preview(spark, sf):
    return storage.preview(scored(spark, sf), 15, "user_id", "activity_date")


# Staging.


@query
def stg_users(spark, sf):
    return users(spark, sf)


@query
def stg_devices(spark, sf):
    return marts.stage({"dim_device": b.dim_device(spark, sf)})["stg_devices"]


@query
def stg_user_attr_history(spark, sf):
    return spans(spark, sf)


@query
def stg_daily_activity(spark, sf):
    return activity(spark, sf)


@query
def stg_body_scan(spark, sf):
    return scans(spark, sf)


@query
def stg_nutrition_log(spark, sf):
    return meals(spark, sf)


@query
def stg_experiment_assignment(spark, sf):
    return assignments(spark, sf)


# Scalars.


@query
def date_key(spark, sf):
    return storage.scan(spark, sf, "orders").select(
        "o_orderkey", s.date_key("o_orderdate").alias("date_key")
    )


@query
def restorative_sleep_ratio(spark, sf):
    return metrics.activity_enriched(activity(spark, sf)).select(
        "user_id", "activity_date", "restorative_sleep_ratio"
    )


@query
def hit_step_goal(spark, sf):
    return metrics.activity_enriched(activity(spark, sf)).select(
        "user_id", "activity_date", "steps", "hit_step_goal"
    )


@query
def int_activity_enriched(spark, sf):
    return metrics.activity_enriched(activity(spark, sf))


@query
def daily_subscore(spark, sf):
    return scored(spark, sf)


@query
def calorie_balance(spark, sf):
    return nutrition_fact(spark, sf).select(
        "user_id", "log_date", "calories_consumed", "calories_burned", "calorie_balance"
    )


@query
def surrogate_key(spark, sf):
    return storage.scan(spark, sf, "orders").select(
        "o_orderkey",
        s.surrogate_key(["o_custkey", F.to_date("o_orderdate")]).alias("version_key"),
    )


@query
def open_ended_sentinel(spark, sf):
    return h.scd2_from_spans(spans(spark, sf)).select("user_id", "valid_from", "valid_to", "is_current")


@query
def year_of_date(spark, sf):
    return storage.scan(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.year("l_shipdate").alias("year")
    )


@query
def weekend_flag(spark, sf):
    return storage.scan(spark, sf, "orders").select(
        "o_orderkey", s.is_weekend("o_orderdate").alias("is_weekend")
    )


@query
def clip(spark, sf):
    return b.events(spark, sf).select(
        "event_id", s.clip("amount", 5, 50).cast("double").alias("clipped")
    )


@query
def bmi_body_metrics(spark, sf):
    return metrics.body_metrics(scans(spark, sf), users(spark, sf))


@query
def bmr_energy(spark, sf):
    return metrics.expected_burn(activity(spark, sf), users(spark, sf), scans(spark, sf))


@query
def body_fat_estimate(spark, sf):
    people = users(spark, sf).select("user_id", "sex", "age")
    estimated = metrics.body_fat_estimate(scans(spark, sf).join(people, "user_id", "left"))
    return estimated.select("user_id", "scan_date", "bmi", "body_fat_estimate")


@query
def macro_energy_share(spark, sf):
    return metrics.macro_shares(agg.nutrition_daily(meals(spark, sf)))


# Joins.


@query
def join_broadcast_left(spark, sf):
    return joins.enrich(scored(spark, sf), users(spark, sf))


@query
def join_left_two_key(spark, sf):
    return nutrition_fact(spark, sf).select("user_id", "log_date", "meals_logged", "calories_burned")


@query
def join_bucketed_facts(spark, sf):
    """Intake next to the calories burned, from facts stored in buckets of user and day."""
    run = storage.shared_dir(spark, "bucketed")
    facts = {
        "meals": (agg.nutrition_daily(meals(spark, sf)), ["user_id", "log_date"]),
        "days": (activity(spark, sf).withColumnRenamed("activity_date", "log_date"), ["user_id", "log_date"]),
    }
    tables = {}
    for name, (df, keys) in facts.items():
        table = f"wellspark_{name}_" + run.rsplit("-", 1)[-1]
        storage.write_bucketed(df, table, f"{run}/{name}", keys, 16)
        tables[name] = spark.table(table)
    burned = tables["days"].withColumnRenamed("log_date", "activity_date")
    return marts.fct_nutrition(tables["meals"], burned).select(
        "user_id", "log_date", "meals_logged", "calories_burned"
    )


@query
def join_left_latest(spark, sf):
    return current_users(spark, sf).select("user_id", "membership_tier", "company")


@query
def join_lookup_map(spark, sf):
    return joins.stamp_device(activity(spark, sf), users(spark, sf)).select(
        "user_id", "activity_date", "device_id"
    )


@query
def join_cross_scalar(spark, sf):
    return agg.share_of_total(assignments(spark, sf), "variant").select("variant", "n", "total_n")


@query
def join_semi(spark, sf):
    members = b.user_segments(spark, sf).where(F.col("segment") == "BUILDING")
    return storage.sample_users(b.user_attr_history(spark, sf), keys=members)


@query
def join_anti_fk(spark, sf):
    lines = storage.scan(spark, sf, "orders").select(F.col("o_custkey").alias("user_id"))
    return x.relationships(lines, "user_id", storage.scan(spark, sf, "events"), "user_id")


@query
def join_asof_scd2(spark, sf):
    versions = h.scd2_from_spans(spans(spark, sf)).select(
        "user_id", "membership_tier", "company", "valid_from", "valid_to"
    )
    lines = b.shipments(spark, sf).select("user_id", "ship_date", "price")
    # Line numbers repeat within an order; counting equal rows keeps every one of them.
    return (
        joins.as_of_join(lines, versions, "ship_date", width=windows.YEAR)
        .groupBy("user_id", "ship_date", "membership_tier", "company", "valid_from", "valid_to")
        .agg(F.count(F.lit(1)).alias("n_lines"), F.sum("price").alias("price"))
    )


@query
def join_star_bi(spark, sf):
    fact = activity_fact(spark, sf).select("user_id", "date_key", "steps")
    return joins.star(
        fact,
        dim_date(spark, sf).select("date_key", "date_day", "is_weekend"),
        current_users(spark, sf).select("user_id", "country", "membership_tier"),
    )


# Aggregations.


@query
def int_nutrition_daily(spark, sf):
    return agg.nutrition_daily(meals(spark, sf))


@query
def nutrition_daily_lines(spark, sf):
    """The same roll-up on the largest table: order lines as meals."""
    lines = storage.scan(spark, sf, "lineitem").select(
        "l_orderkey", "l_shipdate", "l_returnflag", "l_extendedprice", "l_quantity", "l_discount", "l_tax"
    )
    orders = storage.scan(spark, sf, "orders").select("o_orderkey", "o_custkey")
    money = {"calories": "l_extendedprice", "protein_g": "l_quantity", "carbs_g": "l_discount", "fat_g": "l_tax"}
    logged = lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("user_id"),
        F.to_date("l_shipdate").alias("log_date"),
        *[F.col(c).cast(b.MONEY).alias(name) for name, c in money.items()],
    )
    return agg.nutrition_daily(logged)


@query
def variant_summary(spark, sf):
    return agg.variant_summary(assignments(spark, sf))


@query
def agg_filtered_count(spark, sf):
    return agg.filtered_counts(
        b.events(spark, sf),
        "user_id",
        errors=F.col("event_type") == "error",
        large=F.col("amount") >= 50,
    )


@query
def agg_having(spark, sf):
    return agg.having(
        b.events(spark, sf),
        ["user_id", "event_date"],
        {"n": F.count(F.lit(1)), "amount": F.sum("amount")},
        (F.col("n") >= 4) | (F.col("amount") > 200),
    )


@query
def agg_two_level_share(spark, sf):
    return agg.rounded(agg.share_of_total(b.events(spark, sf), "event_type"), 6, "share")


@query
def agg_high_water(spark, sf):
    fact = activity_fact(spark, sf)
    marks = {"loaded": fact, "empty": fact.where(F.lit(False))}
    return reshape.union_all(
        *[agg.high_water(t, "activity_date").withColumn("target", F.lit(n)) for n, t in marks.items()]
    )


@query
def agg_sufficient_stats(spark, sf):
    return agg.rounded(agg.arm_stats(b.document_lengths(spark, sf), "n_chars"), 2, "mean", "variance")


@query
def agg_correlation(spark, sf):
    return agg.rounded(agg.correlation(activity(spark, sf), "steps", "calories"), 6, "correlation")


@query
def agg_rows_per_group(spark, sf):
    return agg.rows_per_key(storage.scan(spark, sf, "events"), "user_id")


@query
def bi_activity_overview(spark, sf):
    return agg.activity_overview(
        activity_fact(spark, sf), current_users(spark, sf), dim_date(spark, sf), "plus"
    )


@query
def bi_body_trend(spark, sf):
    return agg.body_trend(scan_fact(spark, sf), current_users(spark, sf))


@query
def bi_balance_distribution(spark, sf):
    return agg.balance_histogram(nutrition_fact(spark, sf), 100)


@query
def bi_score_series(spark, sf):
    return agg.score_series(windows.rolling_score(scored(spark, sf)))


# Windows.


@query
def rolling_30d_score(spark, sf):
    return windows.rolling_score(scored(spark, sf)).drop("days_in_window")


@query
def rolling_7d_score(spark, sf):
    return windows.rolling_score(scored(spark, sf), 7)


@query
def days_in_window(spark, sf):
    return windows.rolling_score(scored(spark, sf)).select(
        "user_id", "activity_date", "days_in_window"
    )


@query
def rolling_health_score(spark, sf):
    return health_score.rolling_health_score(activity(spark, sf), users(spark, sf))


@query
def rolling_30d_calendar(spark, sf):
    return health_score.rolling_calendar_score(activity(spark, sf))


@query
def rolling_7d_calendar(spark, sf):
    return health_score.rolling_calendar_score(activity(spark, sf), 7)


@query
def latest_per_user(spark, sf):
    return windows.latest_by(spans(spark, sf), "user_id", "effective_from")


@query
def lead_valid_to(spark, sf):
    return windows.neighbour(
        spans(spark, sf).select("user_id", "effective_from"), ["user_id"], "effective_from", "next_from"
    )


@query
def zscore_per_user(spark, sf):
    z = windows.zscore(activity(spark, sf), "user_id", "steps", "steps_z")
    return agg.rounded(z.select("user_id", "activity_date", "steps_z"), 5, "steps_z")


@query
def running_sum(spark, sf):
    return windows.running_sum(
        activity(spark, sf).select("user_id", "activity_date", "steps"),
        "user_id",
        "activity_date",
        "steps",
        "steps_so_far",
    )


@query
def cadence_downsample(spark, sf):
    return windows.downsample(activity(spark, sf), "user_id", "activity_date", 7).select(
        "user_id", "activity_date", "steps"
    )


@query
def peak_relative(spark, sf):
    peaks = windows.relative_to_peak(activity(spark, sf), "user_id", "steps", "of_peak")
    return agg.rounded(peaks.select("user_id", "activity_date", "of_peak"), 6, "of_peak")


# Sort, limit, set operations, reshaping.


@query
def sort_history(spark, sf):
    return reshape.sort_spans(spans(spark, sf))


@query
def top_n_preview(spark, sf):
    return activity(spark, sf).orderBy("user_id", "activity_date").limit(15)


@query
def union_frames(spark, sf):
    daily = activity(spark, sf).select("user_id", F.col("activity_date").alias("day"))
    scanned = scans(spark, sf).select("user_id", F.col("scan_date").alias("day"))
    eaten = meals(spark, sf).select("user_id", F.col("log_date").alias("day"))
    return reshape.union_all(daily, scanned, eaten)


@query
def table_diff(spark, sf):
    """Two builds of the event log that differ in one rule."""
    log = storage.scan(spark, sf, "events").select("user_id", "event_type")
    later = log.withColumn(
        "event_type", F.when(F.col("event_type") == "signup", "view").otherwise(F.col("event_type"))
    )
    return reshape.table_diff(log, later)


@query
def hourly_to_long(spark, sf):
    grid = reshape.hourly_grid(b.intraday_hr(spark, sf), ["user_id", "activity_date"], "hour", "heart_rate")
    return reshape.to_long(grid, "hourly", "hour", "heart_rate")


@query
def hourly_summary(spark, sf):
    return reshape.hr_daily(b.intraday_hr(spark, sf))


@query
def date_spine(spark, sf):
    """18 months of 30 days back from the last order date."""
    last = storage.scan(spark, sf, "orders").agg(F.max(F.to_date("o_orderdate")).alias("last"))
    return reshape.spine(last, F.date_sub("last", 18 * 30 - 1), F.col("last"))


@query
def dim_date(spark, sf):
    return marts.dim_date_over(
        (b.events(spark, sf), "event_date"),
        (storage.scan(spark, sf, "orders").select(F.to_date("o_orderdate").alias("d")), "d"),
    )


# Marts, incremental loads, history.


@query
def dim_device(spark, sf):
    return marts.dim_device(stg_devices(spark, sf))


@query
def dim_user(spark, sf):
    return current_users(spark, sf)


@query
def dim_user_scd2(spark, sf):
    return marts.dim_user_scd2(spans(spark, sf))


@query
def fct_daily_activity(spark, sf):
    return activity_fact(spark, sf)


@query
def fct_body_scan(spark, sf):
    return scan_fact(spark, sf)


@query
def fct_nutrition(spark, sf):
    return nutrition_fact(spark, sf)


DAILY = ("user_id", "activity_date", "n", "amount")
SCORE = ("user_id", "activity_date", "daily_score")


def _daily_totals(spark, sf, early: bool = False):
    """Events per user and day; the early build lacks the signups, which arrive late."""
    log = b.events(spark, sf)
    log = log.where(F.col("event_type") != "signup") if early else log
    return log.groupBy("user_id", F.col("event_date").alias("activity_date")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount")
    )


def _loaded(spark, sf, label):
    """The early build as a stored table partitioned by day."""
    path = storage.shared_dir(spark, label)
    storage.write_partitioned(_daily_totals(spark, sf, early=True), path, "activity_date", "user_id")
    return path


@query
def incremental_append(spark, sf):
    """A first load up to a day, the rest appended, and a run that finds nothing new."""
    source = _daily_totals(spark, sf)
    path = storage.shared_dir(spark, "append")
    for known in (source.where(F.col("activity_date") <= F.lit(LOADED_TO)), source, source):
        loads.load_incremental(spark, known, path, "activity_date", DAILY[:2], "append")
    return versions.read(spark, path).select(*DAILY)


@query
def incremental_delete_insert(spark, sf):
    path = _loaded(spark, sf, "delete-insert-target")
    batch = _daily_totals(spark, sf).where(F.col("activity_date") >= F.lit(REPLACED_FROM))
    loads.apply_delete_insert(spark, path, batch, ["user_id", "activity_date"], "activity_date")
    return spark.read.parquet(path).select(*DAILY)


def _undated(totals):
    """The days of every seventh user are unknown."""
    day = F.when(F.col("user_id") % 7 != 3, F.col("activity_date"))
    return totals.withColumn("activity_date", day)


@query
def incremental_null_dates(spark, sf):
    """Delete+insert where target and batch hold rows without a date."""
    path = storage.shared_dir(spark, "null-dates")
    target = _undated(_daily_totals(spark, sf, early=True))
    storage.write_partitioned(target, path, "activity_date", "user_id")
    late = F.col("activity_date").isNull() | (F.col("activity_date") >= F.lit(REPLACED_FROM))
    batch = _undated(_daily_totals(spark, sf)).where(late)
    loads.apply_delete_insert(spark, path, batch, ["user_id", "activity_date"], "activity_date")
    return spark.read.parquet(path).select(*DAILY)


@query
def incremental_insert_overwrite(spark, sf):
    path = _loaded(spark, sf, "insert-overwrite")
    batch = _daily_totals(spark, sf).where(
        F.col("activity_date").between(F.lit(REPLACED_FROM), F.lit(REPLACED_TO))
    )
    loads.overwrite_partitions(batch, path, "activity_date")
    return spark.read.parquet(path).select(*DAILY)


@query
def incremental_late_upsert(spark, sf):
    target = _daily_totals(spark, sf, early=True).where(F.col("activity_date") <= F.lit(LOADED_TO))
    batch = loads.new_rows(_daily_totals(spark, sf), target, "activity_date", lookback_days=7)
    return loads.delete_insert(target, batch, ["user_id", "activity_date"])


@query
def late_rows_to_scores(spark, sf):
    """Some users' days arrive after the scores were stored, and reach seven rows on."""
    path, days = storage.shared_dir(spark, "late-scores"), activity(spark, sf)
    late = (F.col("user_id") % 5 == 2) & F.col("activity_date").between(F.lit(REPLACED_FROM), F.lit(REPLACED_TO))
    known = days.where(~late)
    storage.write_fact(known, f"{path}/facts", "activity_date")
    stored = windows.rolling_score(metrics.daily_subscore(known).select(*SCORE), 7)
    storage.write_fact(stored, f"{path}/scores", "activity_date")
    late_scores.apply_late(spark, f"{path}/facts", f"{path}/scores", days.where(late), 7)
    return spark.read.parquet(f"{path}/scores").select(*stored.columns)


@query
def full_refresh(spark, sf):
    path = storage.shared_dir(spark, "refresh")
    for early in (True, False):  # the second refresh replaces the first
        loads.full_refresh(lambda: _daily_totals(spark, sf, early), path, "activity_date")
    return versions.read(spark, path).select(*DAILY)


@query
def scd2_snapshot(spark, sf):
    """Three snapshot runs of the users' current attributes, the second of them repeated."""
    path = storage.shared_dir(spark, "snapshot")
    for day in (*SNAPSHOT_DAYS[:2], *SNAPSHOT_DAYS[1:]):
        known = spans(spark, sf).where(F.col("effective_from") <= F.lit(day))
        current = windows.latest_by(known, "user_id", "effective_from").drop("effective_from")
        h.apply_snapshot(spark, path, current, "user_id", ["membership_tier", "company"], day)
    return h.snapshot(spark, path)


@query
def backfill_interval(spark, sf):
    path = _loaded(spark, sf, "backfill")
    for _ in range(2):  # a repeated run leaves the same table
        loads.run_interval(
            _daily_totals(spark, sf), path, "activity_date", "activity_date", REPLACED_FROM, REPLACED_TO
        )
    return spark.read.parquet(path).select(*DAILY)


@query
def rolling_backfill(spark, sf):
    return health_score.rolling_interval(activity(spark, sf), REPLACED_FROM, LOADED_TO, 7)


@query
def rolling_backfill_rows(spark, sf):
    return health_score.rolling_row_interval(activity(spark, sf), REPLACED_FROM, LOADED_TO, 7)


@query
def run_pipeline(spark, sf):
    outcome = pipeline.run(spark, b.raw_tables(spark, sf))
    return outcome.report.withColumn("published", F.lit(outcome.published))


# Data quality.


@query
def expect_unique(spark, sf):
    return x.unique(storage.scan(spark, sf, "events"), "user_id")


@query
def expect_not_null(spark, sf):
    return x.not_null(nutrition_fact(spark, sf), "calories_burned").select("user_id", "date_key")


@query
def expect_accepted_values(spark, sf):
    return x.accepted_values(
        storage.scan(spark, sf, "events").select("event_id", "event_type"),
        "event_type",
        ["click", "view", "purchase"],
    )


@query
def expect_relationships(spark, sf):
    return x.relationships(
        storage.scan(spark, sf, "customer"), "c_custkey", storage.scan(spark, sf, "events"), "user_id"
    )


@query
def expect_accepted_range(spark, sf):
    return x.accepted_range(activity(spark, sf), "steps", 500, 30000, inclusive=False).select(
        "user_id", "activity_date", "steps"
    )


@query
def expect_unique_combination(spark, sf):
    return x.unique_combination(storage.scan(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def expect_positive(spark, sf):
    return x.positive(activity(spark, sf), "sleep_minutes").select(
        "user_id", "activity_date", "sleep_minutes"
    )


def _steps_without_sleep(df: DataFrame, steps: int) -> DataFrame:
    return df.where((F.col("steps") >= steps) & (F.col("sleep_minutes") == 0)).select(
        "user_id", "activity_date", "steps"
    )


if "steps_without_sleep" not in x.CUSTOM:
    x.register("steps_without_sleep", _steps_without_sleep)


@query
def expect_custom(spark, sf):
    return x.CUSTOM["steps_without_sleep"](activity(spark, sf), steps=3000)


@query
def check_experiment_balanced(spark, sf):
    typed = b.events(spark, sf).withColumnRenamed("event_type", "variant")
    return agg.rounded(x.experiment_balanced(typed, 0.2), 6, "share")


@query
def check_one_current(spark, sf):
    """Versions of the history without its newest year: some users have none open."""
    versions = h.scd2_from_spans(spans(spark, sf)).withColumn(
        "is_current", F.col("is_current") & (F.col("valid_from") < F.lit(dt.date(2000, 8, 1)))
    )
    return x.one_current(versions)


@query
def check_sleep_stages(spark, sf):
    """Stages with rem counted twice, so that they exceed the total."""
    doubled = activity(spark, sf).withColumn("sleep_rem_minutes", F.col("sleep_rem_minutes") * 2)
    return x.sleep_stages(doubled)


@query
def check_span_overlap(spark, sf):
    """Versions prolonged by 30 days reach into later ones."""
    versions = h.scd2_from_spans(spans(spark, sf)).withColumn(
        "valid_to",
        F.when(F.col("is_current"), F.col("valid_to")).otherwise(F.date_add("valid_to", 30)),
    )
    return x.no_overlap(versions)


def _missing(days: DataFrame, hours: bool) -> DataFrame:
    """Absent rows of the users in a table, over the days it spans."""
    first = days.agg(F.min("activity_date")).scalar()
    last = days.agg(F.max("activity_date")).scalar()
    return x.missing_grain(days, days.select("user_id"), first, last, hours=hours)


@query
def check_grain_complete(spark, sf):
    return _missing(activity(spark, sf), hours=False)


@query
def check_grain_hours(spark, sf):
    return _missing(b.intraday_hr(spark, sf), hours=True)


@query
def check_schema(spark, sf):
    """Columns the event log lacks to serve as wearable events or activity, with the rows affected."""
    log = storage.scan(spark, sf, "events")
    needed = {"wearable_events": EVENT, "daily_activity": RAW_SCHEMAS["daily_activity"]}
    missing = [(n, c) for n, schema in needed.items() for c in x.has_columns(log, schema.fieldNames())]
    lines = F.array(
        *[F.struct(F.lit(n).alias("table_name"), F.lit(c).alias("column_name")) for n, c in missing]
    )
    return log.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", F.inline(lines))


@query
def check_reconcile_load(spark, sf):
    """Source and loaded counts of a faithful and of an incomplete load."""
    source = _daily_totals(spark, sf)
    partial = _daily_totals(spark, sf, early=True)
    pairs = {"same": source, "incomplete": partial}
    return reshape.union_all(
        *[x.reconcile(source, loaded).withColumn("load", F.lit(n)) for n, loaded in pairs.items()]
    )


@query
def check_reconcile_observed(spark, sf):
    """Rows counted while an incomplete load is written, against the rows of its source."""
    path = storage.shared_dir(spark, "reconcile")
    source, late = _daily_totals(spark, sf), _daily_totals(spark, sf, early=True)
    written = {"same": source, "incomplete": late}
    counts = {name: storage.write_observed(df, f"{path}/{name}") for name, df in written.items()}
    stored = spark.read.parquet(f"{path}/same")
    return reshape.union_all(
        *[x.reconcile_count(stored, n).withColumn("load", F.lit(name)) for name, n in counts.items()]
    )


@query
def dq_report(spark, sf):
    """Checks with findings; the derived tables are stored first, as in the pipeline."""
    derived = {"activity": activity(spark, sf), "users": users(spark, sf), "meals": meals(spark, sf)}
    tables = pipeline.store_all(derived, storage.shared_dir(spark, "report"))
    tables["lines"] = storage.scan(spark, sf, "lineitem")
    return x.run_checks(
        [
            quality.between("activity", "steps", (500, 30000)),
            quality.between("activity", "resting_hr", (25, 90)),
            quality.positive("activity", "sleep_minutes"),
            quality.not_null("activity", "user_id"),
            quality.accepted("meals", "meal_type", ["breakfast", "lunch", "dinner"]),
            quality.accepted("users", "sex", ["M", "F"]),
            quality.unique("meals", "user_id"),
            quality.unique("users", "user_id"),
            quality.unique_combination("lines", "l_orderkey", "l_linenumber"),
            quality.unique_combination("activity", "user_id", "activity_date"),
            quality.related("activity", "user_id", "users", "user_id"),
            quality.related("users", "user_id", "activity", "user_id"),
            x.custom_check("steps_without_sleep", "activity", steps=3000),
        ],
        tables,
    )


# Experiment statistics.


@query
def ab_ztest(spark, sf):
    z = ab.ztest(agg.variant_summary(assignments(spark, sf)))
    return agg.rounded(z, 6, "p_a", "p_b", "effect", "z", "p_value", "ci_low", "ci_high")


@query
def ab_welch(spark, sf):
    t = ab.welch(agg.arm_stats(b.document_lengths(spark, sf), "n_chars"))
    return agg.rounded(
        agg.rounded(t, 2, "mean_a", "mean_b", "variance_a", "variance_b", "effect", "ci_low", "ci_high"),
        5,
        "t",
        "df",
        "p_value",
    )


def _rates(spark, sf):
    return ab.arms_wide(agg.variant_summary(assignments(spark, sf)), "n", "rate").select(
        "experiment_name", "n_a", F.col("rate_a").alias("p_a"), F.col("rate_b").alias("p_b")
    )


@query
def ab_sample_size(spark, sf):
    return _rates(spark, sf).select(
        "experiment_name",
        ab.sample_size(F.col("p_a")).alias("n_default"),
        ab.sample_size(F.col("p_a"), 0.05).alias("n_mde_5"),
        ab.sample_size(F.col("p_a"), 0.05, 0.01, 0.9).alias("n_strict"),
    )


@query
def ab_power(spark, sf):
    p = F.col("p_a")
    at = ab.power(p, p + ab.MDE, F.col("n_a")).alias("achieved_power")
    return agg.rounded(_rates(spark, sf).select("experiment_name", "n_a", at), 6, "achieved_power")


@query
def ab_power_curve(spark, sf):
    curve = ab.power_curve(_rates(spark, sf)).drop("p_a")
    return agg.rounded(curve, 6, "power")


@query
def ab_wald_error(spark, sf):
    return agg.rounded(ab.wald_error(agg.variant_summary(assignments(spark, sf))), 6, "rate", "error")


@query
def ab_decision_report(spark, sf):
    report = ab.ab_report(assignments(spark, sf))
    return agg.rounded(report, 5, *[f.name for f in report.schema if f.dataType == T.DoubleType()])


@query
def ab_assign(spark, sf):
    return ab.assign(users(spark, sf), "template_test", 0.5)


def _device_options(spark, sf):
    """Devices with the number of customers of their region as weight; scales are not worn."""
    customer, nation = storage.scan(spark, sf, "customer"), storage.scan(spark, sf, "nation")
    popular = (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey)
        .groupBy((F.col("n_regionkey") + 1).alias("device_id"))
        .agg(F.count(F.lit(1)).alias("weight"))
    )
    worn = b.dim_device(spark, sf).where(F.col("category") == "wearable")
    return worn.select("device_id").join(popular, "device_id")


@query
def weighted_assign(spark, sf):
    return ab.weighted_assign(
        users(spark, sf), _device_options(spark, sf), "primary_device", option="device_id"
    )


@query
def weighted_assign_within(spark, sf):
    """Women choose among all but the first device; men have no options, and so no device."""
    options = _device_options(spark, sf).where(F.col("device_id") != 1).withColumn("sex", F.lit("F"))
    return ab.weighted_assign(
        users(spark, sf), options, "primary_device", option="device_id", within=["sex"]
    )


# Streaming. Each query runs a stream over the event table to its end.

EVENTS = columns(
    event_id=BIGINT, ts=T.TimestampNTZType(), user_id=BIGINT, event_type=TEXT, value=DOUBLE, props=TEXT
)


def _records(spark, sf):
    """The event table as records of a three-partition topic; event ids serve as offsets."""
    records = ev.to_records(b.wearable_events(spark, sf), "event_id")
    return ev.place(records, "event_id").drop("event_id")


def _landed(spark, sf, label, records=None):
    path = storage.shared_dir(spark, label)
    (_records(spark, sf) if records is None else records).write.parquet(f"{path}/in")
    return path


def _run(spark, path, checkpoint="checkpoint", **options):
    stream = ev.read_files(spark, f"{path}/in", **options)
    return sinks.run_available(
        stream, f"{path}/events", f"{path}/{checkpoint}", f"{path}/errors"
    )


def _stored(spark, path):
    return spark.read.parquet(f"{path}/events").drop(sinks.SPAN)


@query
def stream_source(spark, sf):
    path = storage.shared_dir(spark, "source")
    # As a pattern the path may name a single file or a folder of files.
    stream = ev.read_files(spark, f"{sf}/[e]vents.parquet", EVENTS).select("event_id", "user_id", "event_type")
    (
        stream.writeStream.format("parquet")
        .option("path", f"{path}/out")
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.parquet(f"{path}/out")


@query
def stream_decode(spark, sf):
    return ev.decode(_records(spark, sf))


@query
def stream_event_time(spark, sf):
    return ev.decode(_records(spark, sf)).select(
        "event_id", F.unix_micros(ev.event_time("ts")).alias("event_micros")
    )


@query
def stream_upsert_ignore(spark, sf):
    """Every event sent twice, the second time with another payload; the first one stays."""
    records = _records(spark, sf)
    again = records.withColumn("offset", F.col("offset") + 1_000_000_000).withColumn(
        "value", F.regexp_replace("value", '"heart_rate":[0-9]+', '"heart_rate":1')
    )
    path = _landed(spark, sf, "upsert", records.unionByName(again))
    _run(spark, path)
    return _stored(spark, path)


@query
def stream_random_ids(spark, sf):
    """Two sendings of events with random ids, the second of all events again and of more."""
    scrambled = b.wearable_events(spark, sf).withColumn("event_id", F.xxhash64("event_id"))
    records = ev.place(ev.to_records(scrambled, "event_id"), "event_id").drop("event_id")
    path = storage.shared_dir(spark, "random")
    for part in (F.col("offset") % 3 != 0, F.lit(True)):
        records.where(part).write.mode("append").parquet(f"{path}/in")
        sinks.run_available(
            ev.read_files(spark, f"{path}/in"), f"{path}/events", f"{path}/checkpoint", buckets=32
        )
    return _stored(spark, path).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("events"), F.sum("heart_rate").alias("heart_rate")
    )


@query
def stream_at_least_once(spark, sf):
    """A full replay with a new checkpoint adds nothing."""
    path = _landed(spark, sf, "replay")
    for checkpoint in ("first", "second"):
        _run(spark, path, checkpoint)
    return _stored(spark, path).groupBy("partition").agg(
        F.count(F.lit(1)).alias("events"), F.sum("heart_rate").alias("heart_rate")
    )


@query
def stream_bounded_run(spark, sf):
    """What a bounded run has stored after the first sending, and the next run after all."""
    path, records = storage.shared_dir(spark, "bounded"), _records(spark, sf)
    users = F.col("key").cast("bigint")
    files = []
    for part in (users % 2 == 0, users % 2 == 1):
        records.where(part).write.mode("append").parquet(f"{path}/in")
        files.append(len(spark.read.parquet(f"{path}/in").inputFiles()))
    states = []
    for limit, run in ((1, "bounded"), (None, "rest")):
        # A micro-batch takes the files of the first sending, the older ones, or all others.
        stream = ev.read_files(spark, f"{path}/in", maxFilesPerTrigger=str(files[0]))
        sinks.run_available(stream, f"{path}/events", f"{path}/checkpoint", max_rows=limit)
        counts = _stored(spark, path).groupBy("user_id").agg(F.count(F.lit(1)).alias("events"))
        counts.withColumn("run", F.lit(run)).write.parquet(f"{path}/{run}")
        states.append(spark.read.parquet(f"{path}/{run}"))
    return reshape.union_all(*states)


@query
def stream_publish(spark, sf):
    """Key and JSON value; the value is taken apart again for comparison."""
    value = F.from_json("value", "map<string,string>")
    return ev.to_records(b.wearable_events(spark, sf)).select(
        "key",
        *[value[c].cast("bigint").alias(c) for c in ("event_id", "user_id", "heart_rate", "steps_delta")],
        value["device"].alias("device"),
    )


@query
def stream_partition_key(spark, sf):
    return users(spark, sf).select("user_id", ev.partition_of("user_id").alias("partition"))


@query
def stream_order_audit(spark, sf):
    """Users over several partitions when records are placed by key, and by event type."""
    placed = ev.decode(_records(spark, sf))
    by_type = placed.withColumn("partition", ev.partition_of("device"))
    return reshape.union_all(
        *[
            ev.users_spanning(df).withColumn("placed_by", F.lit(n))
            for n, df in {"key": placed, "device": by_type}.items()
        ]
    )


@query
def stream_partition_spread(spark, sf):
    return ev.partition_spread(ev.decode(_records(spark, sf)))


@query
def stream_offset_gaps(spark, sf):
    return ev.offset_gaps(ev.decode(_records(spark, sf)), width=4096)


@query
def offset_gaps_lines(spark, sf):
    """Line numbers as offsets of their order: both skips and repeats."""
    lines = storage.scan(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return ev.offset_gaps(lines, "l_orderkey", "l_linenumber")


@query
def stream_error_rows(spark, sf):
    """Records cut short, emptied and without a user go to the side table."""
    records = _records(spark, sf)
    kind = F.col("offset") % 10
    damaged = records.withColumn(
        "value",
        F.when(kind == 3, F.substring("value", 1, 20))
        .when(kind == 5, F.lit(None))
        .when(kind == 7, F.regexp_replace("value", '"user_id":[0-9]+,', ""))
        .otherwise(F.col("value")),
    )
    path = _landed(spark, sf, "errors", damaged)
    _run(spark, path)
    stored = _stored(spark, path).select("offset", F.lit("stored").alias("outcome"))
    rejected = spark.read.parquet(f"{path}/errors").select("offset", F.col("reason").alias("outcome"))
    return stored.unionByName(rejected)
