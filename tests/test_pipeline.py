from pyspark.sql import functions as F

from support import plan_of, rows
from wellspark.plans import marts, pipeline
from wellspark.sources import bindings, storage


def test_run_publishes_when_all_checks_pass(spark, sf_dir):
    spark.sql("CREATE DATABASE IF NOT EXISTS health")
    outcome = pipeline.run(spark, bindings.raw_tables(spark, sf_dir), database="health")
    assert outcome.published and outcome.report.count() == 67
    fact = spark.table("health.fct_daily_activity")
    assert rows(fact, "user_id", "date_key") == rows(outcome.tables["fct_daily_activity"], "user_id", "date_key")


def test_run_stops_at_a_failing_check(spark, sf_dir):
    raw = bindings.raw_tables(spark, sf_dir)
    raw["dim_user"] = raw["dim_user"].withColumn("sex", F.when(F.col("user_id") == 1, "?").otherwise(F.col("sex")))
    spark.sql("CREATE DATABASE IF NOT EXISTS held_back")
    outcome = pipeline.run(spark, raw, storage.shared_dir(spark, "bad"), database="held_back")
    assert not outcome.published
    assert rows(outcome.report.where("not passed"), "check_name", "offenders") == [
        ("accepted_values_stg_users_sex", 1)
    ]
    assert spark.sql("SHOW TABLES IN held_back").where("not isTemporary").isEmpty()


def test_scans_read_only_needed_columns(spark, sf_dir):
    plan = plan_of(marts.stage({"daily_activity": bindings.daily_activity(spark, sf_dir)})["stg_daily_activity"])
    assert "props" not in plan and "event_id" not in plan


def test_nutrition_fact_has_no_burn_without_activity(spark, sf_dir):
    staged = marts.stage(bindings.raw_tables(spark, sf_dir))
    fact = marts.build_marts(staged)["fct_nutrition"]
    alone = fact.where("calories_burned is null")
    assert alone.count() > 0 and alone.where("calorie_balance is not null").isEmpty()
