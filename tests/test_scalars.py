import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from wellspark.functions import scalars as s
from wellspark.operators import metrics

DAY = dt.date(2025, 1, 2)


def one(spark, column, **values):
    fields = [F.lit(v).alias(n) for n, v in values.items()] or [F.lit(1).alias("x")]
    return spark.range(1).select(*fields).select(column.alias("v")).first()["v"]


def activity(spark, *rows):
    return spark.createDataFrame(
        [(1, DAY, *r) for r in rows],
        "user_id int, activity_date date, steps int, sleep_minutes int, resting_hr double",
    )


@pytest.mark.parametrize(
    ("row", "score"),
    [
        ((12000, 450, 50.0), 100.0),
        ((500, 200, 95.0), 15.33),
        ((None, 450, 50.0), 100.0),  # unknown steps earn full marks
        ((12000, 450, None), 100.0),
        ((12000, None, 50.0), 70.0),  # unknown sleep earns none
        ((-1000, 450, 50.0), 56.0),  # steps have no floor
        ((0, 900, 90.0), 0.0),
    ],
)
def test_daily_subscore(spark, row, score):
    assert metrics.daily_subscore(activity(spark, row)).first()["daily_score"] == score


def test_daily_subscore_propagates_nulls_on_request(spark):
    scored = metrics.daily_subscore(activity(spark, (None, 450, 50.0), (12000, 450, 50.0)), "propagate")
    assert [r["daily_score"] for r in scored.collect()] == [None, 100.0]
    with pytest.raises(ValueError):
        s.subscore("guess")


def test_date_key(spark):
    assert one(spark, s.date_key(F.lit(DAY))) == 20250102


def test_safe_ratio_rounds_half_up_and_skips_zero(spark):
    assert one(spark, s.safe_ratio("a", "b", 3), a=1, b=16) == Decimal("0.063")
    assert one(spark, s.safe_ratio("a", "b", 3), a=1, b=0) is None


@pytest.mark.parametrize(("steps", "met"), [(10000, True), (9999, False), (None, False)])
def test_step_goal(spark, steps, met):
    assert one(spark, s.step_goal(F.lit(steps).cast("int"))) is met


@pytest.mark.parametrize(("value", "clipped"), [(-1, 0.0), (3, 3.0), (9, 5.0), (None, None)])
def test_clip_keeps_null(spark, value, clipped):
    assert one(spark, s.clip(F.lit(value).cast("double"), 0.0, 5.0)) == clipped


def test_weekend(spark):
    days = [dt.date(2025, 1, d) for d in (3, 4, 5, 6)]
    assert [one(spark, s.is_weekend(F.lit(d))) for d in days] == [False, True, True, False]


def test_surrogate_key_marks_nulls(spark):
    import hashlib

    key = one(spark, s.surrogate_key([F.lit(7), F.lit(DAY)]))
    assert key == hashlib.md5(b"7-2025-01-02").hexdigest()
    missing = one(spark, s.surrogate_key([F.lit(7), F.lit(None).cast("date")]))
    assert missing == hashlib.md5(b"7-_dbt_utils_surrogate_key_null_").hexdigest()


def test_exact_mean_ignores_order_and_empty_groups(spark):
    mean = s.exact_mean(F.lit(Decimal("0.25")), F.lit(2), 2)
    assert one(spark, mean) == 0.13
    assert one(spark, s.exact_mean(F.lit(Decimal("0.25")), F.lit(0), 2)) is None


def test_body_formulas(spark):
    users = spark.createDataFrame([(1, "M", 40, Decimal("180.0"))], "user_id int, sex string, age int, height_cm decimal(5,1)")
    scans = spark.createDataFrame(
        [(1, DAY, Decimal("81.0"), Decimal("20.0"))],
        "user_id int, scan_date date, weight_kg decimal(6,1), body_fat_pct decimal(4,1)",
    )
    body = metrics.body_metrics(scans, users).first()
    assert (body["bmi"], body["fat_mass_kg"], body["fat_free_mass_kg"]) == (
        Decimal("25.0"),
        Decimal("16.20"),
        Decimal("64.80"),
    )
    days = spark.createDataFrame(
        [(1, dt.date(2025, 1, 1), 10000, 30), (1, dt.date(2025, 1, 9), 10000, 30)],
        "user_id int, activity_date date, steps int, active_minutes int",
    )
    burn = {r["activity_date"].day: r for r in metrics.expected_burn(days, users, scans).collect()}
    assert burn[1]["expected_kcal"] is None  # before the first scan
    assert burn[9]["bmr_kcal"] == Decimal("1740.00")  # 810 + 1125 - 200 + 5
    assert burn[9]["expected_kcal"] == Decimal("2260.00")
    fat = metrics.body_fat_estimate(
        spark.createDataFrame([("M", 40, Decimal("25.0")), ("F", 64, Decimal("38.0"))], "sex string, age int, bmi decimal(4,1)")
    )
    assert sorted(float(r["body_fat_estimate"]) for r in fat.collect()) == [23.0, 54.9]


def test_macro_shares(spark):
    daily = spark.createDataFrame(
        [(1, DAY, Decimal("50.0"), Decimal("50.0"), Decimal("0.0")), (2, DAY, *[Decimal("0.0")] * 3)],
        "user_id int, log_date date, protein_g decimal(6,1), carbs_g decimal(6,1), fat_g decimal(6,1)",
    )
    shares = {r["user_id"]: r for r in metrics.macro_shares(daily).collect()}
    assert shares[1]["protein_share"] == Decimal("0.5")
    assert shares[2]["protein_share"] is None
