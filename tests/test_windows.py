"""The split windows against plain Python, on histories cut into very short stretches."""

import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest

from support import plan_of, rows
from wellspark.operators import metrics, windows
from wellspark.plans import health_score

START = dt.date(2024, 1, 1)


def histories(seed, users=6, days=90, nulls=True):
    """Per user a random set of days with scores; user 0 holds most rows, user 5 one day."""
    rng = random.Random(seed)
    out = []
    for user in range(users):
        share = 1.0 if user == 0 else rng.choice([0.1, 0.5, 0.9])
        for day in range(days):
            if (user == 5 and day == 40) or (user != 5 and rng.random() < share):
                score = None if nulls and rng.random() < 0.1 else round(rng.uniform(0, 100), 2)
                out.append((user, START + dt.timedelta(day), score))
    rng.shuffle(out)
    return out


def frame(spark, data):
    return spark.createDataFrame(data, "user_id int, activity_date date, daily_score double")


def mean(values):
    known = [Decimal(str(v)) for v in values if v is not None]
    if not known:
        return None, 0
    exact = sum(known) / len(known)
    return float(exact.quantize(Decimal("0.01"), ROUND_HALF_UP)), len(known)


def brute(data, pick):
    out = []
    for user in {u for u, _, _ in data}:
        mine = sorted((d, v) for u, d, v in data if u == user)
        for i, (day, value) in enumerate(mine):
            out.append((user, day, value, *mean(pick(mine, i, day))))
    return sorted(out, key=repr)


# Daily grain, and histories cut into stretches of so many days.
WIDTHS = [None, 1, 7, 10, 366]


@pytest.mark.parametrize("width", WIDTHS)
@pytest.mark.parametrize("n", [1, 7, 30])
def test_row_frames_equal_brute_force(spark, n, width):
    data = histories(n)
    got = rows(windows.rolling_score(frame(spark, data), n, width=width))
    assert got == brute(data, lambda mine, i, day: [v for _, v in mine[max(0, i - n + 1) : i + 1]])


@pytest.mark.parametrize("width", [1, 4, 366])
@pytest.mark.parametrize("n", [1, 7, 30])
def test_calendar_frames_equal_brute_force(spark, n, width):
    data = histories(n + 50)
    got = rows(windows.rolling_score_days(frame(spark, data), n, width=width))
    low = dt.timedelta(n - 1)
    assert got == brute(data, lambda mine, i, day: [v for d, v in mine if day - low <= d <= day])


def test_repeated_days_do_not_depend_on_the_split(spark):
    rng = random.Random(1)
    data = [(1, START + dt.timedelta(rng.randrange(20)), float(rng.randrange(100))) for _ in range(80)]
    plain = rows(windows.rolling_score(frame(spark, data), 7))
    for width in (1, 3):
        assert rows(windows.rolling_score(frame(spark, data), 7, width=width)) == plain


def test_dates_before_the_epoch(spark):
    data = [(1, dt.date(1969, 12, 30) + dt.timedelta(i), float(i)) for i in range(5)]
    for width in (None, 2, 3, 366):
        got = rows(windows.rolling_score(frame(spark, data), 2, width=width), "rolling_2d_score")
        assert got == [(0.0,), (0.5,), (1.5,), (2.5,), (3.5,)]


def test_row_and_calendar_frames_differ_after_a_gap(spark):
    days = [i for i in range(35) if i != 20]
    data = frame(spark, [(1, START + dt.timedelta(i), 50.0) for i in days])
    by_row = {r["activity_date"]: r["days_in_window"] for r in windows.rolling_score(data).collect()}
    by_day = {r["activity_date"]: r["days_in_window"] for r in windows.rolling_score_days(data).collect()}
    last = START + dt.timedelta(34)
    assert (by_row[last], by_day[last]) == (30, 29)


def test_window_fills_to_thirty(spark):
    data = frame(spark, [(1, START + dt.timedelta(i), 50.0) for i in range(35)])
    for width in (None, 8, 366):
        counts = rows(windows.rolling_score(data, width=width), "days_in_window")
        assert sorted(c for (c,) in counts) == [*range(1, 31), *[30] * 5]


@pytest.mark.parametrize("width", WIDTHS)
def test_running_sum(spark, width):
    data = histories(3)
    cents = frame(spark, data).selectExpr("user_id", "activity_date", "cast(daily_score as decimal(8,2)) v")
    got = rows(
        windows.running_sum(cents, "user_id", "activity_date", "v", "total", width),
        "user_id",
        "activity_date",
        "total",
    )
    expected = []
    for user in {u for u, _, _ in data}:
        total = None
        for day, value in sorted((d, v) for u, d, v in data if u == user):
            if value is not None:
                total = (total or Decimal(0)) + Decimal(str(value))
            expected.append((user, day, total))
    assert sorted(got, key=lambda r: r[:2]) == sorted(expected, key=lambda r: r[:2])


@pytest.mark.parametrize("forward", [True, False])
@pytest.mark.parametrize("width", WIDTHS)
def test_neighbour(spark, forward, width):
    data = histories(9)
    got = rows(
        windows.neighbour(frame(spark, data).drop("daily_score"), ["user_id"], "activity_date", "other", forward, width)
    )
    expected = []
    for user in {u for u, _, _ in data}:
        days = sorted(d for u, d, _ in data if u == user)
        others = [*days[1:], None] if forward else [None, *days[:-1]]
        expected += [(user, d, o) for d, o in zip(days, others)]
    assert got == sorted(expected, key=repr)


def test_neighbour_of_large_numbers(spark):
    big = 2**60
    df = spark.createDataFrame([(1, big), (1, big + 1), (1, big + 5)], "p int, o bigint")
    got = rows(windows.neighbour(df, ["p"], "o", "before", False, 2), "o", "before")
    assert got == [(big, None), (big + 1, big), (big + 5, big + 1)]


def test_group_statistics(spark):
    df = spark.createDataFrame(
        [(1, START, 2), (1, START + dt.timedelta(3), 4), (1, START + dt.timedelta(7), 6), (2, START, 0)],
        "user_id int, d date, v int",
    )
    z = rows(windows.zscore(df, "user_id", "v", "z"), "user_id", "v", "z")
    assert [round(v, 3) for *_, v in z] == [-1.225, 0.0, 1.225, 0.0]
    assert rows(windows.relative_to_peak(df, "user_id", "v", "r"), "v", "r") == [
        (0, 0.0),
        (2, 1 / 3),
        (4, 2 / 3),
        (6, 1.0),
    ]
    assert len(rows(windows.downsample(df, "user_id", "d", 7))) == 3


def test_latest_by_settles_ties_the_same_way(spark):
    spans = [(1, "free", "x", START), (1, "pro", "x", START), (2, "plus", "y", START)]
    schema = "user_id int, tier string, company string, since date"
    for data in (spans, spans[::-1]):
        latest = windows.latest_by(spark.createDataFrame(data, schema), "user_id", "since")
        assert rows(latest) == [(1, "pro", "x", START), (2, "plus", "y", START)]


def test_flagship_on_stored_tables(spark, tmp_path):
    """Three users, one unknown to the dimension, against the score computed by hand."""
    rng = random.Random(21)
    days = []
    for user, n in ((3, 41), (5, 12), (8, 3)):
        for i in range(n):
            days.append((user, START + dt.timedelta(2 * i), rng.randrange(12_000), rng.randrange(300, 600), 50.0 + i))
    schema = "user_id bigint, activity_date date, steps bigint, sleep_minutes bigint, resting_hr double"
    spark.createDataFrame(days, schema).write.parquet(f"{tmp_path}/daily_activity.parquet")
    people = [(3, "F", 52, "PT"), (5, "M", 23, "NO")]
    person = "user_id bigint, sex string, age bigint, country string"
    spark.createDataFrame(people, person).write.parquet(f"{tmp_path}/dim_user.parquet")
    scores = health_score.compute(spark, str(tmp_path))

    def score(steps, sleep, heart):
        marks = (min(steps / 1e4, 1), max(1 - abs(sleep - 450) / 450, 0), max(min((90 - heart) / 35, 1), 0))
        return round((0.4 * marks[0] + 0.3 * marks[1] + 0.3 * marks[2]) * 100, 2)

    daily = [(u, d, score(*rest)) for u, d, *rest in days]
    expected = brute(daily, lambda mine, i, day: [v for _, v in mine[max(0, i - 29) : i + 1]])
    columns = ("user_id", "activity_date", "daily_score", "rolling_30d_score", "days_in_window")
    assert rows(scores, *columns) == expected
    assert set(rows(scores, "user_id", "sex", "age", "country")) == {*people, (8, None, None, None)}
    assert plan_of(scores).count("FileScan parquet") == 2


def test_daily_grain_reads_and_shuffles_once(spark, tmp_path):
    frame(spark, histories(22)).write.parquet(f"{tmp_path}/d")
    stored = spark.read.parquet(f"{tmp_path}/d")
    for df in (
        windows.rolling_score(stored),
        windows.running_sum(stored, "user_id", "activity_date", "daily_score", "total"),
        windows.neighbour(stored, ["user_id"], "activity_date", "next"),
    ):
        plan = plan_of(df)
        assert plan.count("FileScan parquet") == 1
        assert plan.count("Exchange ") == 1
        assert "BroadcastExchange" not in plan


def test_backfill_reads_only_the_days_it_needs(spark, tmp_path):
    data = [(1, START + dt.timedelta(i), 1000 * i, 400, 60.0) for i in range(60)]
    schema = "user_id int, activity_date date, steps int, sleep_minutes int, resting_hr double"
    spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/a")
    stored = spark.read.parquet(f"{tmp_path}/a")
    start, end = START + dt.timedelta(40), START + dt.timedelta(45)
    part = health_score.rolling_interval(stored, start, end)
    whole = health_score.rolling_calendar_score(stored).where(f"activity_date between '{start}' and '{end}'")
    assert rows(part) == rows(whole)
    assert "GreaterThanOrEqual(activity_date,2024-01-12)" in plan_of(part)


def test_row_backfill_reaches_over_missing_days(spark):
    rng = random.Random(8)
    data = [
        (u, START + dt.timedelta(i), rng.randrange(20000), 400, 60.0)
        for u in range(4)
        for i in range(60)
        if rng.random() < (0.2 if u else 1.0)
    ]
    schema = "user_id int, activity_date date, steps int, sleep_minutes int, resting_hr double"
    days = spark.createDataFrame(data, schema)
    start, end = START + dt.timedelta(40), START + dt.timedelta(50)
    part = health_score.rolling_row_interval(days, start, end, 7)
    scored = metrics.daily_subscore(days).select("user_id", "activity_date", "daily_score")
    whole = windows.rolling_score(scored, 7).where(f"activity_date between '{start}' and '{end}'")
    assert rows(part) == rows(whole)
    assert "WindowGroupLimit" in plan_of(part)


def test_stretches_bound_every_group(spark):
    """A third of all rows at one user: no group of the window exceeds a stretch."""
    df = spark.range(9000).selectExpr("if(id % 3 = 0, -1, id % 600) as user_id", "id as pos")
    groups = windows.split_history(df, "pos", width=300).groupBy("user_id", windows.STRETCH).count()
    assert groups.agg({"count": "max"}).first()[0] <= 100
    assert groups.where("user_id = -1").count() == 30
