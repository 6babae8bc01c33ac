import datetime as dt
import os
import random

from support import plan_of, rows
from wellspark.operators import metrics, windows
from wellspark.plans import late
from wellspark.sources import storage

START = dt.date(2023, 1, 1)
DAYS = 300
SCHEMA = "user_id int, activity_date date, steps int, sleep_minutes int, resting_hr double"


def made(rng, users=12):
    """Some users daily, some with long gaps, some who begin late or end early."""
    out = []
    for user in range(users):
        first, last = (0, DAYS) if user % 3 else (rng.randrange(60, 140), rng.randrange(160, DAYS))
        chance = 1.0 if user % 2 else 0.4
        for i in range(first, last):
            if rng.random() < chance:
                out.append((user, START + dt.timedelta(i), rng.randrange(20_000), rng.choice([None, 400, 480]), 60.0))
    return out


def scores(df, n):
    return windows.rolling_score(metrics.daily_subscore(df).select("user_id", "activity_date", "daily_score"), n)


def stored(spark, tmp_path, df, n):
    paths = f"{tmp_path}/facts", f"{tmp_path}/scores"
    storage.write_fact(df, paths[0], "activity_date")
    storage.write_fact(scores(df, n), paths[1], "activity_date")
    return paths


def files(path):
    return {d: sorted(names) for d, _, names in os.walk(path) if "=" in d}


def test_late_rows_reach_what_a_full_run_gives(spark, tmp_path):
    rng, n = random.Random(2), 10
    data = made(rng)
    late_rows = [r for r in data if r[0] in (1, 2, 3, 5) and 150 <= (r[1] - START).days < 156]
    early = spark.createDataFrame([r for r in data if r not in late_rows], SCHEMA)
    paths = stored(spark, tmp_path, early, n)
    before = files(paths[1])
    # One late row corrects a stored one.
    fixed = next(r for r in data if r[0] == 7 and (r[1] - START).days == 152)
    fixed = (*fixed[:2], 1, *fixed[3:])
    batch = spark.createDataFrame([*late_rows, fixed], SCHEMA)
    whole = [r if r[:2] != fixed[:2] else fixed for r in data]
    columns = ("user_id", "activity_date", "daily_score", f"rolling_{n}d_score", "days_in_window")
    wanted = rows(scores(spark.createDataFrame(whole, SCHEMA), n), *columns)
    for _ in range(2):  # a repetition changes nothing
        reach = late.apply_late(spark, *paths, batch, n)
        assert rows(spark.read.parquet(paths[1]), *columns) == wanted
    changed = {d for d, names in files(paths[1]).items() if before.get(d) != names}
    assert 6 <= len(changed) < 60 and reach.days <= DAYS


def test_days_read_follow_the_frames(spark, tmp_path):
    """Daily users need a frame on either side, sparse ones more, and only these days are read."""
    daily = [(u, START + dt.timedelta(i), 1000, 400, 60.0) for u in (1, 2) for i in range(DAYS)]
    sparse = [(3, START + dt.timedelta(i), 1000, 400, 60.0) for i in range(0, DAYS, 7)]
    path = f"{tmp_path}/facts"
    storage.write_fact(spark.createDataFrame(daily + sparse, SCHEMA), path, "activity_date")
    facts = spark.read.parquet(path)
    at = START + dt.timedelta(147)

    def keys(*users):
        return spark.createDataFrame([(u, at) for u in users], "user_id int, activity_date date")

    assert late.reach_of(facts, keys(1), 10) == late.Reach(at - dt.timedelta(10), at + dt.timedelta(10))
    assert late.reach_of(facts, keys(1, 3), 10) == late.Reach(at - dt.timedelta(80), at + dt.timedelta(80))
    assert late.reach_of(facts, keys(1).limit(0), 10) is None
    reach = late.reach_of(facts, keys(1), 10)
    out = late.reached_scores(facts, keys(1), reach, 10)
    assert rows(out, "activity_date") == [(at + dt.timedelta(i),) for i in range(10)]
    plan = plan_of(out)
    assert "PartitionFilters: [isnotnull(activity_date" in plan and plan.count("FileScan") == 1
    # Near the table's ends, and for a user's first day, the search stops there.
    ends = spark.createDataFrame([(2, START), (1, START + dt.timedelta(DAYS - 1))], "user_id int, activity_date date")
    assert late.reach_of(facts, ends, 10) == late.Reach(START, START + dt.timedelta(DAYS - 1))
