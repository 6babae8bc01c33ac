import datetime as dt
import os
import random
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from support import plan_of, rows
from wellspark.operators import history, joins, reshape
from wellspark.operators import expectations as x
from wellspark.plans import marts

D = dt.date
SPANS = "user_id int, membership_tier string, company string, effective_from date"
OPEN = D(9999, 12, 31)


def spans(spark, *data):
    return spark.createDataFrame(data, SPANS)


def test_versions_from_spans(spark):
    versions = history.scd2_from_spans(
        spans(
            spark,
            (2, "pro", "x", D(2025, 11, 14)),
            (2, "free", "x", D(2024, 7, 10)),
            (2, "plus", "x", D(2024, 12, 27)),
        )
    )
    assert sorted(rows(versions, "valid_from", "valid_to", "is_current")) == [
        (D(2024, 7, 10), D(2024, 12, 26), False),
        (D(2024, 12, 27), D(2025, 11, 13), False),
        (D(2025, 11, 14), OPEN, True),
    ]
    assert x.one_current(versions).isEmpty() and x.no_overlap(versions).isEmpty()
    assert x.unique(versions, "user_version_key").isEmpty()


def test_versions_far_apart(spark):
    versions = history.scd2_from_spans(
        spans(spark, (1, "a", "x", D(1950, 1, 1)), (1, "b", "x", D(1999, 5, 5)), (1, "c", "x", D(2024, 1, 1)))
    )
    assert rows(versions, "valid_to") == [(D(1999, 5, 4),), (D(2023, 12, 31),), (OPEN,)]


def test_as_of_join_keeps_unmatched_facts(spark):
    versions = history.scd2_from_spans(spans(spark, (1, "free", "x", D(2024, 2, 1)), (1, "pro", "x", D(2024, 3, 1))))
    facts = spark.createDataFrame(
        [(1, D(2024, 1, 31), "early"), (1, D(2024, 2, 1), "first"), (1, D(2024, 2, 29), "last"),
         (1, D(2024, 3, 1), "next"), (9, D(2024, 3, 1), "stranger"), (1, None, "undated")],
        "user_id int, day date, note string",
    )
    for width in (None, 1, 366):
        joined = joins.as_of_join(facts, versions, "day", width=width)
        assert rows(joined, "note", "membership_tier") == [
            ("early", None),
            ("first", "free"),
            ("last", "free"),
            ("next", "pro"),
            ("stranger", None),
            ("undated", None),
        ]


@pytest.mark.parametrize("width", [None, 1, 7, 366])
def test_as_of_join_equals_range_join_under_skew(spark, width):
    """One user holds most facts; bounded versions leave gaps; the answer is the range join's."""
    rng = random.Random(4)
    day = lambda n: D(2024, 1, 1) + dt.timedelta(n)
    facts = [(0 if rng.random() < 0.6 else rng.randrange(1, 8), day(rng.randrange(200)), i) for i in range(900)]
    versions = []
    for user in range(6):
        start = 10 * user
        while start < 180:
            length = rng.randrange(1, 30)
            versions.append((user, f"t{start}", day(start), day(start + length - 1)))
            start += length + rng.randrange(0, 5)
    fact = spark.createDataFrame(facts, "user_id int, day date, id int")
    dim = spark.createDataFrame(versions, "user_id int, tier string, valid_from date, valid_to date")
    got = rows(joins.as_of_join(fact, dim, "day", width=width), "id", "tier")
    expected = [
        (i, next((t for u, t, a, b in versions if u == user and a <= at <= b), None)) for user, at, i in facts
    ]
    assert got == sorted(expected, key=repr)


def test_as_of_join_reads_each_side_once(spark, tmp_path):
    """One scan of the facts and one of the versions, and a long version is one row."""
    facts = [(u, D(2020, 1, 1) + dt.timedelta(97 * i), i) for u in range(3) for i in range(40)]
    held = [(0, "ever", D(1900, 1, 1), OPEN), (1, "old", D(2020, 5, 1), D(2024, 5, 1)), (1, "new", D(2025, 1, 1), OPEN)]
    spark.createDataFrame(facts, "user_id int, day date, id int").write.parquet(f"{tmp_path}/f")
    spark.createDataFrame(held, "user_id int, tier string, valid_from date, valid_to date").write.parquet(f"{tmp_path}/v")
    fact, dim = spark.read.parquet(f"{tmp_path}/f"), spark.read.parquet(f"{tmp_path}/v")
    wanted = [
        (u, i, next((t for k, t, a, b in held if k == u and a <= day <= b), None)) for u, day, i in facts
    ]
    for width in (None, 30):
        joined = joins.as_of_join(fact, dim, "day", width=width)
        assert rows(joined, "user_id", "id", "tier") == sorted(wanted, key=repr)
        final = plan_of(joined.collect() and joined).split("Initial Plan")[0]
        assert len(re.findall("FileScan", final)) == 2
        assert "Generate" not in final and "NestedLoop" not in final and "Cartesian" not in final
        # What is dealt out are facts and versions, a row each.
        plan = joined._jdf.queryExecution().optimizedPlan().toString().lower()
        assert "explode" not in plan and "sequence" not in plan


SNAP = "user_id int, membership_tier string, company string"


def test_snapshot_opens_closes_and_keeps(spark):
    first = spark.createDataFrame(
        [(1, "free", "x"), (2, "free", "x"), (3, "pro", None), (5, None, "x")], SNAP
    )
    held = history.scd2_merge(None, first, "user_id", ["membership_tier", "company"], D(2024, 1, 1))
    second = spark.createDataFrame(
        [(1, "free", "x"), (2, "plus", "x"), (4, "free", "y"), (5, None, "x")], SNAP
    )
    merged = history.scd2_merge(held, second, "user_id", ["membership_tier", "company"], D(2024, 2, 1))
    one, two = D(2024, 1, 1), D(2024, 2, 1)
    expected = [
        (1, "free", "x", one, None),  # unchanged
        (2, "free", "x", one, two),  # closed
        (2, "plus", "x", two, None),  # and opened
        (3, "pro", None, one, None),  # vanished: stays open
        (4, "free", "y", two, None),  # new
        (5, None, "x", one, None),  # nulls compare equal
    ]
    assert rows(merged) == sorted(expected, key=repr)
    again = history.scd2_merge(merged, second, "user_id", ["membership_tier", "company"], D(2024, 3, 1))
    assert rows(again) == rows(merged)


def test_dim_user_takes_the_newest_span(spark):
    users = spark.createDataFrame(
        [(1, "Ann", "F", 30, 170.0, "US", 1, D(2024, 1, 1)), (2, "Bo", "M", 31, 180.0, "SE", 2, D(2024, 1, 1))],
        "user_id int, full_name string, sex string, age int, height_cm double, country string, "
        "primary_device_id int, signup_date date",
    )
    dim = marts.dim_user(users, spans(spark, (1, "free", "x", D(2024, 1, 1)), (1, "pro", "x", D(2024, 5, 1))))
    assert rows(dim, "user_id", "membership_tier", "tier_effective_from") == [
        (1, "pro", D(2024, 5, 1)),
        (2, None, None),
    ]


def test_table_diff_counts_duplicates(spark):
    before = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (2, None), (3, "c")], "k int, v string")
    after = spark.createDataFrame([(1, "a"), (2, None), (4, "d")], "k int, v string")
    assert rows(reshape.table_diff(before, after)) == [
        ("after", 4, "d"),
        ("before", 1, "a"),
        ("before", 1, "a"),
        ("before", 3, "c"),
    ]
    assert reshape.table_diff(before, before).isEmpty()


def test_spine_and_date_dimension(spark):
    spine = reshape.date_spine(spark, D(2025, 12, 31), 18)
    assert (spine.count(), spine.agg({"date_day": "min"}).first()[0]) == (540, D(2024, 7, 10))
    week = reshape.dim_date(spark, D(2025, 1, 3), D(2025, 1, 6))
    assert rows(week) == [
        (20250103, D(2025, 1, 3), False),
        (20250104, D(2025, 1, 4), True),
        (20250105, D(2025, 1, 5), True),
        (20250106, D(2025, 1, 6), False),
    ]


def test_hours_to_long_and_back(spark):
    intraday = spark.createDataFrame(
        [(1, D(2024, 1, 1), 3, 60), (1, D(2024, 1, 1), 7, 90), (1, D(2024, 1, 1), 9, 90)],
        "user_id int, activity_date date, hour int, heart_rate int",
    )
    grid = reshape.hourly_grid(intraday, ["user_id", "activity_date"], "hour", "heart_rate")
    long = reshape.to_long(grid, "hourly", "hour", "heart_rate")
    assert long.count() == 24
    assert rows(long.where("heart_rate is not null")) == rows(intraday)
    summary = reshape.hr_daily(intraday).first()
    assert (summary["min_hr"], summary["avg_hr"], summary["max_hr"], summary["peak_hour"]) == (60, 80.0, 90, 7)


VERSION = ("k", "v", "valid_from", "valid_to")


def snapshot_run(spark, path, state, day, **options):
    current = spark.createDataFrame(state, "k int, v string")
    history.apply_snapshot(spark, path, current, "k", ["v"], dt.date(2024, 1, day), **options)


def version_rows(path):
    """Rows in the files of all runs of a snapshot, finished or not."""
    files = [f"{d}/{n}" for d, _, names in os.walk(path) for n in names if n.endswith(".parquet")]
    return sum(pq.read_metadata(f).num_rows for f in files)


@pytest.mark.parametrize("compact_after", [0, 1, 16])
def test_stored_snapshot_equals_merging_all_versions(spark, tmp_path, compact_after):
    """Runs add what they change; repeated runs change nothing."""
    states = [
        [(1, "a"), (2, "b"), (3, None)],
        [(1, "a"), (2, "c"), (4, "d")],
        [(1, "x"), (3, "y"), (4, "d")],
        [(1, "a"), (2, "c")],
        [(1, "b")],
    ]
    merged, path = None, f"{tmp_path}/s"
    for i, state in enumerate(states):
        current = spark.createDataFrame(state, "k int, v string")
        merged = history.scd2_merge(merged, current, "k", ["v"], dt.date(2024, 1, 1 + i))
        for _ in range(1 + (i in (1, 3))):
            snapshot_run(spark, path, state, 1 + i, compact_after=compact_after)
            assert rows(history.snapshot(spark, path), *VERSION) == rows(merged, *VERSION)
    history.tidy_snapshot(spark, path)
    assert rows(history.snapshot(spark, path), *VERSION) == rows(merged, *VERSION)
    with pytest.raises(ValueError, match="already"):
        snapshot_run(spark, path, states[0], 2)


def test_snapshot_run_without_changes_writes_no_versions(spark, tmp_path):
    path = f"{tmp_path}/s"
    state = [(i, f"v{i}") for i in range(50)]
    snapshot_run(spark, path, state, 1)
    assert version_rows(path) == 50
    for day in (2, 3):
        snapshot_run(spark, path, state[:40], day)  # vanished keys stay open
        assert version_rows(path) == 50
    snapshot_run(spark, path, [(0, "new"), *state[1:], (99, "v99")], 4)
    assert version_rows(path) == 53  # one closed, two opened
    assert not [n for n in os.listdir(path) if "stage" in n]


def test_snapshot_survives_a_crash_at_every_step(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/s"
    states = [[(1, "a"), (2, "b")], [(1, "x"), (2, "b"), (3, "c")]]
    snapshot_run(spark, path, states[0], 1)
    before = rows(history.snapshot(spark, path))

    def crash(*_):
        raise OSError("lost")

    # While changes are compared and written.
    broken = spark.createDataFrame(states[1], "k int, v string").withColumn(
        "v", F.when(F.col("k") == 3, F.raise_error(F.lit("lost")).cast("string")).otherwise(F.col("v"))
    )
    with pytest.raises(Exception, match="lost"):
        history.apply_snapshot(spark, path, broken, "k", ["v"], dt.date(2024, 1, 2))
    assert rows(history.snapshot(spark, path)) == before
    # After the changes, where a new base is made; then before the log names the run.
    real, calls = history._open_versions, []

    def second_fails(*args):
        calls.append(args)
        return real(*args) if len(calls) == 1 else crash()

    for module, name, fake in ((history, "_open_versions", second_fails), (history.versions, "commit", crash)):
        with monkeypatch.context() as patched:
            patched.setattr(module, name, fake)
            with pytest.raises(OSError, match="lost"):
                snapshot_run(spark, path, states[1], 2, compact_after=0 if module is history else 16)
        assert rows(history.snapshot(spark, path)) == before
    snapshot_run(spark, path, states[1], 2)
    current = [spark.createDataFrame(s, "k int, v string") for s in states]
    merged = history.scd2_merge(None, current[0], "k", ["v"], dt.date(2024, 1, 1))
    merged = history.scd2_merge(merged, current[1], "k", ["v"], dt.date(2024, 1, 2))
    assert rows(history.snapshot(spark, path), *VERSION) == rows(merged, *VERSION)
    assert len(history.tidy_snapshot(spark, path)) >= 2
    assert rows(history.snapshot(spark, path), *VERSION) == rows(merged, *VERSION)


def test_as_of_join_settles_ties_by_the_other_columns(spark):
    fact = spark.createDataFrame([(1, dt.date(2024, 2, 1))], "user_id int, day date")
    scans = [(1, dt.date(2024, 1, 5), 70.0), (1, dt.date(2024, 1, 5), 80.0), (1, dt.date(2024, 3, 1), 60.0)]
    for order in (scans, scans[::-1]):
        dim = spark.createDataFrame(order, "user_id int, since date, weight double").coalesce(1)
        joined = joins.as_of_join(fact, dim, "day", start="since", end=None)
        assert rows(joined, "weight") == [(80.0,)]
