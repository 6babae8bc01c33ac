import datetime as dt

import pytest
from pyspark.sql import functions as F

from support import plan_of, rows
from wellspark.operators import expectations as x
from wellspark.plans import quality
from wellspark.plans.quality import standing_checks

D = dt.date


@pytest.fixture
def people(spark):
    data = [(1, "M", 10), (2, "F", 0), (2, "X", -5), (None, None, None), (None, "M", 99)]
    return spark.createDataFrame(data, "id int, sex string, v int")


def test_unique_and_not_null(people):
    assert rows(x.unique(people, "id")) == [(2, 2)]
    assert x.not_null(people, "id").count() == 2
    assert x.unique(people.where("id = 1"), "id").isEmpty()
    assert x.not_null(people.where("id = 1"), "id").isEmpty()


def test_values_ranges_and_sign(people):
    assert rows(x.accepted_values(people, "sex", ["M", "F"]), "sex") == [("X",)]
    assert rows(x.accepted_range(people, "v", 0, 10), "v") == [(-5,), (99,)]
    assert rows(x.accepted_range(people, "v", 0, 10, inclusive=False), "v") == [(-5,), (0,), (10,), (99,)]
    assert rows(x.accepted_range(people, "v", low=0), "v") == [(-5,)]
    assert rows(x.positive(people, "v"), "v") == [(-5,), (0,)]
    with pytest.raises(ValueError):
        x.out_of_range("v")


def test_composite_keys_group_nulls(people):
    doubled = people.unionByName(people.where("id is null and sex is null"))
    assert rows(x.unique_combination(doubled, ["id", "sex"])) == [(None, None, 2)]


def test_relationships_ignore_nulls(spark, people):
    parent = spark.createDataFrame([(1,), (None,)], "pid int")
    assert rows(x.relationships(people, "id", parent, "pid")) == [(2, 2)]
    assert x.relationships(people, "id", people, "id").isEmpty()


def test_experiment_balance(spark):
    arms = spark.createDataFrame([("A",)] * 34 + [("B",)] * 66, "variant string")
    assert rows(x.experiment_balanced(arms)) == [("A", 34, 100, 0.34)]
    assert x.experiment_balanced(arms, 0.34).isEmpty()
    assert "Cartesian" not in plan_of(x.experiment_balanced(arms))


def test_one_current_and_overlap(spark):
    versions = spark.createDataFrame(
        [
            (1, D(2024, 1, 1), D(2024, 2, 1), False),
            (1, D(2024, 2, 1), D(9999, 12, 31), True),  # overlaps by a day
            (2, D(2024, 1, 1), D(9999, 12, 31), True),
            (3, D(2024, 1, 1), D(2024, 5, 1), False),  # none current
        ],
        "user_id int, valid_from date, valid_to date, is_current boolean",
    )
    assert rows(x.one_current(versions)) == [(3, 0)]
    assert rows(x.no_overlap(versions), "user_id", "next_from") == [(1, D(2024, 2, 1))]


def test_sleep_stages_allow_one_minute(spark):
    nights = spark.createDataFrame(
        [(1, D(2024, 1, 1), 400, 100, 100, 201), (2, D(2024, 1, 1), 400, 100, 100, 202)],
        "user_id int, activity_date date, sleep_minutes int, sleep_deep_minutes int, "
        "sleep_rem_minutes int, sleep_light_minutes int",
    )
    assert rows(x.sleep_stages(nights)) == [(2, D(2024, 1, 1), 400, 402)]


@pytest.mark.parametrize("hours", [False, True])
def test_missing_grain(spark, hours):
    users = spark.createDataFrame([(1,), (2,), (3,)], "user_id int")
    days = [D(2024, 1, d) for d in (1, 2, 3)]
    full = [(1, d, h) for d in days for h in range(24)]
    partial = [(2, d, h) for d in (days[0], days[2]) for h in range(24)]
    df = spark.createDataFrame(full + partial, "user_id int, activity_date date, hour int")
    missing = x.missing_grain(df, users, F.lit(days[0]), F.lit(days[2]), hours=hours)
    factor = 24 if hours else 1
    assert missing.count() == (1 + 3) * factor
    assert rows(missing.where("user_id = 2"), "activity_date") == [(days[1],)] * factor
    assert "NestedLoop" not in plan_of(missing)


def test_has_columns_and_reconcile(spark, people):
    assert x.has_columns(people, ["id", "height"]) == ["height"]
    assert rows(x.reconcile(people, people.limit(3))) == [(5, 3)]
    assert x.reconcile(people, people).isEmpty()


def test_custom_expectation(spark, people):
    x.CUSTOM.pop("too_large", None)
    x.register("too_large", lambda df, column, limit: df.where(F.col(column) > limit))
    check = x.custom_check("too_large", "people", column="v", limit=50)
    report = x.run_checks([check], {"people": people})
    assert rows(report) == [("too_large_people_v_50", "people", 1, False)]
    with pytest.raises(ValueError):
        x.register("too_large", lambda df: df)


def test_report_counts_rows_and_groups(spark, people):
    tables = {"people": people, "parent": spark.createDataFrame([(1,)], "id int")}
    report = x.run_checks(
        [
            quality.not_null("people", "id"),
            quality.positive("people", "v"),
            quality.unique("people", "id"),
            quality.related("people", "id", "parent", "id"),
            quality.accepted("people", "sex", ["M", "F", "X"]),
        ],
        tables,
    )
    assert rows(report, "check_name", "offenders", "passed") == [
        ("accepted_values_people_sex", 0, True),
        ("not_null_people_id", 2, False),
        ("positive_people_v", 2, False),
        ("relationships_people_id_parent", 2, False),
        ("unique_people_id", 1, False),
    ]


def test_standing_checks_are_complete():
    checks = standing_checks()
    assert len(checks) == 67 and len({c.name for c in checks}) == 67


def test_one_pass_equals_the_single_expectations(spark):
    """Unique, composite and foreign keys with nulls, repeated values and two parents of a column."""
    child = spark.createDataFrame(
        [(1, 1, "a", D(2024, 1, 1)), (1, 2, "a", D(2024, 1, 1)), (2, 7, None, None), (None, 7, "b", D(2024, 1, 2)),
         (None, None, "c", None), (3, 9, "z", D(2024, 1, 2)), (3, 9, "z", D(2024, 1, 2)), (2, 9, None, None)],
        "k int, p bigint, s string, d date",
    )
    tables = {
        "child": child,
        "one": spark.createDataFrame([(1,), (2,), (7,), (7,), (None,)], "p int"),
        "two": spark.createDataFrame([("a", D(2024, 1, 1)), ("z", None)], "s string, d date"),
    }
    unique = [("k",), ("p",), ("s",), ("d",), ("k", "p"), ("s", "d"), ("d", "s", "k")]
    related = [("p", "one", "p"), ("k", "one", "p"), ("s", "two", "s"), ("d", "two", "d")]
    checks = [quality.unique("child", *u) if len(u) == 1 else quality.unique_combination("child", *u) for u in unique]
    checks += [quality.related("child", *r) for r in related]
    checks += [quality.not_null("child", "k"), quality.unique("two", "s"), quality.not_null("one", "p")]
    report = x.run_checks(checks, tables)
    found = dict(rows(report, "check_name", "offenders"))
    for columns, check in zip(unique, checks):
        single = x.unique(child, columns[0]) if len(columns) == 1 else x.unique_combination(child, columns)
        assert found[check.name] == single.count(), check.name
    for (column, parent, parent_column), check in zip(related, checks[len(unique) :]):
        lost = x.relationships(child, column, tables[parent], parent_column).agg(F.sum("n_rows")).first()[0]
        assert found[check.name] == (lost or 0), check.name
    assert found["not_null_child_k"] == 2 and found["unique_two_s"] == 0 and found["not_null_one_p"] == 1


def test_report_reads_each_table_once(spark, sf_dir, tmp_path):
    from wellspark.plans import pipeline
    from wellspark.sources import bindings

    tables = pipeline.build(bindings.raw_tables(spark, sf_dir), f"{tmp_path}/out")
    report = x.run_checks(standing_checks(), tables)
    assert report.count() == 67 and len(report.collect()) == 67
    plan = plan_of(report)
    assert "Final Plan" in plan and "CartesianProduct" not in plan
    # The keys of the parents are read for one table, and their shuffle serves the others.
    assert plan.split("Initial Plan")[0].count("FileScan parquet") <= 24
