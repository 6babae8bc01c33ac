import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from support import plan_of, rows
from wellspark.operators import loads, reshape
from wellspark.operators.aggregates import high_water
from wellspark.sources import bindings, storage, versions
from wellspark.sources.schemas import DATE_SEED, RAW_SCHEMAS, RAW_TABLES

D = dt.date
FACT = "user_id int, day date, v int"


def fact(spark, *data):
    return spark.createDataFrame([(u, D(2024, 1, d), v) for u, d, v in data], FACT)


def store(df, path):
    storage.write_partitioned(df, path, "day", "user_id")


def test_raw_tables_list_dimensions_first():
    facts = ("daily_activity", "nutrition_log", "body_scan", "intraday_hr")
    for dim in ("dim_device", "dim_user"):
        assert all(RAW_TABLES.index(dim) < RAW_TABLES.index(f) for f in facts)


def test_bindings_have_the_declared_schema(spark, sf_dir):
    for name, df in bindings.raw_tables(spark, sf_dir).items():
        assert [(f.name, f.dataType) for f in df.schema] == [
            (f.name, f.dataType) for f in RAW_SCHEMAS[name]
        ]


def test_load_sources_skips_missing_and_takes_subsets(spark, sf_dir, tmp_path):
    for name in ("dim_user", "dim_device"):
        storage.write_table(bindings.RAW[name](spark, sf_dir), name, str(tmp_path), ["parquet"])
    with pytest.warns(UserWarning, match="daily_activity"):
        loaded = storage.load_sources(spark, str(tmp_path), ["daily_activity", "dim_user", "dim_device"])
    assert list(loaded) == ["dim_device", "dim_user"]
    assert spark.table("dim_user").count() == loaded["dim_user"].count()
    with pytest.raises(ValueError):
        storage.load_sources(spark, str(tmp_path), ["dim_planet"])


def test_write_table_formats(spark, tmp_path):
    days = reshape.dim_date(spark, D(2024, 1, 1), D(2024, 1, 9))
    paths = storage.write_table(days, "dim_date", str(tmp_path), ["parquet", "csv"])
    assert rows(storage.scan_csv(spark, paths["csv"], DATE_SEED)) == rows(days)
    with pytest.raises(ValueError):
        storage.write_table(days, "dim_date", str(tmp_path), ["xls"])


def test_csv_with_a_bad_value_fails(spark, tmp_path):
    (tmp_path / "d.csv").write_text("date_key,date_day,is_weekend\nmonday,2024-01-01,false\n")
    with pytest.raises(Exception, match="monday|MALFORMED"):
        storage.scan_csv(spark, str(tmp_path / "d.csv"), DATE_SEED).collect()


def test_sample_users(spark):
    df = fact(spark, (1, 1, 0), (2, 1, 0), (7, 1, 0))
    assert rows(storage.sample_users(df, 2), "user_id") == [(1,), (2,)]
    keys = spark.createDataFrame([(7,), (7,)], "user_id int")
    assert rows(storage.sample_users(df, keys=keys), "user_id") == [(7,)]
    assert storage.sample_users(spark.range(3), 1).count() == 3


def test_table_load_replaces(spark, tmp_path):
    df = fact(spark, (1, 1, 0), (2, 1, 0))
    spark.sql("drop table if exists loaded_fact")
    for _ in range(2):
        loads.table_load(df, "loaded_fact", str(tmp_path / "t"))
        assert rows(spark.table("loaded_fact")) == rows(df)
    loads.table_load(df.where("user_id = 2"), "loaded_fact", str(tmp_path / "t"))
    assert rows(spark.table("loaded_fact"), "user_id") == [(2,)]
    with pytest.raises(ValueError, match="other columns"):
        loads.table_load(df.drop("v"), "loaded_fact", str(tmp_path / "t"))
    broken = df.withColumn("v", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        loads.table_load(broken, "loaded_fact", str(tmp_path / "t"))
    assert rows(spark.table("loaded_fact"), "user_id") == [(2,)]
    spark.sql("drop table loaded_fact")


def test_table_load_may_read_the_table_it_replaces(spark):
    spark.sql("drop table if exists counted_up")
    loads.table_load(spark.range(3).select(F.col("id").cast("int").alias("v")), "counted_up")
    for _ in range(2):
        loads.table_load(spark.table("counted_up").select((F.col("v") + 1).alias("v")), "counted_up")
    assert rows(spark.table("counted_up")) == [(2,), (3,), (4,)]
    spark.sql("drop table counted_up")


def test_load_audit(spark):
    audit = storage.load_audit({"a": spark.range(3), "b": spark.range(2)}, loaded=["b"])
    assert rows(audit, "table_name", "n_rows", "mode") == [
        ("TOTAL", 5, "-"),
        ("a", 3, "replace"),
        ("b", 2, "append"),
    ]


def test_rows_are_counted_while_they_are_written(spark, tmp_path):
    first = {"a": spark.range(30), "b": spark.range(20, numPartitions=4)}
    lines = [("TOTAL", 50, "-"), ("a", 30, "replace"), ("b", 20, "replace")]
    assert rows(storage.load_all(spark, first, str(tmp_path)), "table_name", "n_rows", "mode") == lines
    more = storage.load_all(spark, {"a": spark.range(5), "b": spark.range(0)}, str(tmp_path), loaded=["a"])
    assert rows(more, "table_name", "n_rows", "mode") == [("TOTAL", 5, "-"), ("a", 5, "append"), ("b", 0, "replace")]
    assert [spark.read.parquet(f"{tmp_path}/{n}.parquet").count() for n in "ab"] == [35, 0]
    # Every row is made once: the count comes from the write.
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    assert storage.write_observed(spark.range(70).mapInArrow(count, "id long"), f"{tmp_path}/c") == 70
    assert made.value == 70


def test_bucketed_facts_join_without_a_shuffle(spark, tmp_path):
    day = "date_add(date'2024-01-01', cast(id % 40 as int))"
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    names = ["bucketed_meals", "bucketed_days"]
    try:
        for name, n in zip(names, (3000, 2000)):
            df = spark.range(n).selectExpr("id % 50 as user_id", f"{day} as day", f"id as {name}")
            storage.write_bucketed(df, name, f"{tmp_path}/{name}", ["user_id", "day"], 8)
            files = [f for f in os.listdir(f"{tmp_path}/{name}") if f.endswith(".parquet")]
            assert len(files) == 8
        one, two = (spark.table(n) for n in names)
        both = one.join(two, ["user_id", "day"], "left")
        plan = plan_of(both)
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        assert "Exchange" not in plan_of(one.groupBy("user_id", "day").count())
        plain = [spark.read.parquet(f"{tmp_path}/{n}") for n in names]
        assert rows(both) == rows(plain[0].join(plain[1], ["user_id", "day"], "left"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in names:
            spark.sql(f"drop table if exists {name}")


def test_preview_is_a_top_n(spark):
    top = storage.preview(spark.range(100), 15, F.col("id").desc())
    assert rows(top) == sorted([(i, 100) for i in range(85, 100)], key=repr)
    assert "TakeOrderedAndProject" in plan_of(top)


def test_layouts(spark, tmp_path):
    df = fact(spark, (1, 1, 0), (2, 1, 0), (1, 2, 0))
    storage.write_fact(df, f"{tmp_path}/day", "day", "day")
    storage.write_fact(df, f"{tmp_path}/month", "day", "month")
    storage.write_scores(df, f"{tmp_path}/year", "day")
    folders = {n: sorted(f for f in os.listdir(tmp_path / n) if "=" in f) for n in ("day", "month", "year")}
    assert folders == {
        "day": ["day=2024-01-01", "day=2024-01-02"],
        "month": ["day_month=2024-01-01"],
        "year": ["year=2024"],
    }
    with pytest.raises(ValueError):
        storage.write_fact(df, f"{tmp_path}/x", "day", "hour")


def test_shared_dir_needs_a_setting_off_local(spark):
    class Remote:
        conf = {}

        class sparkContext:  # noqa: N801
            master = "spark://host:7077"

    Remote.conf = type("C", (), {"get": staticmethod(lambda name, default: default)})
    with pytest.raises(RuntimeError):
        storage.shared_dir(Remote, "x")
    first, second = (storage.shared_dir(spark, "x") for _ in range(2))
    assert first != second and first.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_high_water_of_empty_target(spark):
    assert high_water(fact(spark, (1, 1, 0)).where("false"), "day").first()[0] == D(1900, 1, 1)


def test_strict_append_takes_newer_days_only(spark):
    source = fact(spark, (1, 1, 0), (1, 2, 0), (9, 2, 0), (1, 3, 0))
    target = fact(spark, (1, 1, 0), (1, 2, 0))
    assert rows(loads.new_rows(source, target, "day"), "user_id", "day") == [(1, D(2024, 1, 3))]
    assert loads.new_rows(target, target, "day").isEmpty()  # a second run adds nothing
    late = loads.new_rows(source, target, "day", lookback_days=1)
    merged = loads.delete_insert(target, late, ["user_id", "day"])
    assert rows(merged) == rows(source)  # the late row of user 9 has arrived


def test_high_water_prunes_the_scan(spark, tmp_path):
    source = fact(spark, *[(1, d, d) for d in range(1, 29)])
    store(source, f"{tmp_path}/src")
    stored = spark.read.parquet(f"{tmp_path}/src")
    fresh = loads.new_rows(stored, source.where("v <= 25"), "day")
    assert rows(fresh, "v") == [(26,), (27,), (28,)]
    plan = plan_of(fresh)
    filters = plan[plan.index("PartitionFilters") :].split("]", 1)[0]
    assert "scalar-subquery" in filters or "Subquery" in filters


def test_delete_insert_rewrites_only_touched_partitions(spark, tmp_path):
    path = f"{tmp_path}/t"
    store(fact(spark, (1, 1, 1), (2, 1, 1), (1, 2, 1)), path)
    untouched = sorted(os.listdir(f"{path}/day=2024-01-02"))
    batch = fact(spark, (1, 1, 7), (3, 1, 7), (1, 5, 7))
    for _ in range(2):  # a second run changes nothing
        loads.apply_delete_insert(spark, path, batch, ["user_id", "day"], "day")
        got = rows(spark.read.parquet(path), "user_id", "day", "v")
        assert got == rows(fact(spark, (1, 1, 7), (2, 1, 1), (3, 1, 7), (1, 2, 1), (1, 5, 7)))
    assert sorted(os.listdir(f"{path}/day=2024-01-02")) == untouched


def test_overwrite_partitions_and_interval(spark, tmp_path):
    path = f"{tmp_path}/t"
    store(fact(spark, (1, 1, 1), (2, 1, 1), (1, 2, 1), (1, 3, 1)), path)
    loads.overwrite_partitions(fact(spark, (5, 1, 9)), path, "day")
    assert rows(spark.read.parquet(path), "user_id", "v") == [(1, 1), (1, 1), (5, 9)]
    source = fact(spark, (1, 1, 4), (1, 2, 4), (1, 3, 4))
    for _ in range(2):
        loads.run_interval(source, path, "day", "day", D(2024, 1, 2), D(2024, 1, 3))
    assert rows(spark.read.parquet(path), "user_id", "v") == [(1, 4), (1, 4), (5, 9)]
    loads.full_refresh(lambda: source, path, "day")
    assert rows(versions.read(spark, path), "v") == [(4,), (4,), (4,)]


def test_publish_version_switches_the_view(spark):
    for value in (1, 2):
        path = storage.shared_dir(spark, "published")
        storage.write_fact(fact(spark, (1, 1, value), (1, 2, value)), path, "day")
        loads.publish(spark, "live_fact", path)
        assert rows(spark.table("live_fact"), "v") == [(value,), (value,)]
    plan = plan_of(spark.table("live_fact").where("day = date'2024-01-02'"))
    assert "PartitionFilters: [isnotnull(day" in plan


@pytest.mark.parametrize("strategy", ["append", "delete_insert", "insert_overwrite"])
def test_incremental_runs(spark, tmp_path, strategy):
    path, keys = f"{tmp_path}/t", ["user_id", "day"]
    early = fact(spark, (1, 1, 1), (2, 1, 1), (1, 2, 1))
    late = fact(spark, (1, 1, 1), (2, 1, 1), (1, 2, 5), (9, 2, 5), (1, 3, 5))
    stored = lambda: rows(versions.read(spark, path), "user_id", "day", "v")
    loads.load_incremental(spark, early, path, "day", keys, strategy)
    assert stored() == rows(early)
    for _ in range(2):
        loads.load_incremental(spark, late, path, "day", keys, strategy)
        assert stored() == rows(early.unionByName(fact(spark, (1, 3, 5))))
    if strategy != "append":
        loads.load_incremental(spark, late, path, "day", keys, strategy, lookback_days=2)
        assert stored() == rows(late)
    loads.load_incremental(spark, early, path, "day", keys, strategy, full=True)
    assert stored() == rows(early)


def test_incremental_run_recovers_from_a_broken_one(spark, tmp_path):
    """Of days 2 to 4 only day 4 was put in place before the crash; the next run brings all."""
    path, keys = f"{tmp_path}/t", ["user_id", "day"]
    first = fact(spark, (1, 1, 1))
    source = fact(spark, (1, 1, 1), (1, 2, 2), (1, 3, 3), (1, 4, 4), (2, 4, 4))
    for strategy in ("append", "delete_insert", "insert_overwrite"):
        loads.load_incremental(spark, first, f"{path}-{strategy}", "day", keys, full=True)
        folder = versions.location(f"{path}-{strategy}", versions.live(spark, f"{path}-{strategy}").folder)
        storage.write_fact(fact(spark, (1, 4, 4)), folder, "day", mode="append")
        loads.load_incremental(spark, source, f"{path}-{strategy}", "day", keys, strategy)
        assert rows(versions.read(spark, f"{path}-{strategy}"), "user_id", "day", "v") == rows(source)


def test_incremental_run_on_a_table_without_record(spark, tmp_path):
    storage.write_fact(fact(spark, (1, 1, 1), (1, 2, 2)), f"{tmp_path}/t", "day")
    loads.load_incremental(spark, fact(spark, (1, 2, 9), (1, 3, 9)), f"{tmp_path}/t", "day", ["user_id", "day"])
    assert rows(spark.read.parquet(f"{tmp_path}/t"), "v") == [(1,), (2,), (9,)]


def test_incremental_refuses_what_would_duplicate(spark, tmp_path):
    with pytest.raises(ValueError):
        loads.load_incremental(spark, fact(spark), str(tmp_path), "day", [], "append", lookback_days=1)
    with pytest.raises(ValueError):
        loads.load_incremental(spark, fact(spark), str(tmp_path), "day", [], "merge")


def test_jdbc_load_options():
    """The writer is given the options of an idempotent, batched load; no database here."""
    seen = {}

    class Writer:
        def format(self, name):
            seen["format"] = name
            return self

        def options(self, **options):
            seen.update(options)
            return self

        def mode(self, mode):
            seen["mode"] = mode
            return self

        def save(self):
            seen["saved"] = True

    storage.jdbc_load(type("DF", (), {"write": Writer()}), "jdbc:x", "raw.t", user="u")
    assert seen == {
        "format": "jdbc", "url": "jdbc:x", "dbtable": "raw.t", "batchsize": "50000",
        "truncate": "true", "user": "u", "mode": "overwrite", "saved": True,
    }


def test_rows_without_a_date_or_key_are_replaced_like_others(spark, tmp_path):
    schema = "user_id int, day date, v int"
    day = dt.date(2024, 1, 1)
    target = spark.createDataFrame([(1, None, 1), (2, None, 2), (1, day, 3), (None, day, 4)], schema)
    storage.write_fact(target, f"{tmp_path}/t", "day")
    batch = spark.createDataFrame([(9, None, 9), (2, None, 7), (None, day, 8)], schema)
    loads.apply_delete_insert(spark, f"{tmp_path}/t", batch, ["user_id", "day"], "day")
    stored = spark.read.parquet(f"{tmp_path}/t")
    assert rows(stored, "user_id", "v") == sorted([(1, 1), (2, 7), (9, 9), (1, 3), (None, 8)], key=repr)


def test_refresh_that_breaks_off_leaves_the_table(spark, tmp_path, monkeypatch):
    """In the build, in the middle of the write, or between the write and the switch."""
    path = f"{tmp_path}/t"
    days = spark.createDataFrame([(1, dt.date(2024, 1, 1))], "user_id int, day date")
    loads.full_refresh(lambda: days, path, "day")
    two = spark.createDataFrame([(5, dt.date(2024, 1, 2)), (6, dt.date(2024, 1, 3))], days.schema)
    lost = F.when(F.col("user_id") == 6, F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("user_id"))

    def crash(*_):
        raise OSError("lost")

    for load in (
        lambda build: loads.full_refresh(build, path, "day"),
        lambda build: loads.load_incremental(spark, build(), path, "day", ["user_id"], full=True),
    ):
        for build in (lambda: two.withColumn("user_id", lost), crash):
            with pytest.raises(Exception, match="lost"):
                load(build)
            assert rows(versions.read(spark, path), "user_id") == [(1,)]
        with monkeypatch.context() as patched:
            patched.setattr(versions, "commit", crash)
            with pytest.raises(OSError, match="lost"):
                load(lambda: two)
        assert rows(versions.read(spark, path), "user_id") == [(1,)]
    loads.full_refresh(lambda: versions.read(spark, path).unionByName(two), path, "day")
    assert rows(versions.read(spark, path), "user_id") == [(1,), (5,), (6,)]
    now = versions.live(spark, path)
    assert now.version == 2 and len(versions.tidy(spark, path, [now.folder])) >= 3
    assert rows(versions.read(spark, path), "user_id") == [(1,), (5,), (6,)]


def test_log_of_versions(spark, tmp_path):
    path = f"{tmp_path}/t"
    assert versions.live(spark, path) is None
    os.makedirs(f"{path}-log/_temporary/0")  # a first line that never arrived
    assert versions.live(spark, path) is None
    for i in range(12):
        assert versions.commit(spark, path, f"v-{i}", str(i)).version == i + 1
    assert versions.live(spark, path) == versions.Version(12, "v-11", "11")


def test_many_copies_are_written_in_steps(spark, monkeypatch):
    monkeypatch.setattr(reshape, "STEP", 3)
    one = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    many = spark.range(40).select(F.lit(1).alias("k"), F.lit("a").alias("v")).unionByName(one.where("k = 2"))
    assert rows(reshape.table_diff(one, many)) == [("after", 1, "a")] * 39
    assert rows(reshape.table_diff(many, one)) == [("before", 1, "a")] * 39
