import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from support import plan_of, rows
from wellspark.functions import distributions as dist
from wellspark.operators import experiment as ab
from wellspark.operators.aggregates import arm_stats, variant_summary


def subjects(spark, **experiments):
    """experiment=(x_a, n_a, x_b, n_b) as 0/1 outcomes, one row per subject."""
    parts = []
    for name, (x_a, n_a, x_b, n_b) in experiments.items():
        for arm, x, n in (("A", x_a, n_a), ("B", x_b, n_b)):
            parts += [(name, arm, int(i < x)) for i in range(n)]
    return spark.createDataFrame(parts, "experiment_name string, variant string, engaged_next_day int")


def test_two_proportion_z(spark):
    df = subjects(spark, lift=(330, 1200, 405, 1250), same=(120, 900, 120, 900), none=(0, 10, 0, 10))
    z = {r["experiment_name"]: r for r in ab.ztest(variant_summary(df)).collect()}
    effect, pooled = 405 / 1250 - 330 / 1200, 735 / 2450
    error = math.sqrt(pooled * (1 - pooled) * (1 / 1200 + 1 / 1250))
    assert math.isclose(z["lift"]["effect"], effect, abs_tol=1e-12)
    assert math.isclose(z["lift"]["z"], effect / error, rel_tol=1e-12)
    assert z["lift"]["ci_low"] < effect < z["lift"]["ci_high"]
    assert (z["same"]["z"], z["same"]["p_value"]) == (0.0, 1.0)
    assert (z["none"]["z"], z["none"]["p_value"]) == (0.0, 1.0)


def test_published_example(spark):
    report = ab.ab_report(subjects(spark, notif=(46, 249, 50, 251))).first()
    assert math.isclose(report["z"], 0.4105732, abs_tol=1e-7)
    assert math.isclose(report["z_p_value"], 0.6813855, abs_tol=1e-7)
    assert math.isclose(report["z_ci_low"], -0.0545645, abs_tol=1e-7)
    assert math.isclose(report["z_ci_high"], 0.0834929, abs_tol=1e-7)
    assert math.isclose(report["t"], 0.4098675, abs_tol=1e-7)
    assert math.isclose(report["df"], 497.7866, abs_tol=1e-4)
    assert math.isclose(report["t_p_value"], 0.6820795, abs_tol=1e-7)
    assert report["required_n"] == 2787
    assert math.isclose(report["achieved_power"], 0.130613, abs_tol=1e-6)
    assert report["decision"] == "fail to reject"


def test_clear_effect_is_rejected(spark):
    assert ab.ab_report(subjects(spark, big=(100, 1000, 300, 1000))).first()["decision"] == "reject"


def test_welch_on_unequal_arms(spark):
    rng = random.Random(31)
    a = [rng.gauss(5, 2) for _ in range(620)]
    b = [rng.gauss(5.3, 3) for _ in range(480)]
    df = spark.createDataFrame(
        [("e", "A", v) for v in a] + [("e", "B", v) for v in b], "experiment_name string, variant string, v double"
    )
    got = ab.welch(arm_stats(df, "v")).first()
    q_a, q_b = statistics.variance(a) / 620, statistics.variance(b) / 480
    t = (statistics.mean(b) - statistics.mean(a)) / math.sqrt(q_a + q_b)
    assert math.isclose(got["t"], t, rel_tol=1e-9)
    assert math.isclose(got["df"], (q_a + q_b) ** 2 / (q_a**2 / 619 + q_b**2 / 479), rel_tol=1e-9)
    margin = dist.t_critical(0.05, got["df"]) * math.sqrt(q_a + q_b)
    assert math.isclose(got["ci_high"] - got["ci_low"], 2 * margin, rel_tol=1e-9)


def test_welch_edge_cases(spark):
    df = spark.createDataFrame(
        [("flat", v, 1.0) for v in "AABB"] + [("tiny", "A", 1.0), ("tiny", "B", 2.0), ("half", "A", 1.0)],
        "experiment_name string, variant string, v double",
    )
    got = {r["experiment_name"]: r for r in ab.welch(arm_stats(df, "v")).collect()}
    assert (got["flat"]["t"], got["flat"]["df"], got["flat"]["p_value"]) == (0.0, None, None)
    assert got["tiny"]["t"] is None and got["half"]["t"] is None


@pytest.mark.parametrize(
    ("t", "df", "p"),
    # Two-sided table entries of Student's t.
    [(12.706, 1, 0.05), (2.228, 10, 0.05), (2.042, 30, 0.05), (2.750, 30, 0.01), (1.984, 100, 0.05)],
)
def test_student_table(t, df, p):
    assert math.isclose(dist.t_two_sided(t, df), p, abs_tol=5e-5)
    assert math.isclose(dist.t_critical(p, df), t, rel_tol=5e-4)


def test_student_limits():
    assert dist.t_two_sided(0.0, 5) == 1.0
    assert math.isclose(dist.t_two_sided(1.0, 1), 0.5, rel_tol=1e-12)  # Cauchy
    assert math.isclose(dist.t_critical(0.05, 1e7), dist.z_quantile(0.975), rel_tol=1e-6)


@pytest.mark.parametrize("df", [1e8, 1e10, 1e12, 1e14, 1e300])
def test_student_nears_the_normal(df):
    for t in (0.01, 1.0, 1.96, 5.0):
        # The first term by which the t distribution differs from its limit.
        density = math.exp(-t * t / 2) / math.sqrt(2 * math.pi)
        expected = math.erfc(t / math.sqrt(2)) + density * (t**3 + t) / (2 * df)
        assert abs(dist.t_two_sided(t, df) - expected) < 1e-11
    assert abs(dist.t_critical(0.05, df) - dist.z_quantile(0.975)) < 1e-7


def test_series_meets_the_fraction(monkeypatch):
    for df in (2e5, 1e6):
        series = [dist.t_two_sided(t, df) for t in (0.1, 1.0, 1.96, 3.0, 6.0)]
        monkeypatch.setattr(dist, "SERIES_FROM", 1e9)
        assert all(abs(dist.t_two_sided(t, df) - p) < 1e-9 for t, p in zip((0.1, 1.0, 1.96, 3.0, 6.0), series))
        monkeypatch.undo()


def test_fraction_that_does_not_converge_raises(monkeypatch):
    monkeypatch.setattr(dist, "TERMS", 2)
    with pytest.raises(ArithmeticError):
        dist.t_two_sided(1.0, 50.0)


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_sample_size_and_power(spark):
    p = F.lit(0.20)
    assert one(spark, ab.sample_size(p, 0.05)) == 1094
    assert one(spark, ab.sample_size(p, 0.08)) < one(spark, ab.sample_size(p, 0.02))
    at_n = one(spark, ab.power(p, p + 0.05, F.lit(1094)))
    assert math.isclose(at_n, 0.80009, abs_tol=1e-5)
    assert one(spark, ab.power(p, p + 0.05, F.lit(100))) < one(spark, ab.power(p, p + 0.05, F.lit(2000)))


def test_power_curve_grid(spark):
    rates = spark.createDataFrame([("e", 46 / 249)], "experiment_name string, p_a double")
    curve = ab.power_curve(rates).orderBy("n").collect()
    assert [r["n"] for r in curve] == list(range(100, 6000, 100))
    powers = [r["power"] for r in curve]
    assert powers == sorted(powers) and powers[0] < 0.13 < 0.8 < powers[-1]


def test_wald_error(spark):
    error = ab.wald_error(variant_summary(subjects(spark, e=(20, 100, 50, 100))))
    assert [round(v, 6) for (v,) in rows(error, "error")] == [0.0784, 0.098]


def test_assignment_is_stable_and_balanced(spark):
    users = spark.range(20_000).withColumnRenamed("id", "user_id")
    first = ab.assign(users, "exp", 0.3)
    assert rows(first) == rows(ab.assign(users.repartition(7), "exp", 0.3))
    share = first.where("variant = 'B'").count() / 20_000
    assert abs(share - 0.3) < 0.015
    moved = first.join(ab.assign(users, "other", 0.3).select("user_id", F.col("variant").alias("o")), "user_id")
    assert moved.where("variant <> o").count() > 0
    assert ab.assign(users, "exp", 0.0).where("variant = 'B'").isEmpty()
    assert ab.assign(users, "exp", 1.0).where("variant = 'A'").isEmpty()


OPTIONS = "option_id int, weight double, grp string"


def test_weighted_assignment_follows_weights(spark):
    """Options from a table, by eligible set; a set without weight or options gives none."""
    users = spark.range(20_000).selectExpr("id as user_id", "element_at(array('a', 'b', 'c', 'd'), cast(id % 4 as int) + 1) as grp")
    options = spark.createDataFrame(
        [(4, 0.5, "a"), (7, 0.2, "a"), (9, 0.1, "a"), (4, 3.0, "b"), (5, 0.0, "b"), (6, 1.0, "b"), (1, 0.0, "c"), (None, 1.0, "c")],
        OPTIONS,
    )
    given = ab.weighted_assign(users, options, "d", within=["grp"]).join(users, "user_id")
    counts = {(r.grp, r.option_id): r["count"] for r in given.groupBy("grp", "option_id").count().collect()}
    wanted = {("a", 4): 5 / 8, ("a", 7): 2 / 8, ("a", 9): 1 / 8, ("b", 4): 3 / 4, ("b", 6): 1 / 4, ("c", None): 1, ("d", None): 1}
    assert counts.keys() == wanted.keys()
    for (group, option), share in wanted.items():
        assert abs(counts[group, option] / 5000 - share) < 0.02
    one_set = ab.weighted_assign(users, options.where("grp = 'a'"), "d", out="choice")
    assert one_set.where("choice is null").isEmpty() and one_set.count() == 20_000


def test_option_parts_meet_exactly(spark):
    rng = random.Random(6)
    weights = [(i, rng.choice([1.0, 1e-6, 3.5, 1e5, 0.333333]), f"g{i % 3}") for i in range(4000)]
    parts = ab.option_ranges(spark.createDataFrame(weights, OPTIONS), "option_id", "weight", ["grp"]).collect()
    for group in ("g0", "g1", "g2"):
        ranges = sorted((r.low, r.high) for r in parts if r.grp == group)
        assert ranges[0][0] == 0 and ranges[-1][1] == ab.DRAWS
        assert all(a[1] == b[0] for a, b in zip(ranges, ranges[1:]))


def test_weighted_lookup_is_an_equi_join(spark, tmp_path):
    """Many options, no broadcast: each user meets the options of one cell."""
    weights = [(i, 1.0 + i % 5, "a") for i in range(3000)]
    spark.createDataFrame(weights, OPTIONS).write.parquet(f"{tmp_path}/o")
    users = spark.range(3000).withColumnRenamed("id", "user_id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        given = ab.weighted_assign(users, spark.read.parquet(f"{tmp_path}/o"), "d")
        plan = plan_of(given)
        assert "SortMergeJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan
        assert plan.count("FileScan") == 1
        assert given.where("option_id is null").isEmpty() and given.count() == 3000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
