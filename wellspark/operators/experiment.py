"""Assignment and two-arm experiment statistics, for many experiments at once.

Subjects are reduced to a few sums per experiment and arm in one groupBy; everything after
works on those rows. Arm A is the control, B the treatment; effects are B - A.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wellspark.functions.distributions import (
    normal_cdf,
    normal_two_sided,
    student_critical,
    student_two_sided,
    z_quantile,
)
from wellspark.functions.scalars import hash_bucket
from wellspark.operators.aggregates import arm_stats, variant_summary

# Fixed values.
ALPHA, POWER, MDE = 0.05, 0.80, 0.03
ERROR_BAR_Z = 1.96
#: Numbers that a weighted draw may give, and cells that they are looked up by.
DRAWS, CELLS = 1_000_000, 1_000


def _bernoulli(p: Column) -> Column:
    return p * (1 - p)


def _is_rate(p: Column) -> Column:
    return p.between(0, 1)


def arms_wide(arms: DataFrame, *measures: str) -> DataFrame:
    """One row per experiment with ``<measure>_a`` and ``<measure>_b``."""
    return arms.groupBy("experiment_name").agg(
        *[
            F.max(F.when(F.col("variant") == arm, F.col(m))).alias(f"{m}_{arm.lower()}")
            for m in measures
            for arm in ("A", "B")
        ]
    )


def ztest(summary: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """Two-proportion z-test on :func:`variant_summary`, two-sided.

    The statistic uses the pooled standard error, the interval the unpooled one; a zero
    pooled error gives z = 0.
    """
    n_a, n_b, x_a, x_b = (F.col(c) for c in ("n_a", "n_b", "engaged_a", "engaged_b"))
    p_a, p_b = F.try_divide(x_a, n_a), F.try_divide(x_b, n_b)
    pooled = F.try_divide(x_a + x_b, n_a + n_b)
    spread = F.try_divide(F.lit(1), n_a) + F.try_divide(F.lit(1), n_b)
    wide = (
        arms_wide(summary, "engaged", "n")
        .withColumn("p_a", p_a)
        .withColumn("p_b", p_b)
        .withColumn("effect", p_b - p_a)
        .withColumn("_se0", F.sqrt(_bernoulli(pooled) * spread))
        .withColumn(
            "_margin",
            F.sqrt(F.try_divide(_bernoulli(p_a), n_a) + F.try_divide(_bernoulli(p_b), n_b))
            * z_quantile(1 - alpha / 2),
        )
    )
    z = F.when(F.col("_se0") > 0, F.col("effect") / F.col("_se0")).when(F.col("_se0") == 0, F.lit(0.0))
    return (
        wide.withColumn("z", z)
        .withColumn("p_value", normal_two_sided("z"))
        .withColumn("ci_low", F.col("effect") - F.col("_margin"))
        .withColumn("ci_high", F.col("effect") + F.col("_margin"))
        .drop("_se0", "_margin")
    )


def welch(arms: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """Welch t-test on :func:`arm_stats`, two-sided, with Satterthwaite degrees of freedom.

    Zero variance in both arms gives t = 0 and no degrees of freedom; an arm with fewer than
    two values gives nulls.
    """
    n_a, n_b = F.col("n_a"), F.col("n_b")
    q_a, q_b = F.col("variance_a") / n_a, F.col("variance_b") / n_b
    both = q_a + q_b
    df = F.when(
        both > 0,
        F.pow(both, F.lit(2.0)) / (q_a * q_a / (n_a - 1) + q_b * q_b / (n_b - 1)),
    )
    t = F.when(both > 0, F.col("effect") / F.sqrt(both)).when(both == 0, F.lit(0.0))
    enough = (n_a > 1) & (n_b > 1)
    margin = student_critical(F.lit(alpha), F.col("df")) * F.sqrt(both)
    return (
        arms_wide(arms, "n", "mean", "variance")
        .withColumn("effect", F.col("mean_b") - F.col("mean_a"))
        .withColumn("t", F.when(enough, t))
        .withColumn("df", F.when(enough, df))
        .withColumn("p_value", student_two_sided("t", "df"))
        .withColumn("_margin", margin)
        .withColumn("ci_low", F.col("effect") - F.col("_margin"))
        .withColumn("ci_high", F.col("effect") + F.col("_margin"))
        .drop("_margin")
    )


def sample_size(
    control: Column, mde: Column | float = MDE, alpha: float = ALPHA, power: float = POWER
) -> Column:
    """Subjects per arm to detect an absolute lift ``mde`` over the control rate.

    Null where the lifted rate is no proportion, or the lift is zero.
    """
    mde = mde if isinstance(mde, Column) else F.lit(mde)
    treated = control + mde
    middle = (control + treated) / 2
    root = F.sqrt(2 * _bernoulli(middle)) * z_quantile(1 - alpha / 2) + F.sqrt(
        _bernoulli(control) + _bernoulli(treated)
    ) * z_quantile(power)
    lift = treated - control
    size = F.ceil(F.try_divide(root * root, lift * lift)).cast("bigint")
    return F.when(_is_rate(control) & _is_rate(treated), size)


def power(control: Column, treated: Column, n: Column, alpha: float = ALPHA) -> Column:
    """Power of the two-sided two-proportion test with n subjects per arm.

    Null where a rate is no proportion, or both arms are certain.
    """
    middle = (control + treated) / 2
    se0 = F.sqrt(2 * _bernoulli(middle) / n)
    se1 = F.sqrt(_bernoulli(control) / n + _bernoulli(treated) / n)
    shortfall = F.try_divide(se0 * z_quantile(1 - alpha / 2) - F.abs(treated - control), se1)
    return 1 - normal_cdf(F.when(_is_rate(control) & _is_rate(treated), shortfall))


def power_curve(rates: DataFrame, mde: float = MDE, control: str = "p_a") -> DataFrame:
    """Power at n = 100, 200, .. 5900 per arm for the control rate of each experiment."""
    p = F.col(control)
    return rates.select(
        "experiment_name", control, F.explode(F.sequence(F.lit(100), F.lit(5900), F.lit(100))).alias("n")
    ).withColumn("power", power(p, p + mde, F.col("n")))


def wald_error(summary: DataFrame) -> DataFrame:
    """Half width of the 95% error bar of each variant's rate."""
    return summary.withColumn("error", F.sqrt(_bernoulli(F.col("rate")) / F.col("n")) * ERROR_BAR_Z)


def ab_report(df: DataFrame, alpha: float = ALPHA, mde: float = MDE) -> DataFrame:
    """One row per experiment: arms, both tests, needed size, achieved power and decision."""
    z = ztest(variant_summary(df), alpha).withColumnsRenamed(
        {"p_value": "z_p_value", "ci_low": "z_ci_low", "ci_high": "z_ci_high"}
    )
    t = welch(arm_stats(df, "engaged_next_day"), alpha).select(
        "experiment_name",
        "t",
        "df",
        F.col("p_value").alias("t_p_value"),
        F.col("ci_low").alias("t_ci_low"),
        F.col("ci_high").alias("t_ci_high"),
    )
    p = F.col("p_a")
    return z.join(t, "experiment_name", "left").select(
        "*",
        sample_size(p, mde, alpha).alias("required_n"),
        power(p, p + mde, F.col("n_a"), alpha).alias("achieved_power"),
        F.when(F.col("z_p_value") < alpha, "reject").otherwise("fail to reject").alias("decision"),
    )


def assign(users: DataFrame, experiment: str, split: float, key: str = "user_id") -> DataFrame:
    """Variant B for a share ``split`` of keys, A otherwise, decided by a hash of the key."""
    bucket = hash_bucket(experiment, key, 10_000)
    return users.select(
        key,
        F.lit(experiment).alias("experiment_name"),
        F.when(bucket < round(split * 10_000), "B").otherwise("A").alias("variant"),
    )


def option_ranges(
    options: DataFrame, option: str, weight: str, within: Sequence[str] = ()
) -> DataFrame:
    """Options with the part [low, high) of 0..DRAWS that their share of the weights takes.

    Prefix sums of the weights of each eligible set, in the order of the option. The sums are
    exact (weights count to six decimals), so the parts of a set meet without gap or overlap;
    options without weight have none.
    """
    parts = Window.partitionBy(*within)
    before = parts.orderBy(option).rowsBetween(Window.unboundedPreceding, -1)
    whole = F.round(F.col(weight).cast("decimal(18,6)") * 1_000_000).cast("decimal(24,0)")
    summed = (
        options.where(F.col(option).isNotNull() & (F.col(weight) > 0))
        .withColumn("_w", whole)
        .withColumn("_before", F.coalesce(F.sum("_w").over(before), F.lit(0)).cast("decimal(34,0)"))
        .withColumn("_all", F.sum("_w").over(parts).cast("decimal(34,0)"))
    )
    return summed.select(
        *within,
        option,
        F.expr(f"cast(_before * {DRAWS} as decimal(38,0)) div _all").alias("low"),
        F.expr(f"cast((_before + _w) * {DRAWS} as decimal(38,0)) div _all").alias("high"),
    ).where(F.col("low") < F.col("high"))


def weighted_assign(
    users: DataFrame,
    options: DataFrame,
    salt: str,
    key: str = "user_id",
    option: str = "option_id",
    weight: str = "weight",
    within: Sequence[str] = (),
    out: str | None = None,
) -> DataFrame:
    """One of the options per key, with probability proportional to its weight.

    ``options`` is a table of the eligible options; with ``within`` a user may have those of
    the same values in these columns. A hash of the key draws a number, and the option is the one
    whose part of the set it falls into: an inverse lookup, made an equi join by listing each
    part under the cells of a fixed grid that it reaches. A set of n options has at most
    n + CELLS lines, and users spread evenly over them. Without an eligible option a user has
    null.
    """
    cell = lambda draw: F.floor(draw / (DRAWS // CELLS)).cast("int")
    ranges = option_ranges(options, option, weight, within)
    listed = ranges.select(
        *[F.col(c).alias(f"_{c}") for c in within],
        F.col(option).alias("_option"),
        "low",
        "high",
        F.explode(F.sequence(cell(F.col("low")), cell(F.col("high") - 1))).alias("_in"),
    )
    drawn = users.withColumn("_draw", hash_bucket(salt, key, DRAWS)).withColumn("_cell", cell(F.col("_draw")))
    hit = (F.col("_cell") == F.col("_in")) & (F.col("_draw") >= F.col("low")) & (F.col("_draw") < F.col("high"))
    for c in within:
        hit = hit & (F.col(c) == F.col(f"_{c}"))
    return drawn.join(listed, hit, "left").select(key, F.col("_option").alias(out or option))
