"""Per-user windows over time, over a declared grain.

On a daily grain a user has one row for each day, some 36,500 in a hundred years, so a plain
``partitionBy(user)`` window reads its source once and shuffles it once. Where a key may have any
number of rows (offsets of a partition, lines, readings), the caller gives ``width``: every
history is then cut into stretches of that many positions (days or offsets) and windowed inside
(key, stretch); what a frame needs from outside its stretch comes from a small table with one row
for each (key, stretch). Which of the two is used depends on the declaration alone, never on the
data, and results are the same.

The unordered operators aggregate first, with partial sums per task, and join the result
back. Rows are expected to have a user and a position, as checked upstream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wellspark.functions.scalars import exact_mean

# Days in a stretch of calendar frames.
YEAR = 366
# Scores are added as decimals: exact, whatever the order.
EXACT, TOTAL = "decimal(18,6)", "decimal(24,6)"
POS, STRETCH = "_pos", "_stretch"


def stretch_of(pos: Column, width: int) -> Column:
    """First position of the stretch holding ``pos``; exact for any bigint."""
    return pos - F.pmod(pos, F.lit(width))


def with_position(df: DataFrame, order: str) -> DataFrame:
    """Add the numeric position of a row: day number of a date, else the value itself."""
    is_date = isinstance(df.schema[order].dataType, T.DateType)
    pos = F.unix_date(order) if is_date else F.col(order)
    return df.withColumn(POS, pos.cast("bigint"))


def split_history(df: DataFrame, order: str, width: int) -> DataFrame:
    """Add position and stretch."""
    return with_position(df, order).withColumn(STRETCH, stretch_of(F.col(POS), width))


def _across(keys: Sequence[str]) -> Window:
    return Window.partitionBy(*keys).orderBy(STRETCH)


def rolling_score(
    df: DataFrame,
    rows: int = 30,
    key: str = "user_id",
    date: str = "activity_date",
    score: str = "daily_score",
    width: int | None = None,
) -> DataFrame:
    """Trailing mean of the last ``rows`` rows per user and the number of scores in it.

    Adds ``rolling_<rows>d_score`` (2 decimals) and ``days_in_window``. The frame counts
    rows: after a missing day it reaches further back. Without ``width`` rows are of daily
    grain. Equal dates are none; the value decides their order, so that it is settled.
    """
    if width is not None:
        total, count, out = _rolling_in_stretches(df, rows, key, date, score, width)
    else:
        value = F.col(score).cast(EXACT)
        frame = Window.partitionBy(key).orderBy(date, value).rowsBetween(-(rows - 1), 0)
        out = df.withColumn("_sum", F.sum(value).over(frame)).withColumn(
            "_count", F.count(value).over(frame)
        )
        total, count = F.col("_sum").cast(TOTAL), F.col("_count")
    return out.select(
        *[F.col(c) for c in df.columns],
        exact_mean(total, count, 2).alias(f"rolling_{rows}d_score"),
        count.alias("days_in_window"),
    )


def _rolling_in_stretches(
    df: DataFrame, rows: int, key: str, date: str, score: str, width: int
) -> tuple[Column, Column, DataFrame]:
    """Sum and count of each row's frame, and the frame they are columns of."""
    reach = rows - 1
    history = split_history(df, date, width).withColumn("_value", F.col(score).cast(EXACT))
    within = Window.partitionBy(key, STRETCH).orderBy(POS, "_value")
    frame = within.rowsBetween(-reach, 0)

    # The last rows of every stretch, and from them what the following stretches lack.
    # row_number <= reach is cut to that many rows per group before the shuffle.
    newest_first = Window.partitionBy(key, STRETCH).orderBy(
        F.col(POS).desc(), F.col("_value").desc()
    )
    tails = (
        history.select(key, STRETCH, POS, "_value")
        .withColumn("_from_end", F.row_number().over(newest_first))
        .where(F.col("_from_end") <= reach)
        .groupBy(key, STRETCH)
        .agg(F.sort_array(F.collect_list(F.struct(POS, "_value"))).alias("_tail"))
    )
    earlier = _across([key]).rowsBetween(-max(reach, 1), -1)
    reachable = tails.select(
        key, STRETCH, F.flatten(F.collect_list("_tail").over(earlier)).alias("_before")
    )
    first = F.greatest(F.size("_before") - reach + 1, F.lit(1))
    carried = reachable.where(F.size("_before") > 0).withColumn(
        "_before", F.slice("_before", first, F.lit(reach))
    )

    numbered = (
        history.withColumn("_row", F.row_number().over(within))
        .withColumn("_sum", F.sum("_value").over(frame))
        .withColumn("_count", F.count("_value").over(frame))
    )
    lacking = F.greatest(F.lit(rows) - F.col("_row"), F.lit(0))
    borrowed = F.slice(
        "_before",
        F.greatest(F.size("_before") - lacking + 1, F.lit(1)),
        F.least(lacking, F.size("_before")),
    )
    zero = F.lit(0).cast(TOTAL)
    added = F.aggregate(
        "_borrowed", zero, lambda acc, x: (acc + F.coalesce(x["_value"], zero)).cast(TOTAL)
    )
    n_added = F.size(F.filter("_borrowed", lambda x: x["_value"].isNotNull()))
    has_carry = F.col("_before").isNotNull() & (F.col("_row") < rows)
    joined = numbered.join(carried, [key, STRETCH], "left").withColumn(
        "_borrowed", F.when(has_carry, borrowed)
    )
    total = F.coalesce(F.col("_sum").cast(TOTAL), zero) + F.coalesce(added, zero)
    count = F.col("_count") + F.when(has_carry, n_added).otherwise(0)
    return total, count, joined


def rolling_score_days(
    df: DataFrame,
    days: int = 30,
    key: str = "user_id",
    date: str = "activity_date",
    score: str = "daily_score",
    width: int = YEAR,
) -> DataFrame:
    """Trailing mean over the last ``days`` calendar days per user, right with missing days.

    One shuffle: a row within ``days - 1`` days of a later stretch is sent there as well,
    serves that stretch's frames and is then left out.
    """
    reach = days - 1
    home, last = (stretch_of(F.col(POS) + ahead, width) for ahead in (0, reach))
    spread = with_position(df, date).withColumn("_home", home).withColumn(
        STRETCH, F.explode(F.sequence("_home", last, F.lit(width).cast("bigint")))
    )
    frame = Window.partitionBy(key, STRETCH).orderBy(POS).rangeBetween(-reach, 0)
    total = F.sum(F.col(score).cast(EXACT)).over(frame)
    count = F.count(score).over(frame)
    return (
        spread.withColumn(f"rolling_{days}d_score", exact_mean(total, count, 2))
        .withColumn("days_in_window", count)
        .where(F.col(STRETCH) == F.col("_home"))
        .drop(POS, STRETCH, "_home")
    )


def running_sum(
    df: DataFrame, key: str, order: str, value: str, out: str, width: int | None = None
) -> DataFrame:
    """Cumulative sum per user; rows of one position are added together.

    Without ``width`` rows are of daily grain.
    """
    if width is None:
        return df.withColumn(out, F.sum(value).over(Window.partitionBy(key).orderBy(order)))
    history = split_history(df, order, width)
    within = Window.partitionBy(key, STRETCH).orderBy(POS)
    before = _across([key]).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        history.groupBy(key, STRETCH)
        .agg(F.sum(value).alias("_total"))
        .select(key, STRETCH, F.sum("_total").over(before).alias("_before"))
    )
    running = F.when(
        F.col("_inner").isNotNull() | F.col("_before").isNotNull(),
        F.coalesce("_inner", F.lit(0)) + F.coalesce("_before", F.lit(0)),
    )
    return (
        history.withColumn("_inner", F.sum(value).over(within))
        .join(carried, [key, STRETCH], "left")
        .select(*df.columns, running.alias(out))
    )


def neighbour(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    out: str,
    forward: bool = True,
    width: int | None = None,
    ties: Sequence[str] = (),
) -> DataFrame:
    """The next (or previous) value of ``order`` within a key: lead/lag of the order itself.

    ``ties`` orders rows of one position, which are each other's neighbours. Without ``width``
    rows are of daily grain.
    """
    keys = list(keys)
    edge, step = (F.min, F.lead) if forward else (F.max, F.lag)
    if width is None:
        within = Window.partitionBy(*keys).orderBy(order, *ties)
        return df.withColumn(out, step(order).over(within))
    history = split_history(df, order, width)
    within = Window.partitionBy(*keys, STRETCH).orderBy(order, *ties)
    edges = (
        history.groupBy(*keys, STRETCH)
        .agg(edge(order).alias("_edge"))
        .select(*keys, STRETCH, step("_edge").over(_across(keys)).alias("_beyond"))
    )
    return (
        history.withColumn("_inner", step(order).over(within))
        .join(edges, [*keys, STRETCH], "left")
        .select(*df.columns, F.coalesce("_inner", "_beyond").alias(out))
    )


def with_group_stats(df: DataFrame, key: str, **stats: Column) -> DataFrame:
    """Attach per-key aggregates: partial aggregation, then an equi join AQE can split."""
    grouped = df.groupBy(key).agg(*[expr.alias(name) for name, expr in stats.items()])
    return df.join(grouped, key, "left")


def zscore(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """(x - mean) / (population std + 1e-6) against the key's own rows."""
    stats = with_group_stats(df, key, _mean=F.avg(value), _std=F.stddev_pop(value))
    return stats.withColumn(
        out, (F.col(value) - F.col("_mean")) / (F.col("_std") + F.lit(1e-6))
    ).drop("_mean", "_std")


def relative_to_peak(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """value / the key's maximum; 0 where the maximum is 0."""
    peak = F.col("_peak")
    return (
        with_group_stats(df, key, _peak=F.max(value))
        .withColumn(out, F.when(peak != 0, F.col(value) / peak).when(peak == 0, F.lit(0.0)))
        .drop("_peak")
    )


def downsample(df: DataFrame, key: str, date: str, every: int) -> DataFrame:
    """Rows on every ``every``-th day counted from the key's first day."""
    return (
        with_group_stats(df, key, _first=F.min(date))
        .where(F.datediff(date, "_first") % every == 0)
        .drop("_first")
    )


def latest_by(df: DataFrame, key: str, *order: str) -> DataFrame:
    """The row with the greatest ``order`` per key, as an aggregate: no sort, no window.

    Give enough order columns to decide ties; remaining columns decide the rest, so the
    answer never depends on the order in which rows arrive.
    """
    rest = [c for c in df.columns if c != key and c not in order]
    newest = F.max(F.struct(*order, *rest)).alias("_newest")
    return (
        df.groupBy(key)
        .agg(newest)
        .select(*[F.col(c) if c == key else F.col(f"_newest.{c}").alias(c) for c in df.columns])
    )
