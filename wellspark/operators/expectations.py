"""Data quality expectations.

Every expectation yields the offending rows; none means it passes. Nulls pass everything but
``not_null``; a composite key treats nulls as equal. Expectations about keys return one row
per offending value with ``n_rows``, the rows carrying it: rows are counted per value with
partial aggregation before anything is shuffled or joined.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wellspark.operators.aggregates import share_of_total
from wellspark.operators.windows import neighbour

N_ROWS = "n_rows"


def _row_count() -> Column:
    return F.count(F.lit(1)).alias(N_ROWS)


# Row predicates: true for an offending row, null or false otherwise.


def is_missing(column: str) -> Column:
    return F.col(column).isNull()


def not_accepted(column: str, values: Sequence) -> Column:
    return ~F.col(column).isin(*values)


def out_of_range(
    column: str, low: float | None = None, high: float | None = None, inclusive: bool = True
) -> Column:
    value, bad = F.col(column), []
    if low is not None:
        bad.append(value < low if inclusive else value <= low)
    if high is not None:
        bad.append(value > high if inclusive else value >= high)
    if not bad:
        raise ValueError("give a lower or an upper bound")
    return reduce(lambda a, b: a | b, bad)


def not_positive(column: str) -> Column:
    return F.col(column) <= 0


def stages_exceed_sleep() -> Column:
    return stage_sum() > F.col("sleep_minutes") + 1


def stage_sum() -> Column:
    return F.col("sleep_deep_minutes") + F.col("sleep_rem_minutes") + F.col("sleep_light_minutes")


# Expectations on a DataFrame.


def unique(df: DataFrame, column: str) -> DataFrame:
    return unique_combination(df.where(F.col(column).isNotNull()), [column])


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(_row_count()).where(F.col(N_ROWS) > 1)


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(is_missing(column))


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.where(not_accepted(column, values))


def accepted_range(
    df: DataFrame,
    column: str,
    low: float | None = None,
    high: float | None = None,
    inclusive: bool = True,
) -> DataFrame:
    return df.where(out_of_range(column, low, high, inclusive))


def positive(df: DataFrame, column: str) -> DataFrame:
    return df.where(not_positive(column))


def relationships(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child values without a parent row; the anti join sees distinct values only."""
    children = df.where(F.col(column).isNotNull()).groupBy(column).agg(_row_count())
    parents = parent.select(F.col(parent_column).alias(column))
    return children.join(parents, column, "left_anti")


def experiment_balanced(df: DataFrame, minimum: float = 0.35) -> DataFrame:
    """Variants holding less than ``minimum`` of all assignments."""
    return share_of_total(df, "variant").where(F.col("share") < minimum)


def one_current(scd2: DataFrame) -> DataFrame:
    """Users of the dimension whose number of current versions is not one."""
    return (
        scd2.groupBy("user_id")
        .agg(F.count_if("is_current").alias("current_versions"))
        .where(F.col("current_versions") != 1)
    )


def sleep_stages(df: DataFrame) -> DataFrame:
    return df.where(stages_exceed_sleep()).select(
        "user_id", "activity_date", "sleep_minutes", stage_sum().alias("stage_sum")
    )


def no_overlap(scd2: DataFrame) -> DataFrame:
    """Versions reaching into the user's next one."""
    ahead = neighbour(scd2, ["user_id"], "valid_from", "next_from")
    return ahead.where(F.col("next_from") <= F.col("valid_to")).select(
        "user_id", "valid_from", "valid_to", "next_from"
    )


def missing_grain(
    df: DataFrame,
    users: DataFrame,
    first: Column,
    last: Column,
    date: str = "activity_date",
    hours: bool = False,
) -> DataFrame:
    """Expected (user, day) or (user, day, hour) rows that are absent.

    Days (hours) of the range are numbered, and each present one is compared with the user's
    next one: the numbers between them are missing. A place before the range stands for each
    user, so users without any row count as well. One window by user over the stated grain;
    what is written out is the gaps alone.
    """
    per_day = 24 if hours else 1
    total = ((F.datediff(last, first) + 1) * per_day).cast("long")
    place = F.datediff(F.col(date), first).cast("long") * per_day
    place = place + F.col("hour") if hours else place
    present = df.where(F.col(date).between(first, last)).select(
        "user_id", place.alias("_at"), F.lit(False).alias("_known")
    )
    known = users.select("user_id", F.lit(-1).cast("long").alias("_at"), F.lit(True).alias("_known"))
    # Repeated rows of a place, and of a user, are one.
    places = present.unionByName(known).groupBy("user_id", "_at").agg(F.max("_known").alias("_known"))
    own = Window.partitionBy("user_id")
    gaps = (
        places.withColumn("_next", F.coalesce(F.lead("_at").over(own.orderBy("_at")), total))
        .withColumn("_user", F.max("_known").over(own))
        .where(F.col("_user") & (F.col("_next") > F.col("_at") + 1))
        .select("user_id", F.explode(F.sequence(F.col("_at") + 1, F.col("_next") - 1)).alias("_missing"))
    )
    day = F.date_add(first, F.expr(f"cast(_missing div {per_day} as int)")).alias(date)
    if not hours:
        return gaps.select("user_id", day)
    hour = (F.col("_missing") % 24).cast(df.schema["hour"].dataType).alias("hour")
    return gaps.select("user_id", day, hour)


def has_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Required columns the table lacks; compares schemas only, runs no job."""
    return [c for c in columns if c not in df.columns]


def reconcile(src: DataFrame, loaded: DataFrame) -> DataFrame:
    """One row when the loaded table does not hold as many rows as its source."""
    n_loaded = loaded.agg(F.count(F.lit(1)).alias("n")).scalar()
    return (
        src.agg(F.count(F.lit(1)).alias("source_rows"))
        .withColumn("loaded_rows", n_loaded)
        .where(F.col("source_rows") != F.col("loaded_rows"))
    )


def reconcile_count(src: DataFrame, loaded_rows: int) -> DataFrame:
    """As :func:`reconcile`, with the rows that the load itself has counted while writing."""
    return (
        src.agg(F.count(F.lit(1)).alias("source_rows"))
        .withColumn("loaded_rows", F.lit(loaded_rows).cast("bigint"))
        .where(F.col("source_rows") != F.col("loaded_rows"))
    )


# Named checks and their report.


@dataclass(frozen=True)
class Check:
    """A named expectation on one of a set of tables, in one of four forms.

    ``bad_row`` marks offending rows; ``unique`` names the columns that no two rows may share;
    ``parent`` is a (column, table, column of that table) in which the values must occur; or
    ``offenders`` builds the offending rows from all tables. ``nulls`` says whether a null in a
    single unique column counts as a value.
    """

    name: str
    table: str
    bad_row: Callable[[], Column] | None = None
    unique: tuple[str, ...] = ()
    nulls: bool = False
    parent: tuple[str, str, str] | None = None
    offenders: Callable[[Mapping[str, DataFrame]], DataFrame] | None = None


CUSTOM: dict[str, Callable[..., DataFrame]] = {}


def register(name: str, offenders: Callable[..., DataFrame]) -> None:
    """Make a user-written ``(df, **arguments) -> offenders`` available by name."""
    if name in CUSTOM:
        raise ValueError(f"expectation {name!r} is already registered")
    CUSTOM[name] = offenders


def custom_check(expectation: str, table: str, **arguments) -> Check:
    offenders = CUSTOM[expectation]
    suffix = "_".join(str(v) for v in arguments.values())
    return Check(
        f"{expectation}_{table}_{suffix}".rstrip("_"),
        table,
        offenders=lambda tables: offenders(tables[table], **arguments),
    )


def run_checks(checks: Iterable[Check], tables: Mapping[str, DataFrame]) -> DataFrame:
    """(check_name, table_name, offenders, passed), one row per check, in one job.

    A table is read once for all its row predicates, unique columns and foreign keys: it is
    grouped by each of those columns, and by none, in one pass. The values of foreign keys,
    counted, meet the keys of all parents in one join. Other checks have an aggregate each.
    """
    checks = list(checks)
    declared = [c for c in checks if c.offenders is None]
    parents = _parent_keys(declared, tables)
    parts = [
        _lines(table, [c for c in declared if c.table == table], tables[table], parents)
        for table in dict.fromkeys(c.table for c in declared)
    ]
    for c in checks:
        if c.offenders is not None:
            parts.append(
                c.offenders(tables)
                .agg(F.count(F.lit(1)).alias("offenders"))
                .select(
                    F.lit(c.name).alias("check_name"), F.lit(c.table).alias("table_name"), "offenders"
                )
            )
    report = reduce(DataFrame.unionByName, parts)
    return report.withColumn("passed", F.col("offenders") == 0)


def _parent_keys(checks: Sequence[Check], tables: Mapping[str, DataFrame]) -> DataFrame | None:
    """(_parent, _value) for every column that a foreign key refers to, values as text."""
    wanted = dict.fromkeys(c.parent[1:] for c in checks if c.parent)
    keys = [
        tables[table].select(
            F.lit(f"{table}.{column}").alias("_parent"), F.col(column).cast("string").alias("_value")
        )
        for table, column in wanted
    ]
    return reduce(DataFrame.unionByName, keys).distinct() if keys else None


def _lines(
    table: str, checks: Sequence[Check], df: DataFrame, parents: DataFrame | None
) -> DataFrame:
    """(check_name, table_name, offenders) of the checks on one table, from one read of it."""
    sets = [()]
    for c in checks:
        columns = c.unique or ((c.parent[0],) if c.parent else ())
        if columns not in sets:
            sets.append(columns)
    every = list(dict.fromkeys(column for columns in sets for column in columns))
    rules = [F.count_if(c.bad_row()).alias(f"_c{i}") for i, c in enumerate(checks) if c.bad_row]
    if every:
        # One bit for each column, set where the column is not in the set of this row.
        bits = {
            columns: sum(1 << (len(every) - 1 - k) for k, c in enumerate(every) if c not in columns)
            for columns in sets
        }
        grouped = df.groupingSets([[F.col(c) for c in columns] for columns in sets], *every).agg(
            _row_count(), F.grouping_id().alias("_set"), *rules
        )
    else:
        bits = {(): 0}
        grouped = df.agg(_row_count(), F.lit(0).alias("_set"), *rules)

    related = [c for c in checks if c.parent]
    # A column may refer to several parents, so a counted value is asked for each of them.
    if related:
        asked = F.array_compact(
            F.array(
                *[
                    F.when(
                        (F.col("_set") == bits[c.parent[0],]) & F.col(c.parent[0]).isNotNull(),
                        F.struct(
                            F.lit(f"{c.parent[1]}.{c.parent[2]}").alias("_parent"),
                            F.col(c.parent[0]).cast("string").alias("_value"),
                            F.lit(c.name).alias("_check"),
                        ),
                    )
                    for c in related
                ]
            )
        )
        grouped = (
            grouped.withColumn("_asked", F.explode_outer(asked))
            .withColumn("_parent", F.col("_asked._parent"))
            .withColumn("_value", F.col("_asked._value"))
            .join(parents.withColumn("_found", F.lit(True)), ["_parent", "_value"], "left")
        )
    counts = []
    for i, c in enumerate(checks):
        if c.bad_row:
            n = F.max(F.when(F.col("_set") == bits[()], F.col(f"_c{i}")))
        elif c.unique:
            # Of a value that is asked for several parents only one row counts.
            once = F.col("_set") == bits[c.unique]
            if related:
                first = [r.name for r in related if (r.parent[0],) == c.unique][:1]
                once &= F.col("_asked").isNull() | (F.col("_asked._check") == F.lit(first[0] if first else ""))
            repeated = once & (F.col(N_ROWS) > 1)
            if len(c.unique) == 1 and not c.nulls:
                repeated &= F.col(c.unique[0]).isNotNull()
            n = F.count_if(repeated)
        else:
            lost = (F.col("_asked._check") == F.lit(c.name)) & F.col("_found").isNull()
            n = F.coalesce(F.sum(F.when(lost, F.col(N_ROWS))), F.lit(0))
        counts.append(F.coalesce(n, F.lit(0)).cast("bigint").alias(f"n{i}"))
    line = F.explode(
        F.array(
            *[
                F.struct(F.lit(c.name).alias("check_name"), F.col(f"n{i}").alias("offenders"))
                for i, c in enumerate(checks)
            ]
        )
    )
    return (
        grouped.agg(*counts)
        .select(line.alias("line"))
        .select("line.check_name", F.lit(table).alias("table_name"), "line.offenders")
    )
