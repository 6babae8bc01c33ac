"""Late rows and the rolling scores that they reach.

A late day of a user changes the scores of that day and of the user's next ``rows - 1`` rows. Only
these are computed again and put in place; the days read are those that hold a frame of one of
them, found by looking no further than needed.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wellspark.operators import loads
from wellspark.operators.metrics import daily_subscore
from wellspark.operators.windows import EXACT, rolling_score
from wellspark.sources.storage import shared_dir

USER, DAY = "user_id", "activity_date"


@dataclass(frozen=True)
class Reach:
    """The days (inclusive) that hold all rows needed for what late rows reach."""

    first: dt.date
    last: dt.date

    @property
    def days(self) -> int:
        return (self.last - self.first).days + 1


def reach_of(facts: DataFrame, late: DataFrame, rows: int) -> Reach | None:
    """Days around the late ones in which every late user has ``rows - 1`` rows on either side.

    ``facts`` is stored by day and already has the late rows, so a filter on days skips folders.
    It is looked at over a span that is doubled on the side where a user still lacks rows, up to
    the ends of the table; only users and days are read. A user who begins (or ends) within the
    span has no more rows to find, which nothing but the end of the table can tell: a batch with
    such a user looks as far as that.
    """
    ends = late.groupBy(USER).agg(F.min(DAY).alias("_first"), F.max(DAY).alias("_last"))
    first, last = ends.agg(F.min("_first"), F.max("_last")).first()
    if first is None:
        return None
    oldest, newest = facts.agg(F.min(DAY), F.max(DAY)).first()
    day = F.col(DAY)
    back = ahead = rows
    while True:
        low = max(oldest, first - dt.timedelta(days=back))
        high = min(newest, last + dt.timedelta(days=ahead))
        around = (
            facts.where(day.between(F.lit(low), F.lit(high)))
            .join(ends, USER)
            .groupBy(USER)
            .agg(
                F.count_if(day < F.col("_first")).alias("_before"),
                F.count_if(day > F.col("_last")).alias("_after"),
            )
        )
        least = around.agg(F.min("_before"), F.min("_after")).first()
        lacks_before = least[0] < rows - 1 and low > oldest
        lacks_after = least[1] < rows - 1 and high < newest
        if not lacks_before and not lacks_after:
            return Reach(low, high)
        back, ahead = back * (1 + lacks_before), ahead * (1 + lacks_after)


def reached_scores(facts: DataFrame, late: DataFrame, reach: Reach, rows: int) -> DataFrame:
    """The scores of the late rows and of those whose frames hold one, as of ``facts``.

    One pass over the late users' rows within the reach: whether a frame holds a late row is a
    window over the same order as the score itself.
    """
    keys = late.select(USER, DAY).distinct()
    near = facts.where(F.col(DAY).between(F.lit(reach.first), F.lit(reach.last)))
    scored = (
        daily_subscore(near.join(keys.select(USER).distinct(), USER, "left_semi"))
        .select(USER, DAY, "daily_score")
        .join(keys.withColumn("_late", F.lit(True)), [USER, DAY], "left")
    )
    frame = Window.partitionBy(USER).orderBy(DAY, F.col("daily_score").cast(EXACT))
    held = F.max("_late").over(frame.rowsBetween(-(rows - 1), 0))
    return rolling_score(scored, rows).withColumn("_held", held).where("_held").drop("_late", "_held")


def apply_late(
    spark: SparkSession, facts_path: str, scores_path: str, batch: DataFrame, rows: int = 30
) -> Reach | None:
    """Put late (or corrected) daily rows into the stored facts and follow them to the scores.

    Both tables are stored by day and only touched days are rewritten. A run that breaks off is
    repeated with the same batch: equal rows replace each other, and what is reached follows
    from the batch alone.
    """
    stage = shared_dir(spark, "late")
    batch.write.parquet(stage)
    batch = spark.read.schema(batch.schema).parquet(stage)
    loads.apply_delete_insert(spark, facts_path, batch, [USER, DAY], DAY)
    facts = spark.read.parquet(facts_path)
    reach = reach_of(facts, batch, rows)
    if reach is not None:
        scores = reached_scores(facts, batch, reach, rows)
        loads.apply_delete_insert(spark, scores_path, scores, [USER, DAY], DAY)
    return reach
