"""Connected components of a table of links, by alternating star contractions.

Each round points the larger neighbours of every node at its smallest neighbour, then the
smaller ones too; links only ever get shorter, and a component ends as a star around its
smallest node. Nothing but links is kept, and no group is gathered: minima are aggregates. They
are joined by another form of the node than they are grouped by, so that both sides are dealt
out for the join, whose hot keys Spark can then split. The number of links is known before each
round and decides how many tasks work on them, so that the many small steps over few links do not
become very many tasks and files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspark.llm.rows import LEAST_TASKS, checkpoint_folder, in_tasks

#: Links that a task works on.
LINKS_PER_TASK = 50_000


def _tasks(links: int) -> int:
    return max(LEAST_TASKS, -(-links // LINKS_PER_TASK))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a and b) but the roots themselves.

    ``root`` is the smallest node of the component. Links from a node to itself, null ends and
    repeated links are ignored; no links give no rows. ``links`` are counted first, so they are
    best a stored table.
    """
    checkpoint_folder(links.sparkSession)
    given = links.count()
    # b is the smaller end from here on.
    links = (
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    links = in_tasks(links, given, LINKS_PER_TASK).checkpoint()
    last, tasks = None, _tasks(links.count())
    links = links.coalesce(tasks)
    while True:
        links = _small_star(_large_star(links, tasks), tasks).checkpoint()
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == last:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        last, tasks = state, _tasks(state[0])


def _large_star(links: DataFrame, tasks: int) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("low")).coalesce(tasks)
    least = least.select(F.hex("a").alias("key"), F.least("a", "low").alias("low"))
    return (
        both.where("b > a")
        .withColumn("key", F.hex("a"))
        .join(least, "key")
        .select(F.col("b").alias("a"), F.col("low").alias("b"))
        .where("a <> b")
        .coalesce(tasks)
        .distinct()
        .coalesce(tasks)
    )


def _small_star(links: DataFrame, tasks: int) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("low")).coalesce(tasks)
    keyed = least.select(F.hex("a").alias("key"), "low")
    moved = links.withColumn("key", F.hex("a")).join(keyed, "key")
    moved = moved.select(F.col("b").alias("a"), F.col("low").alias("b")).coalesce(tasks)
    own = least.select("a", F.col("low").alias("b"))
    return moved.unionByName(own).where("a <> b").distinct().coalesce(tasks)
