"""Chat formatting by quotation linking: quotes become links, and text without quotes.

Each line's quote level is the number of ``>`` marks before it. A passage is a run of lines of
one level; it is looked up as a whole, by its paragraphs and by its lines, all normalised (lower
case, white space runs as one blank) and hashed, among the same units of what the messages of
the conversation say themselves. The original is the first message that says the unit; if that
is not an earlier turn, there is no link. The longest unit found decides for a passage, and the
outermost linked passage gives the message that is replied to. Following the replies upwards, in
doubling steps, leads to the turn that opens the thread; threads in order of their openings, and
messages in order of turns within, make the conversation in reply order.

Nothing is gathered by conversation: the first message for a unit is an aggregate with one row
for each unit, so a link never multiplies rows, and places are counted by stretches of turns.

Defined results: rows equal in all four columns are one message. Several messages with one turn
share that turn's replies; they are placed in order of role and text. A message without a
conversation or a turn is cleaned, but has no link and no place. A null text has no quotes and
stays null; a text of quotes alone becomes empty. An empty table gives no rows. Other columns of
the table are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from wellspark.llm.rows import checkpoint_folder, let, stored

#: A line that announces a quote; dropped where the next line is quoted.
HEADER = r"(?i)^\s*(on\s.*\swrote|am\s.*\sschrieb.*|le\s.*\sa écrit|el\s.*\sescribió)\s*:\s*$"
MARKS = r"^(?:[ \t]*>)+"
#: Turns counted together when messages are given places.
STRETCH = 4096


def normal(text: Column) -> Column:
    """Lower case, white space runs as one blank, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def runs(text: Column) -> Column:
    """Runs of lines of one level as (level, text); headers of quotes have the level -1."""

    def of_lines(lines: Column) -> Column:
        depth = F.transform(
            lines, lambda x: F.length(F.regexp_replace(F.regexp_extract(x, MARKS, 0), "[^>]", ""))
        )
        return let(depth, lambda d: of_depths(lines, d))

    def of_depths(lines: Column, depth: Column) -> Column:
        def level(x: Column, i: Column) -> Column:
            quoted_next = F.coalesce(F.get(depth, i + 1), F.lit(0)) > 0
            here = F.get(depth, i)
            return F.when((here == 0) & quoted_next & x.rlike(HEADER), F.lit(-1)).otherwise(here)

        said = F.transform(
            lines,
            lambda x, i: F.when(F.get(depth, i) == 0, x).otherwise(
                F.regexp_replace(x, MARKS + " ?", "")
            ),
        )
        both = F.struct(F.transform(lines, level).alias("levels"), said.alias("said"))
        return let(both, lambda b: of_levels(b["levels"], b["said"]))

    def of_levels(levels: Column, said: Column) -> Column:
        first = F.filter(
            F.sequence(F.lit(0), F.size(levels) - 1),
            lambda i: (i == 0) | (F.get(levels, i) != F.get(levels, F.greatest(i - 1, F.lit(0)))),
        )
        return let(
            first,
            lambda starts: F.transform(
                starts,
                lambda s, j: F.struct(
                    F.get(levels, s).alias("level"),
                    F.array_join(
                        F.slice(said, s + 1, F.coalesce(F.get(starts, j + 1), F.size(levels)) - s), "\n"
                    ).alias("text"),
                ),
            ),
        )

    return let(F.split(text, "\n"), of_lines)


def units(text: Column) -> Column:
    """The text as a whole, its paragraphs and its lines, normalised, without empty ones."""
    every = F.concat(F.array(text), F.split(text, r"\n[ \t\r]*\n"), F.split(text, "\n"))
    return F.filter(F.array_distinct(F.transform(every, normal)), lambda u: u != "")


def parsed(messages: DataFrame) -> DataFrame:
    """The distinct messages with their own text and their quoted passages."""
    distinct = messages.select("conv_id", "turn", "role", "text").distinct()
    split = distinct.withColumn("runs", runs(F.col("text")))
    own = F.array_join(
        F.transform(F.filter("runs", lambda r: r["level"] == 0), lambda r: r["text"]), "\n"
    )
    own = F.regexp_replace(F.regexp_replace(own, r"^(?:[ \t\r]*\n)+", ""), r"\s+$", "")
    return split.select(
        "conv_id",
        "turn",
        "role",
        F.md5(F.to_json(F.struct("role", "text"))).alias("message"),
        own.alias("text"),
        F.filter("runs", lambda r: (r["level"] > 0) & (normal(r["text"]) != "")).alias("passages"),
    )


def linked_passages(placed: DataFrame) -> DataFrame:
    """Each quoted passage that an earlier turn says, with that turn."""
    firsts = (
        placed.select("conv_id", "turn", F.explode(units(F.col("text"))).alias("unit"))
        .groupBy("conv_id", F.md5("unit").alias("hash"))
        .agg(F.min("turn").alias("original"))
    )
    passages = placed.select(
        "conv_id", "turn", "message", F.posexplode("passages").alias("place", "passage")
    )
    asked = passages.select(
        "conv_id",
        "turn",
        "message",
        "place",
        "passage.level",
        F.explode(units(F.col("passage.text"))).alias("unit"),
    ).select(
        "conv_id",
        "turn",
        "message",
        "place",
        "level",
        F.md5("unit").alias("hash"),
        F.length("unit").alias("size"),
    )
    return (
        asked.join(firsts, ["conv_id", "hash"])
        .where(F.col("original") < F.col("turn"))
        .groupBy("conv_id", "turn", "message", "place", "level")
        .agg(F.max_by("original", F.struct("size", -F.col("original"))).alias("original"))
    )


def openings(replies: DataFrame) -> DataFrame:
    """For each (conv_id, turn) that replies to an earlier turn, the turn its thread opens with."""
    checkpoint_folder(replies.sparkSession)
    ups = replies.checkpoint()
    while True:
        above = ups.select("conv_id", F.col("turn").alias("up"), F.col("up").alias("higher"))
        ups = (
            ups.select("conv_id", "turn", "up")
            .join(above, ["conv_id", "up"], "left")
            .select(
                "conv_id",
                "turn",
                F.coalesce("higher", "up").alias("up"),
                F.col("higher").isNotNull().alias("moved"),
            )
            .checkpoint()
        )
        if ups.where("moved").isEmpty():
            return ups.select("conv_id", "turn", F.col("up").alias("thread_turn"))


def counted_before(df: DataFrame, group: list[str], by: str) -> DataFrame:
    """For each (group, by) of ``df`` the rows of lower ``by`` in the group.

    Stretches of ``by`` are summed first, so no task holds more than a group's stretches or a
    stretch's rows.
    """
    before = (Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    each = df.groupBy(*group, by).agg(F.count("*").alias("n"))
    each = each.withColumn("stretch", F.floor(F.col(by) / STRETCH))
    earlier = Window.partitionBy(*group).orderBy("stretch").rowsBetween(*before)
    offsets = (
        each.groupBy(*group, "stretch")
        .agg(F.sum("n").alias("n"))
        .select(*group, "stretch", F.coalesce(F.sum("n").over(earlier), none).alias("offset"))
    )
    within = Window.partitionBy(*group, "stretch").orderBy(by).rowsBetween(*before)
    return (
        each.join(offsets, [*group, "stretch"])
        .withColumn("before", F.col("offset") + F.coalesce(F.sum("n").over(within), none))
        .select(*group, by, "before")
    )


def conversations(messages: DataFrame) -> DataFrame:
    """Messages without quotes: conv_id, turn, role, text, n_quotes, n_linked, parent_turn (the
    turn replied to), thread_turn (the turn that opens the thread) and position (from 0, in reply
    order within the conversation)."""
    every = stored(parsed(messages), "messages")
    has_place = F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
    placed = every.where(has_place)
    links = (
        linked_passages(placed)
        .groupBy("conv_id", "turn", "message")
        .agg(
            F.count("*").alias("n_linked"),
            F.min_by("original", F.struct("level", "place")).alias("parent_turn"),
        )
    )
    links = stored(links, "links")
    threads = openings(links.groupBy("conv_id", "turn").agg(F.min("parent_turn").alias("up")))
    quotes = F.coalesce(F.when(F.col("passages").isNotNull(), F.size("passages")), F.lit(0))
    known = stored(
        placed.withColumn("n_quotes", quotes)
        .drop("passages")
        .join(links, ["conv_id", "turn", "message"], "left")
        .join(threads, ["conv_id", "turn"], "left")
        .withColumn("n_linked", F.coalesce("n_linked", F.lit(0).cast("long")))
        .withColumn("thread_turn", F.coalesce("thread_turn", "turn")),
        "threads",
    )
    thread_at = counted_before(known, ["conv_id"], "thread_turn").withColumnRenamed("before", "t_at")
    turn_at = counted_before(known, ["conv_id", "thread_turn"], "turn").withColumnRenamed("before", "m_at")
    peers = Window.partitionBy("conv_id", "turn").orderBy("role", "text", "message")
    columns = ["conv_id", "turn", "role", "text", "n_quotes", "n_linked"]
    columns += ["parent_turn", "thread_turn", "position"]
    ordered = (
        known.join(thread_at, ["conv_id", "thread_turn"])
        .join(turn_at, ["conv_id", "thread_turn", "turn"])
        .withColumn("position", F.col("t_at") + F.col("m_at") + F.row_number().over(peers) - 1)
    )
    rest = every.where(~has_place).withColumns(
        {
            "n_quotes": quotes,
            "n_linked": F.lit(0).cast("long"),
            "parent_turn": F.lit(None).cast("long"),
            "thread_turn": F.lit(None).cast("long"),
            "position": F.lit(None).cast("long"),
        }
    )
    return ordered.select(*columns).unionByName(rest.select(*columns))
