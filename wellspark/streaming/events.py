"""Publishing, reading, decoding and auditing keyed JSON events.

All functions work on batch and streaming DataFrames alike, except the audits, which look
back over stored records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wellspark.functions.scalars import hash_bucket
from wellspark.sources.schemas import EVENT, RECORD
from wellspark.streaming import offsets

PARTITIONS = 3
FILES_PER_BATCH = "1000"
BROKEN = "_broken"
REQUIRED = ("event_id", "user_id", "ts")


def read_files(
    spark: SparkSession, path: str, schema: T.StructType = RECORD, **options: str
) -> DataFrame:
    """Files below a path as a stream, from the first file on.

    ``maxFilesPerTrigger`` bounds a micro-batch, so that a long backlog is worked off in
    pieces.
    """
    options = {"maxFilesPerTrigger": FILES_PER_BATCH, **options}
    return spark.readStream.schema(schema).options(**options).parquet(path)


def read_topic(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """A Kafka topic from its earliest offset (needs the Spark Kafka connector)."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .options(**options)
        .load()
        .select(
            F.col("key").cast("string"), F.col("value").cast("string"), "partition", "offset"
        )
    )


def partition_of(user_id: Column | str, n: int = PARTITIONS) -> Column:
    """Partition of a user: the same user always goes to the same one."""
    return hash_bucket("user", user_id, n)


def to_records(events: DataFrame, *keep: str) -> DataFrame:
    """Events as key (user_id text) and JSON value, with the columns to ``keep``."""
    return events.select(
        F.col("user_id").cast("string").alias("key"),
        F.to_json(F.struct(*[f.name for f in EVENT])).alias("value"),
        *keep,
    )


def place(records: DataFrame, offset: Column | str, n: int = PARTITIONS) -> DataFrame:
    """Records with the partition of their key and a given position in it."""
    offset = F.col(offset) if isinstance(offset, str) else offset
    return records.withColumn("partition", partition_of("key", n)).withColumn(
        "offset", offset.cast("bigint")
    )


def write_topic(records: DataFrame, servers: str, topic: str) -> None:
    """Publish records to Kafka; the key decides the partition, so a user stays in order."""
    (
        records.select("key", "value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("topic", topic)
        .save()
    )


def _parsed(records: DataFrame) -> DataFrame:
    schema = T.StructType([*EVENT.fields, T.StructField(BROKEN, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN}
    return records.withColumn("_event", F.from_json("value", schema, options))


def decode(records: DataFrame) -> DataFrame:
    """The six event fields of each record, with its partition and offset."""
    return _parsed(records).select(*[f"_event.{f.name}" for f in EVENT], "partition", "offset")


def event_time(ts: Column | str) -> Column:
    """Epoch seconds (double) as a timestamp, to the microsecond."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_micros(F.round(ts * 1000000).cast("bigint"))


def classify(records: DataFrame) -> DataFrame:
    """Decoded events and, where one cannot be stored, the reason why and the record's text."""
    event = F.col("_event")
    reason = (
        F.when(F.col("value").isNull(), "no value")
        .when(event.isNull() | event[BROKEN].isNotNull(), "not decodable")
        .when(
            F.array_contains(F.array(*[event[c].isNull() for c in REQUIRED]), True), "missing field"
        )
    )
    return _parsed(records).select(
        "_event",
        "partition",
        "offset",
        reason.alias("reason"),
        F.when(reason.isNotNull(), F.col("value")).alias("value"),
    )


def split_errors(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of classified records the events to store, and the rejected records."""
    good = classified.where(F.col("reason").isNull()).select(
        *[f"_event.{f.name}" for f in EVENT], "partition", "offset"
    )
    bad = classified.where(F.col("reason").isNotNull())
    return good, bad.select("value", "partition", "offset", "reason")


def users_spanning(stored: DataFrame) -> DataFrame:
    """Users seen on more than one partition; the smallest and largest tell, no distinct set."""
    return (
        stored.groupBy("user_id")
        .agg(F.min("partition").alias("first"), F.max("partition").alias("last"))
        .where(F.col("first") != F.col("last"))
    )


def partition_spread(stored: DataFrame) -> DataFrame:
    """Events and users per partition.

    Counted per (partition, user) first, so a partition never gathers its rows in one task.
    """
    return (
        stored.groupBy("partition", "user_id")
        .agg(F.count(F.lit(1)).alias("_n"))
        .groupBy("partition")
        .agg(F.sum("_n").alias("events"), F.count("user_id").alias("users"))
    )


def offset_gaps(
    stored: DataFrame,
    partition: str = "partition",
    offset: str = "offset",
    width: int = offsets.STRETCH,
) -> DataFrame:
    """Places where the offsets of a partition skip or repeat.

    ``missing`` offsets lie between ``after_offset`` and ``at_offset``, or ``repeats`` extra
    rows carry ``at_offset``. Rows are read once, and what is dealt out is no list of them but a
    bitmap for each stretch of ``width`` offsets that a task has seen, with the offsets it
    has seen again. Joined stretches are compared with the one before by their ends, a row for
    each. Rows without an offset have no place and are left out.
    """
    joined = offsets.joined(offsets.summaries(stored, partition, offset, width), width)
    order = Window.partitionBy("partition").orderBy("stretch")
    before = F.lag("last").over(order)
    skipped = F.coalesce(F.col("first") - F.col("_before") - 1, F.lit(0).cast("bigint"))
    entry = F.struct(
        F.col("_before").alias("after_offset"),
        F.col("first").alias("at_offset"),
        skipped.alias("missing"),
        F.col("first_repeats").alias("repeats"),
    )
    found = joined.withColumn("_before", before).select(
        "partition", F.explode(F.concat("places", F.array(entry))).alias("place")
    )
    return found.select("partition", "place.*").where((F.col("missing") > 0) | (F.col("repeats") > 0))
