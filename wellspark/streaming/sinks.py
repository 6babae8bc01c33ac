"""An idempotent event sink on plain parquet, fed by foreachBatch.

Delivery is at least once: progress is recorded in the checkpoint only after a batch is
stored, so a crash repeats the batch. Storing ignores event ids that are already there,
which makes the repetition harmless, also for a full replay with a new checkpoint. The same
holds for rejected records, which are known by (partition, offset).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspark.sources.storage import read_if_there
from wellspark.streaming.events import classify, split_errors


class BoundReached(Exception):
    """Ends a bounded run."""


#: The column that a table is partitioned by, and the ids of a span of it.
SPAN = "id_span"
SPAN_SIZE = 10_000_000


def span_of(key: str, size: int = SPAN_SIZE) -> Column:
    """Spans of a number: ids given out in sequence fall into few of them."""
    return F.col(key) - F.pmod(F.col(key), F.lit(size))


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """Buckets of a hash of the keys: random ids spread evenly over them."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets))


def first_wins(events: DataFrame) -> DataFrame:
    """One row per event id: the lowest partition and offset.

    An aggregate with partial minima, so many copies of one id do not meet in one task.
    """
    rest = [c for c in events.columns if c not in ("event_id", "partition", "offset")]
    first = F.min(F.struct("partition", "offset", *rest)).alias("_first")
    return (
        events.groupBy("event_id")
        .agg(first)
        .select(*[F.col(c) if c == "event_id" else F.col(f"_first.{c}").alias(c) for c in events.columns])
    )


def held_keys(stored: DataFrame, batch: DataFrame, keys: Sequence[str], part: Column) -> DataFrame:
    """(SPAN, keys) of the stored rows whose keys occur in the batch.

    The batch's keys carry the partition that they lie in, so as the small side of the join they
    tell the scan at run time which partitions to read; no list of them reaches the driver. Where
    Spark does not broadcast a batch, it reaches most partitions anyway.
    """
    # Spark prunes by a side that is filtered, so the filter is one that all rows pass.
    asked = batch.select(part.alias(SPAN), *keys).where(F.col(SPAN) >= F.lit(-(2**63)))
    return stored.select(SPAN, *keys).join(asked, [SPAN, *keys], "left_semi")


def append_unseen(
    batch: DataFrame,
    one_per_key: Callable[[DataFrame], DataFrame],
    path: str,
    keys: Sequence[str],
    part: Column,
) -> None:
    """Append one row per key of the batch, for the keys the table does not hold yet.

    The table is partitioned by ``part``, which follows from the keys: equal keys share a
    partition, so only the partitions that the batch reaches are read for the comparison, and of
    these only the key columns. With spans of ids given out in sequence these are few however
    large the table has become; with random ids a batch meets as many buckets as it has ids. The
    batch is read three times, for its keys twice: hand over a cached one.
    """
    spark, keys = batch.sparkSession, list(keys)
    if batch.where(part.isNotNull()).isEmpty():
        return
    unseen = one_per_key(batch).withColumn(SPAN, part)
    stored = read_if_there(spark, path, unseen.schema)
    if stored is not None:
        unseen = unseen.join(held_keys(stored, batch, keys, part), [SPAN, *keys], "left_anti")
    unseen = unseen.select(*batch.columns, SPAN)
    unseen.hint("rebalance", F.col(SPAN)).write.mode("append").partitionBy(SPAN).parquet(path)


def upsert_ignore(
    batch: DataFrame, path: str, span_size: int = SPAN_SIZE, buckets: int | None = None
) -> None:
    """Store each event id once; the first one wins, within the batch and against the table.

    For random ids give a number of ``buckets``; a table keeps the layout it began with.
    """
    part = bucket_of(["event_id"], buckets) if buckets else span_of("event_id", span_size)
    append_unseen(batch, first_wins, path, ["event_id"], part)


def store_errors(batch: DataFrame, path: str, span_size: int = SPAN_SIZE) -> None:
    """Store each rejected record once."""
    place = ["offset", "partition"]
    append_unseen(batch, lambda b: b.dropDuplicates(place), path, place, span_of("offset", span_size))


def run_available(
    records: DataFrame,
    path: str,
    checkpoint: str,
    errors_path: str | None = None,
    max_rows: int | None = None,
    buckets: int | None = None,
) -> int:
    """Land a stream of records until nothing is left, and return the rows read.

    With ``buckets`` the ids are random (see :func:`upsert_ignore`).

    ``max_rows`` ends the run after the micro-batch that reaches it: the next one is refused
    before anything of it is stored, and as it is not recorded either, the next run begins
    with it. The source's maxFilesPerTrigger or maxOffsetsPerTrigger sets the size of a batch.
    """
    read = 0
    enough = False

    def land(batch: DataFrame, _: int) -> None:
        nonlocal read, enough
        if max_rows is not None and read >= max_rows:
            enough = True
            raise BoundReached(f"{read} rows read")
        # Both outcomes come from one read of the source and one decoding.
        classified = classify(batch).persist()
        try:
            rows = classified.count()
            good, bad = split_errors(classified)
            upsert_ignore(good, path, buckets=buckets)
            if errors_path is not None:
                store_errors(bad, errors_path)
            read += rows
        finally:
            classified.unpersist()

    query = (
        records.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    try:
        query.awaitTermination()
    except StreamingQueryException:
        if not enough:
            raise
    finally:
        query.stop()
    return read
