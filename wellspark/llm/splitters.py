"""Sharding by sampled splitters: ranges of a key, cut so that shards are of near equal size.

Records are keyed by the hash of their text, then of their id, so equal texts lie next to each
other and a large group of copies can still be cut between ids. A sample, drawn in proportion to
size, gives quantile boundaries; the ranges between them are measured, and overfull ones are
sampled again and subdivided. Sizes are then summed in key order, within ranges by a window and
across ranges by the measured totals, and a record belongs to the shard in whose share of all
bytes its middle falls. Shards so differ by no more than their border records.

Only keys and sizes are shuffled, never texts. The driver holds the sample and the ranges'
totals: some SAMPLE keys for each range, and MAX_RANGES ranges at most before subdividing.

Defined results: a null text is empty; a null id is an id of its own. Rows equal in id and text
are counted, placed next to each other, and each gets its own slot. Ties in size do not matter.
An empty table gives no rows; shards may be empty where there are fewer records than shards.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from wellspark.llm.rows import named, stored

SHARDS = 40
#: Bytes that a record takes beside its text.
RECORD_BYTES = 16
#: Ranges for each shard at least, records for each range, and ranges at most.
RANGES_PER_SHARD = 8
ROWS_PER_RANGE = 200_000
MAX_RANGES = 4096
#: Sampled keys for each range.
SAMPLE = 16
#: Times the mean size from which on a range is overfull, and how often such are subdivided.
OVERFULL = 3
ROUNDS = 4


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One row for each distinct record, with its key, its size and how often it occurs."""
    said = F.coalesce(named(text), F.lit(""))
    bytes_of = said.cast("binary")
    name = F.coalesce(named(doc_id).cast("string"), F.lit(""))
    return (
        docs.select(
            named(doc_id).alias("doc_id"),
            F.concat(F.md5(bytes_of), F.md5(name)).alias("key"),
            (F.octet_length(said) + RECORD_BYTES).cast("long").alias("size"),
            F.crc32(bytes_of).alias("text_crc32"),
        )
        .groupBy("key", "doc_id", "size", "text_crc32")
        .agg(F.count("*").alias("copies"))
    )


def _uniform(key: Column, seed: int) -> Column:
    """A number in (0, 1) that depends on the key alone."""
    return (F.shiftrightunsigned(F.xxhash64(F.lit(seed), key), 11) + F.lit(0.5)) / F.lit(2.0**53)


def range_of(key: Column, bounds: list[str]) -> Column:
    """How many of the sorted ``bounds`` are not above the key: binary search in an array."""
    if not bounds:
        return F.lit(0)
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]
    array = F.array(*[F.lit(b) for b in bounds])
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, step: F.when(
            F.coalesce(F.get(array, at + step - 1) <= key, F.lit(False)), at + step
        ).otherwise(at),
    )


def boundaries(records: DataFrame, total: int, ranges: int) -> tuple[list[str], list]:
    """Range boundaries and, for each range, its bytes, rows and distinct records."""
    weight = F.col("size") * F.col("copies")
    mean = total / ranges
    bounds: list[str] = []
    crowded: list[int] | None = None
    for step in range(ROUNDS):
        pool = records
        if crowded is not None:
            pool = records.where(range_of(F.col("key"), bounds).isin(crowded))
        chance = SAMPLE * weight / F.lit(mean)
        drawn = pool.where(_uniform(F.col("key"), step) < chance).select("key").distinct()
        keys = sorted(r.key for r in drawn.collect())
        bounds = sorted({*bounds, *keys[SAMPLE // 2 :: SAMPLE]})
        measured = (
            records.groupBy(range_of(F.col("key"), bounds).alias("range"))
            .agg(F.sum(weight).alias("bytes"), F.sum("copies").alias("rows"), F.count("*").alias("n"))
            .collect()
        )
        crowded = [r.range for r in measured if r.bytes > OVERFULL * mean and r.n > 1]
        if not crowded:
            break
    return bounds, sorted(measured)


def sharded(
    docs: DataFrame, *, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every record; slots of a shard run from 0."""
    records = stored(keyed(docs, doc_id, text), "records")
    whole = records.agg(F.sum(F.col("size") * F.col("copies")), F.sum("copies")).first()
    total, rows = whole[0] or 1, whole[1] or 0
    ranges = max(shards * RANGES_PER_SHARD, math.ceil(rows / ROWS_PER_RANGE))
    bounds, measured = boundaries(records, total, min(ranges, MAX_RANGES))

    before = {}
    seen_bytes = seen_rows = 0
    for r in measured:
        before[r.range] = (seen_bytes, seen_rows)
        seen_bytes, seen_rows = seen_bytes + r.bytes, seen_rows + r.rows
    starts = [before.get(i, (0, 0)) for i in range(len(bounds) + 1)]

    def of_range(which: int) -> Column:
        return F.get(F.array(*[F.lit(s[which]).cast("long") for s in starts]), F.col("range"))

    earlier = Window.partitionBy("range").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    placed = (
        records.withColumn("range", range_of(F.col("key"), bounds))
        .withColumn("at", of_range(0) + F.coalesce(F.sum(F.col("size") * F.col("copies")).over(earlier), none))
        .withColumn("row", of_range(1) + F.coalesce(F.sum("copies").over(earlier), none))
        .withColumn("copy", F.explode(F.sequence(none, F.col("copies") - 1)))
        .select(
            "doc_id",
            "size",
            "text_crc32",
            (F.col("row") + F.col("copy")).alias("row"),
            (F.col("at") + F.col("copy") * F.col("size")).alias("at"),
        )
        .withColumn("shard", F.expr(f"cast((2 * at + size) * {shards} div (2 * {total}) as int)"))
    )
    placed = stored(placed, "placed")
    firsts = {r.shard: r.row for r in placed.groupBy("shard").agg(F.min("row").alias("row")).collect()}
    first = F.get(F.array(*[F.lit(firsts.get(i, 0)).cast("long") for i in range(shards)]), F.col("shard"))
    return placed.select(
        "doc_id", "size", "text_crc32", "shard", (F.col("row") - first).alias("slot")
    )
