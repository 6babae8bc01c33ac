"""Which offsets of a partition have been seen, as bitmaps that are joined like partial sums.

A task turns its rows into one summary for each (partition, stretch of offsets): the offsets seen,
as a bitmap or, where they are few, as a list, and how often offsets were seen again. Summaries of
a stretch from several tasks are joined by adding them up. All stretches of a batch are worked
on together, so that partitions with a handful of rows cost no more than rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# These functions travel to the executors as code, so these need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Offsets of a stretch: a bitmap of 4 KB.
STRETCH = 32_768
#: Rows that a task holds before it writes their summaries.
HELD = 1 << 20

PLACE = T.StructType([T.StructField(c, T.LongType()) for c in ("after_offset", "at_offset", "missing", "repeats")])


def _codes(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """A number for each value, -1 for null, and the values by number."""
    coded = values.dictionary_encode()
    numbers = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    return numbers, coded.dictionary


def _named(numbers: np.ndarray, names: pa.Array) -> pa.Array:
    return names.take(pa.array(numbers, pa.int64(), mask=numbers < 0))


def _lists(values: pa.Array, group: np.ndarray, groups: int) -> pa.ListArray:
    """Values as one list for each group; they stand in the order of their groups."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(group, np.arange(groups + 1)), pa.int32()), values)


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where sorted rows differ from the row before in any column."""
    out = np.ones(len(columns[0]), dtype=bool)
    out[1:] = False
    for column in columns:
        out[1:] |= column[1:] != column[:-1]
    return out


def summaries(stored: DataFrame, partition: str, offset: str, width: int) -> DataFrame:
    """(partition, stretch, few, bits, again, extra): what each task has seen of each stretch.

    ``few`` lists the places of the offsets in the stretch, or else ``bits`` is a map of them;
    the places in ``again`` were seen ``extra`` times more.
    """
    places = T.ArrayType(T.IntegerType())
    schema = T.StructType(
        [
            T.StructField("partition", stored.schema[partition].dataType),
            T.StructField("stretch", T.LongType()),
            T.StructField("few", places),
            T.StructField("bits", T.BinaryType()),
            T.StructField("again", places),
            T.StructField("extra", T.ArrayType(T.LongType())),
        ]
    )

    def summed(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(batches).combine_chunks()
        owner, owners = _codes(table.column(0).combine_chunks())
        at = table.column(1).to_numpy()
        stretch = at // width
        order = np.lexsort((at, owner))
        owner, at, stretch = owner[order], at[order], stretch[order]
        fresh = np.flatnonzero(_starts(owner, at))
        times = np.diff(np.append(fresh, len(at)))
        owner, stretch, place = owner[fresh], stretch[fresh], at[fresh] - stretch[fresh] * width
        starts = _starts(owner, stretch)
        group, first = np.cumsum(starts) - 1, np.flatnonzero(starts)
        sizes = np.diff(np.append(first, len(group)))
        many = sizes * 32 > width
        bits: list[bytes | None] = [None] * len(first)
        for g in np.flatnonzero(many).tolist():
            seen = np.zeros(width, dtype=np.uint8)
            seen[place[first[g] : first[g] + sizes[g]]] = 1
            bits[g] = np.packbits(seen).tobytes()
        few, more = ~many[group], times > 1
        return pa.RecordBatch.from_arrays(
            [
                _named(owner[first], owners),
                pa.array(stretch[first]),
                _lists(pa.array(place[few], pa.int32()), group[few], len(first)),
                pa.array(bits, pa.binary()),
                _lists(pa.array(place[more], pa.int32()), group[more], len(first)),
                _lists(pa.array(times[more] - 1, pa.int64()), group[more], len(first)),
            ],
            schema.names,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= HELD:
                yield summed(held)
                held = []
        if sum(b.num_rows for b in held):
            yield summed(held)

    rows = stored.select(F.col(partition).alias("partition"), F.col(offset).cast("bigint").alias("at"))
    return rows.where("at is not null").mapInArrow(run, schema)


def joined(found: DataFrame, width: int) -> DataFrame:
    """(partition, stretch, first, last, first_repeats, places): each stretch once.

    ``places`` are those within the stretch where offsets skip or repeat, after its first one.
    """
    schema = T.StructType(
        [
            found.schema["partition"],
            T.StructField("stretch", T.LongType()),
            T.StructField("first", T.LongType()),
            T.StructField("last", T.LongType()),
            T.StructField("first_repeats", T.LongType()),
            T.StructField("places", T.ArrayType(PLACE)),
        ]
    )
    names = schema.names

    def added(table: pa.Table, owner: np.ndarray, owners: pa.Array) -> pa.RecordBatch:
        stretch = table.column("stretch").to_numpy()
        group = np.cumsum(_starts(owner, stretch)) - 1
        few, again, extra = (table.column(c).combine_chunks() for c in ("few", "again", "extra"))
        row_of = lambda lists: np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
        parts = [(group[row_of(few)], few.flatten().to_numpy(), 1)]
        parts.append((group[row_of(again)], again.flatten().to_numpy(), extra.flatten().to_numpy()))
        bits = table.column("bits").combine_chunks()
        for row in np.flatnonzero(bits.is_valid().to_numpy(zero_copy_only=False)).tolist():
            seen = np.flatnonzero(np.unpackbits(np.frombuffer(bits[row].as_py(), dtype=np.uint8)))
            parts.append((np.full(len(seen), group[row]), seen, 1))
        g = np.concatenate([p[0] for p in parts])
        place = np.concatenate([p[1] for p in parts]).astype(np.int64)
        times = np.concatenate([np.broadcast_to(p[2], len(p[0])) for p in parts])
        order = np.lexsort((place, g))
        g, place, times = g[order], place[order], times[order]
        fresh = np.flatnonzero(_starts(g, place))
        repeats = np.add.reduceat(times, fresh) - 1
        g, place = g[fresh], place[fresh]
        first = np.flatnonzero(_starts(g))
        head = np.flatnonzero(_starts(group))
        base = stretch[head] * width
        at = base[g] + place
        after = np.concatenate([at[:1], at[:-1]])
        missing = at - after - 1
        told = (missing > 0) | (repeats > 0)
        told[first] = False
        columns = [after[told], at[told], missing[told], repeats[told]]
        places = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], PLACE.names)
        last = np.append(first[1:], len(g)) - 1
        return pa.RecordBatch.from_arrays(
            [
                _named(owner[head], owners),
                pa.array(stretch[head]),
                pa.array(at[first]),
                pa.array(at[last]),
                pa.array(repeats[first], pa.int64()),
                _lists(places, g[told], len(head)),
            ],
            names,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table]).combine_chunks()
            owner, owners = _codes(held.column("partition").combine_chunks())
            # The last stretch may go on in the next batch.
            whole = int(np.flatnonzero(_starts(owner, held.column("stretch").to_numpy()))[-1]) if len(owner) else 0
            if whole:
                yield added(held.slice(0, whole), owner[:whole], owners)
                held = held.slice(whole)
        if held is not None and held.num_rows:
            yield added(held, *_codes(held.column("partition").combine_chunks()))

    return (
        found.repartition("partition", "stretch").sortWithinPartitions("partition", "stretch").mapInArrow(run, schema)
    )
