"""Exact k-means over blocks of neighbouring vectors with min/max boxes (zone maps).

Vectors of whole numbers are put in the order of a Hilbert curve through their space and cut into
blocks of BLOCK; each block is a row with its box, its sum and its vectors, written once. A
round reads the blocks. A centroid whose least distance to the box is larger than another's
greatest distance can not be nearest to any vector of the block. A block with one centroid left
adds its stored sum; in the others every vector is compared exactly with those that are left.
Only sums of ``centroids`` x width numbers leave the tasks.

The order is dealt out by ranges of (place on the curve, hash of the id), so a place that very many
vectors share is cut as well.

Defined results: vectors that are null, have another width, or hold null, NaN, infinite or
out-of-range entries (2**17 and more, whose squared distances might not fit a long) are left out.
Rows without an id take part but can not be first centroids, unless no others are left; equal
hashes (repeated ids) are ordered by vector. Fewer vectors than centroids give fewer centroids. An
empty table gives no rows. Only the two named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wellspark.llm.rows import named, stored
from wellspark.llm.vectors import finite, listed, matrices

WIDTH = 64
SCALE = 1024
#: Entries below this keep squared distances of 64 entries in a long.
BELOW = 2.0**17
CENTROIDS = 8
ROUNDS = 10
SEED = "3:"
#: Vectors of a block, and bits of each entry on the curve.
BLOCK = 128
BITS = 2
#: Entries below this keep products of 64 entries exact in doubles.
EXACT = 1 << 20


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of cell numbers (a row for each vector, below 2**bits), as
    rows of bytes that order like the places."""
    axes = [cells[:, i].astype(np.uint8) for i in range(cells.shape[1])]
    # From the coarsest bit down: where a cell's bit is set the curve runs mirrored in the first
    # axis, else this axis and the first change places.
    for bit in range(bits - 1, 0, -1):
        finer = np.uint8((1 << bit) - 1)
        for i, axis in enumerate(axes):
            upper = (axis >> np.uint8(bit)) & np.uint8(1) > 0
            swap = np.where(upper, np.uint8(0), (axes[0] ^ axis) & finer)
            axes[0] = np.where(upper, axes[0] ^ finer, axes[0] ^ swap)
            if i:
                axes[i] = axis ^ swap
    # Gray code.
    for i in range(1, len(axes)):
        axes[i] = axes[i] ^ axes[i - 1]
    last = np.zeros(len(cells), dtype=np.uint8)
    for bit in range(bits - 1, 0, -1):
        upper = (axes[-1] >> np.uint8(bit)) & np.uint8(1) > 0
        last = np.where(upper, last ^ np.uint8((1 << bit) - 1), last)
    code = np.stack(axes, axis=1) ^ last[:, None]
    spread = [(code >> np.uint8(bit)) & np.uint8(1) for bit in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(spread, axis=1), axis=1)


def whole(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, x array<int>) of the vectors that take part."""
    good = vectors.select(named(vec_id).alias("vec_id"), named(embedding).alias("embedding"))
    good = good.where((F.size("embedding") == WIDTH) & finite(F.col("embedding"), BELOW))
    x = F.transform("embedding", lambda c: F.floor(c.cast("double") * SCALE).try_cast("int"))
    return good.select("vec_id", x.alias("x"))


def cell_borders(vectors: DataFrame) -> np.ndarray:
    """For each entry the borders of its cells: mean and steps of the deviation around it."""
    entry = vectors.select(F.posexplode("x").alias("entry", "x"))
    stats = entry.groupBy("entry").agg(F.avg("x").alias("mean"), F.stddev_pop("x").alias("dev"))
    at = np.linspace(-1.0, 1.0, (1 << BITS) - 1) * 0.67
    borders = np.zeros((WIDTH, len(at)))
    for r in stats.collect():
        borders[r.entry] = r.mean + at * r.dev
    return borders


def blocks(vectors: DataFrame) -> DataFrame:
    """(ids, n, x, low, high, total): stored blocks of neighbours on the curve; x holds the
    vectors one after another, total their sum."""
    borders = cell_borders(vectors)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in matrices(batches, 1, WIDTH):
            cells = (x[:, :, None] >= borders).sum(axis=2)
            keys = hilbert_keys(cells, BITS)
            width = keys.shape[1]
            binary = pa.FixedSizeBinaryArray.from_buffers(
                pa.binary(width), len(keys), [None, pa.py_buffer(keys.tobytes())]
            )
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), binary.cast(pa.binary())], ["vec_id", "x", "key"]
            )

    id_field = vectors.schema["vec_id"]
    key_schema = T.StructType(
        [id_field, T.StructField("x", T.ArrayType(T.IntegerType())), T.StructField("key", T.BinaryType())]
    )
    salt = F.xxhash64("vec_id", "x")
    ordered = (
        vectors.mapInArrow(keyed, key_schema)
        .withColumn("salt", salt)
        .repartitionByRange("key", "salt")
        .sortWithinPartitions("key", "salt")
        .select("vec_id", "x")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, some in matrices(batches, 1, WIDTH):
            x = some.astype(np.int64)
            starts = np.arange(0, len(x), BLOCK)
            ends = np.append(starts[1:], len(x))
            borders = pa.array(np.append(starts, len(x)), pa.int32())
            numbers = pa.array(x.ravel(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.ListArray.from_arrays(borders, part.column(0)),
                    pa.array(ends - starts, pa.int32()),
                    pa.ListArray.from_arrays(pa.array(np.append(starts, len(x)) * WIDTH, pa.int32()), numbers),
                    listed(np.minimum.reduceat(x, starts), pa.int32()),
                    listed(np.maximum.reduceat(x, starts), pa.int32()),
                    listed(np.add.reduceat(x, starts), pa.int64()),
                ],
                block_schema.names,
            )

    numbers = T.ArrayType(T.IntegerType())
    block_schema = T.StructType(
        [
            T.StructField("ids", T.ArrayType(id_field.dataType)),
            T.StructField("n", T.IntegerType()),
            T.StructField("x", numbers),
            T.StructField("low", numbers),
            T.StructField("high", numbers),
            T.StructField("total", T.ArrayType(T.LongType())),
        ]
    )
    return stored(ordered.mapInArrow(cut, block_schema), "blocks")


def possible(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """For each box which centroids may be nearest to something in it, ties included."""
    out = np.zeros((len(low), len(centroids)), dtype=bool)
    nearest = np.zeros((len(low), len(centroids)), dtype=np.int64)
    farthest = np.zeros_like(nearest)
    for c, centroid in enumerate(centroids):
        below, above = low - centroid, centroid - high
        nearest[:, c] = (np.maximum(np.maximum(below, above), 0) ** 2).sum(axis=1)
        farthest[:, c] = (np.maximum(np.abs(below), np.abs(above)) ** 2).sum(axis=1)
    out[:] = nearest <= farthest.min(axis=1, initial=np.iinfo(np.int64).max)[:, None]
    return out


def distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of whole vectors (rows) to centroids (columns)."""
    if max(np.abs(x).max(initial=0), np.abs(centroids).max(initial=0)) < EXACT:
        # All products and sums are whole numbers below 2**53, so doubles hold them exactly.
        a, b = x.astype(np.float64), centroids.astype(np.float64)
        found = (a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)
        return found.astype(np.int64)
    return np.stack([((x - c) ** 2).sum(axis=1) for c in centroids], axis=1)


def _numbers(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def next_centroids(zones: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round over all blocks."""
    k = len(centroids)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(k, dtype=np.int64), np.zeros((k, WIDTH), dtype=np.int64)
        for batch in batches:
            n = batch.column(0).to_numpy()
            low, high, total = (_numbers(batch.column(i)).reshape(-1, WIDTH) for i in (2, 3, 4))
            may = possible(low, high, centroids)
            sure = may.sum(axis=1) == 1
            only = may.argmax(axis=1)
            np.add.at(counts, only[sure], n[sure])
            np.add.at(sums, only[sure], total[sure])
            vectors = batch.column(1)
            for block in np.flatnonzero(~sure).tolist():
                x = vectors[block].values.to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, WIDTH)
                left = np.flatnonzero(may[block])
                nearest = left[distances(x, centroids[left]).argmin(axis=1)]
                counts += np.bincount(nearest, minlength=k)
                np.add.at(sums, nearest, x)
        cluster, entry = np.indices((k, WIDTH)).reshape(2, -1)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(cluster, pa.int32()),
                pa.array(entry, pa.int32()),
                pa.array(np.repeat(counts, WIDTH)),
                pa.array(sums.ravel()),
            ],
            ["cluster", "entry", "n", "total"],
        )

    parts = zones.select("n", "x", "low", "high", "total").mapInArrow(
        partial, "cluster int, entry int, n long, total long"
    )
    exact = F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    moved = centroids.copy()
    for r in parts.groupBy("cluster", "entry").agg(F.sum("n").alias("n"), exact).collect():
        if r.n:
            moved[r.cluster, r.entry] = int(r.total) // r.n
    return moved


def assigned(zones: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of every vector in the blocks."""
    schema = T.StructType(
        [
            T.StructField("vec_id", zones.schema["ids"].dataType.elementType),
            T.StructField("cluster", T.IntegerType()),
            T.StructField("distance", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, high = (_numbers(batch.column(i)).reshape(-1, WIDTH) for i in (2, 3))
            may = possible(low, high, centroids)
            for block in range(batch.num_rows):
                x = batch.column(1)[block].values.to_numpy(zero_copy_only=False)
                left = np.flatnonzero(may[block])
                found = distances(x.astype(np.int64).reshape(-1, WIDTH), centroids[left])
                best = found.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[block].values,
                        pa.array(left[best], pa.int32()),
                        pa.array(found[np.arange(len(best)), best]),
                    ],
                    schema.names,
                )

    return zones.select("ids", "x", "low", "high").mapInArrow(run, schema)


def first_centroids(vectors: DataFrame, k: int) -> np.ndarray:
    """The vectors whose ids have the least hashes."""
    order = F.sha2(F.concat(F.lit(SEED), F.col("vec_id").cast("string")), 256)
    rows = vectors.select(order.alias("hash"), "x").orderBy(F.col("hash").asc_nulls_last(), "x").limit(k)
    return np.array([r.x for r in rows.collect()], dtype=np.int64).reshape(-1, WIDTH)


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def clustered(
    vectors: DataFrame,
    *,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    centroids: int = CENTROIDS,
    rounds: int = ROUNDS,
) -> DataFrame:
    """For each vector that takes part: vec_id, cluster, distance (squared), cluster_inertia,
    inertia and centroid_sha256."""
    good = whole(vectors, vec_id, embedding)
    spark = vectors.sparkSession
    middle = first_centroids(good, centroids)
    zones = blocks(good)
    for _ in range(rounds if len(middle) else 0):
        middle = next_centroids(zones, middle)
    found = stored(assigned(zones, middle), "assigned")
    exact = F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")
    inertia = {r.cluster: int(r.inertia) for r in found.groupBy("cluster").agg(exact).collect()}
    # One row for each centroid: as many as were asked for.
    per = [(c, inertia.get(c, 0), sum(inertia.values()), digest(m)) for c, m in enumerate(middle)]
    kinds = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    return found.join(F.broadcast(spark.createDataFrame(per, kinds)), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
