"""Approximate nearest neighbours by a forest of random-projection trees.

A tree halves a bounded sample of the vectors, at the median of a projection, level by level; the
projections are drawn at random and turned once towards where a node's vectors spread most. Every
vector of the table has a leaf in each tree. A query walks all trees through one shared priority
queue: the node whose borders it misses by least (sum of squares) comes next, whatever its tree,
until a number of leaves has been reached. All vectors of those leaves are compared with the query
exactly.

How many leaves that are is measured, not guessed: queries from the sample are searched in the
sample, and the least number that finds TARGET of their true neighbours is taken. In a larger
table neighbours are nearer than in its sample, so recall over the table is rather higher.

Equal vectors are one point, with the few least ids that a result can need, so copies are neither
indexed nor compared one by one. A leaf with many points or queries is cut into groups of bounded
size by hash, and each group of points meets each group of queries in a task of its own; each
query leaves a group with ``k`` + 1 points at most.

Defined results: vectors that are null, zero, hold null, NaN or infinite entries, or have another
width than most (of two as frequent, the larger) take no part, neither as queries nor as
candidates. Ties go to the smaller id, a null id is the largest. A query's own row is left out,
once: another row of the same id and vector is a candidate, and a repeated query row returns its
neighbours again. With fewer candidates than ``k`` all of them are returned. Empty tables give
no rows. Only the named columns are read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wellspark.llm.rows import named, stored
from wellspark.llm.vectors import PIECE, finite, matrices, matrix, usual_width

NEIGHBOURS = 10
TREES = 4
#: Vectors that the trees and the number of leaves are fitted on, about.
SAMPLE = 8192
#: Points that a leaf is to hold, and the most levels of a tree; a sample's leaf holds 8 at least.
LEAF = 512
LEVELS = 10
#: Sample queries, and the share of their neighbours that must be found.
PROBES = 256
TARGET = 0.96
#: Points and queries that meet in one group.
POINTS = 8192
QUERIES = 4096
SEED = 12


@dataclass(frozen=True)
class Forest:
    """Projections (tree, inner node, entry), their borders, and the number of leaves to visit."""

    directions: np.ndarray
    borders: np.ndarray
    visits: int

    @property
    def inner(self) -> int:
        return self.borders.shape[1]

    @property
    def leaves(self) -> int:
        return self.inner + 1

    def margins(self, vectors: np.ndarray) -> np.ndarray:
        """(vector, tree, inner node): how far a vector lies above the border."""
        flat = self.directions.reshape(-1, vectors.shape[1])
        return (vectors @ flat.T - self.borders.ravel()).reshape(len(vectors), len(self.borders), self.inner)

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        """(vector, tree): the leaf of each vector in each tree, numbered over all trees."""
        margins = self.margins(vectors)
        trees = np.arange(len(self.borders))
        node = np.zeros((len(vectors), len(trees)), dtype=np.int64)
        for _ in range(self.leaves.bit_length() - 1):
            above = margins[np.arange(len(vectors))[:, None], trees, node] >= 0
            node = 2 * node + 1 + above
        return node - self.inner + trees * self.leaves

    def visited(self, margins: np.ndarray, visits: int) -> list[int]:
        """Cells in the order in which the shared queue reaches them, for one query."""
        rows = margins.tolist()
        queue = [(0.0, tree, 0) for tree in range(len(rows))]
        found = []
        while queue and len(found) < visits:
            missed, tree, node = heapq.heappop(queue)
            own = rows[tree]
            while node < self.inner:
                margin = own[node]
                near = 2 * node + 1 + (margin >= 0)
                heapq.heappush(queue, (missed + margin * margin, tree, 4 * node + 3 - near))
                node = near
            found.append(tree * self.leaves + node - self.inner)
        return found


def grown(sample: np.ndarray, levels: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Directions and borders of one tree over the sample."""
    inner = (1 << levels) - 1
    directions, borders = np.zeros((inner, sample.shape[1])), np.zeros(inner)
    node = np.zeros(len(sample), dtype=np.int64)
    for at in range(inner):
        members = np.flatnonzero(node == at)
        some = sample[members]
        direction = rng.standard_normal(sample.shape[1])
        spread = some - some.mean(axis=0)
        turned = spread.T @ (spread @ direction)
        if np.linalg.norm(turned) > 0:
            direction = turned
        directions[at] = direction / np.linalg.norm(direction)
        place = some @ directions[at]
        borders[at] = np.median(place)
        node[members] = 2 * at + 1 + (place >= borders[at])
    return directions, borders


def planted(sample: np.ndarray, points: int, k: int = NEIGHBOURS, target: float = TARGET) -> Forest:
    """The forest for a table of ``points`` different vectors, of which ``sample`` is a part."""
    rng = np.random.default_rng(SEED)
    wanted = math.ceil(math.log2(max(1.0, points / LEAF)))
    levels = max(0, min(wanted, LEVELS, int(math.log2(max(1, len(sample) // 8)))))
    trees = [grown(sample, levels, rng) for _ in range(TREES if levels else 1)]
    forest = Forest(np.stack([d for d, _ in trees]), np.stack([b for _, b in trees]), 1)
    everything = forest.leaves * len(trees)
    if not levels:
        return forest
    probes = rng.choice(len(sample), min(PROBES, len(sample)), replace=False)
    cells = forest.cells(sample)
    margins = forest.margins(sample[probes])
    needed = []
    for probe, margin in zip(probes.tolist(), margins):
        away = ((sample - sample[probe]) ** 2).sum(axis=1)
        away[probe] = np.inf
        true = np.argsort(away, kind="stable")[: min(k, len(sample) - 1)]
        reached = np.zeros(everything, dtype=np.int64)
        reached[forest.visited(margin, everything)] = np.arange(1, everything + 1)
        needed.extend(reached[cells[true]].min(axis=1).tolist())
    visits = int(np.sort(needed)[math.ceil(target * len(needed)) - 1])
    return Forest(forest.directions, forest.borders, visits)


def distinct_points(vectors: DataFrame, k: int) -> DataFrame:
    """(point, ids, embedding): each different vector once, with its ``k`` + 1 least ids."""
    ranks = Window.partitionBy("embedding").orderBy(F.col("vec_id").asc_nulls_last())
    # Spark keeps k + 1 rows of a vector in each task before it deals them out.
    least = vectors.withColumn("rank", F.row_number().over(ranks)).where(F.col("rank") <= k + 1)
    ids = F.transform(F.array_sort(F.collect_list(F.struct("rank", "vec_id"))), lambda s: s["vec_id"])
    points = least.groupBy("embedding").agg(ids.alias("ids"))
    return stored(points.select(F.monotonically_increasing_id().alias("point"), "ids", "embedding"), "points")


def _per_cell(frame: DataFrame, forest: Forest, width: int, search: bool) -> dict[int, int]:
    """How many rows of ``frame`` (embedding) have, or search, each cell."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(forest.leaves * len(forest.borders), dtype=np.int64)
        for _, some in matrices(batches, 0, width):
            if search:
                for margin in forest.margins(some):
                    total[forest.visited(margin, forest.visits)] += 1
            else:
                total += np.bincount(forest.cells(some).ravel(), minlength=len(total))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], ["cell", "n"])

    cells = frame.select("embedding").mapInArrow(count, "cell int, n long")
    # At most TREES * 2 ** LEVELS rows.
    return {r.cell: r.n for r in cells.groupBy("cell").agg(F.sum("n").alias("n")).collect()}


def _spread(frame: DataFrame, forest: Forest, width: int, own: dict, other: dict, search: bool) -> DataFrame:
    """Rows for each group of a cell in which a point or a query meets the other kind.

    ``own`` and ``other`` tell into how many parts a cell's rows of this kind, and those they
    meet, are cut.
    """
    schema = T.StructType(
        [T.StructField(c, T.IntegerType()) for c in ("cell", "points_part", "queries_part")]
        + [T.StructField("is_query", T.BooleanType()), *frame.schema.fields]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, some in matrices(batches, 2, width):
            if search:
                cells = [forest.visited(m, forest.visits) for m in forest.margins(some)]
            else:
                cells = forest.cells(some).tolist()
            keys = part.column(0).to_pylist()
            row, cell, mine, theirs = [], [], [], []
            for i, (key, mine_cells) in enumerate(zip(keys, cells)):
                for c in mine_cells:
                    for o in range(other.get(c, 0)):
                        row.append(i)
                        cell.append(c)
                        mine.append(key % own[c])
                        theirs.append(o)
            parts = (theirs, mine) if search else (mine, theirs)
            kept = part.take(pa.array(row, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(cell, pa.int32()),
                    pa.array(parts[0], pa.int32()),
                    pa.array(parts[1], pa.int32()),
                    pa.array([search] * len(row), pa.bool_()),
                    *kept.columns,
                ],
                schema.names,
            )

    return frame.mapInArrow(run, schema)


def _nearest_in_group(k: int, width: int):
    """For each query of a group its ``k`` + 1 nearest points there, by exact distance."""

    def run(group: pa.Table) -> pa.Table:
        asks = group.column("is_query").combine_chunks()
        ids = group.column("ids").combine_chunks()
        keys = group.column("point").to_numpy()
        vectors = group.column("embedding").combine_chunks()
        asking = asks.to_numpy(zero_copy_only=False)
        q_at, p_at = np.flatnonzero(asking), np.flatnonzero(~asking)
        q = matrix(vectors.take(pa.array(q_at)), width)
        p = matrix(vectors.take(pa.array(p_at)), width)
        most = min(k + 1, len(p))
        out: tuple[list, list, list] = ([], [], [])
        length = (p * p).sum(axis=1)
        first_id = [x[0] for x in ids.take(pa.array(p_at)).to_pylist()] if len(p) else []
        for start in range(0, len(q) if most else 0, max(1, PIECE // max(1, len(p)))):
            some = q[start : start + max(1, PIECE // len(p))]
            own = (some * some).sum(axis=1)
            about = own[:, None] - 2 * (some @ p.T) + length
            # The products are rounded, so what is near the border is compared exactly too.
            border = np.partition(about, most - 1, axis=1)[:, most - 1] + 1e-9 * (own + length.max())
            for i, row in enumerate(about):
                close = np.flatnonzero(row <= border[i])
                exact = np.sqrt(((p[close] - some[i]) ** 2).sum(axis=1)).tolist()
                ranked = sorted(
                    (d, first_id[c] is None, first_id[c] or 0, c) for d, c in zip(exact, close.tolist())
                )
                for d, _, _, c in ranked[:most]:
                    out[0].append(q_at[start + i])
                    out[1].append(p_at[c])
                    out[2].append(d)
        left, right = pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64())
        return pa.table(
            {
                "query": pa.array(keys).take(left),
                "point": pa.array(keys).take(right),
                "score": pa.array(out[2], pa.float64()),
                "ids": ids.take(right),
            }
        )

    return run


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    *,
    k: int = NEIGHBOURS,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    target: float = TARGET,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` (which are rows of
    ``vectors``) its ``k`` nearest found among all other rows, by Euclidean distance."""
    picked = (named(vec_id).alias("vec_id"), named(embedding).alias("embedding"))
    there = finite(F.col("embedding")) & F.exists("embedding", lambda x: x != 0)
    rows = vectors.select(*picked).where(there)
    width = usual_width(rows, F.col("embedding"))
    rows = rows.where((F.size("embedding") == width) & (F.size("embedding") > 0))
    asked = queries.select(*picked).where(there & (F.size("embedding") == width))
    points = distinct_points(rows, k)
    asking = stored(
        asked.select("embedding")
        .distinct()
        .select(
            F.monotonically_increasing_id().alias("point"),
            F.array().cast(points.schema["ids"].dataType).alias("ids"),
            "embedding",
        ),
        "queries",
    )
    n = points.count()
    share = int(min(1.0, SAMPLE / max(1, n)) * (1 << 30))
    part = points.where(F.pmod(F.xxhash64("embedding"), F.lit(1 << 30)) < share).select("embedding")
    sample = np.array([r.embedding for r in part.collect()], dtype=np.float64).reshape(-1, max(1, width))
    if not len(sample):
        # Without points, or so few that none was drawn: one leaf holds them all.
        sample = np.zeros((1, max(1, width)))
    forest = planted(sample, n, k, target)
    held = {c: math.ceil(x / POINTS) for c, x in _per_cell(points, forest, width, False).items()}
    met = {c: math.ceil(x / QUERIES) for c, x in _per_cell(asking, forest, width, True).items()}
    meeting = _spread(points, forest, width, held, met, False).unionByName(
        _spread(asking, forest, width, met, held, True)
    )
    found_schema = T.StructType(
        [
            T.StructField("query", T.LongType()),
            T.StructField("point", T.LongType()),
            T.StructField("score", T.DoubleType()),
            points.schema["ids"],
        ]
    )
    found = (
        meeting.groupBy("cell", "points_part", "queries_part")
        .applyInArrow(_nearest_in_group(k, width), found_schema)
        .groupBy("query", "point")
        .agg(F.first("score").alias("score"), F.first("ids").alias("ids"))
    )
    ranks = Window.partitionBy("query").orderBy("score", F.col("vec_id").asc_nulls_last())
    best = (
        found.select("query", "score", F.explode("ids").alias("vec_id"))
        .withColumn("rank", F.row_number().over(ranks))
        .where(F.col("rank") <= k + 1)
        .groupBy("query")
        .agg(F.array_sort(F.collect_list(F.struct("rank", "score", "vec_id"))).alias("near"))
    )
    best = asking.select(F.col("point").alias("query"), "embedding").join(best, "query")
    own = F.array_position(
        F.transform("near", lambda x: F.struct(x["score"].alias("score"), x["vec_id"].alias("vec_id"))),
        F.struct(F.lit(0.0).alias("score"), F.col("query_id").alias("vec_id")),
    )
    others = F.slice(F.filter("near", lambda x, i: i + 1 != F.col("own")), 1, k)
    return (
        asked.select(F.col("vec_id").alias("query_id"), "embedding")
        .join(best.select("embedding", "near"), "embedding")
        .withColumn("own", F.coalesce(own, F.lit(0)))
        .select("query_id", F.posexplode(others).alias("place", "near"))
        .select("query_id", (F.col("place") + 1).alias("rank"), "near.vec_id", "near.score")
    )
