"""Vectors in Arrow batches as NumPy matrices, and which vectors of a table can be used."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Numbers that one matrix holds at most, unless a single vector has more.
PIECE = 1 << 20


def finite(vector: Column, below: float = math.inf) -> Column:
    """Whether a vector is there and all its entries are numbers of a size under ``below``."""
    good = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(below)))
    return F.coalesce(good, F.lit(False))


def usual_width(vectors: DataFrame, column: Column) -> int:
    """The number of entries that most vectors have, the larger of two; 0 if there are none."""
    sizes = vectors.groupBy(F.size(column).alias("width")).agg(F.count("*").alias("n"))
    best = sizes.where("width > 0").agg(F.max_by("width", F.struct("n", "width"))).first()[0]
    return best or 0


def matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Vectors of one width, none with nulls, as rows of doubles."""
    flat = vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    return flat.reshape(len(vectors), width)


def matrices(
    batches: Iterator[pa.RecordBatch], column: int, width: int
) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of the batches with the vectors in ``column`` as a matrix of bounded size."""
    step = max(1, PIECE // max(1, width))
    for batch in batches:
        for first in range(0, batch.num_rows, step):
            part = batch.slice(first, step)
            yield part, matrix(part.column(column), width)


def listed(rows: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """A matrix as an Arrow array of lists."""
    borders = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(borders), pa.array(rows.ravel(), kind))
