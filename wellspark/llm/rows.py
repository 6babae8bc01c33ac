"""Running a NumPy function over the whole texts of a DataFrame, and small table helpers.

Texts arrive as Arrow buffers, so words are handled as byte ranges and 64-bit hashes, never as
one Python object each. A task holds one Arrow batch and works on it in pieces of a bounded
number of bytes (or one text, if that alone is longer).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wellspark.sources.storage import shared_dir

#: Bytes of text that one call of a row function gets, unless a single text is longer.
PIECE_BYTES = 1 << 20
SENT = "__text"
#: Tasks that a table of few rows is worked on in, at least.
LEAST_TASKS = 4


def named(column: str) -> Column:
    """The column of exactly this name, dots and blanks included."""
    return F.col("`" + column.replace("`", "``") + "`")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where the body is a loop over an array."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The DataFrame written to the shared folder and read again: computed once, and safe from
    lost executors."""
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_tasks(df: DataFrame, rows: int, each: int) -> DataFrame:
    """``df`` in one task for ``each`` of its ``rows`` rows, if it has more tasks than that.

    So a shuffle of few rows does not become very many tasks and files, however many partitions
    the session deals out to. ``rows`` may be an upper bound; of a join, they are those of the
    larger side.
    """
    return df.coalesce(max(LEAST_TASKS, -(-rows // each)))


def checkpoint_folder(spark: SparkSession) -> None:
    """Lets ``checkpoint()`` use the shared folder where the session has not been told yet."""
    if spark.sparkContext.getCheckpointDir() is None:
        base = spark.conf.get("spark.checkpoint.dir", None)
        spark.sparkContext.setCheckpointDir(base or shared_dir(spark, "checkpoints"))


def bitmap(numbers: DataFrame, column: str, bits: int) -> bytes:
    """A map of ``bits`` bits of which numbers from 0 to ``bits`` - 1 occur in ``column``.

    Its size is fixed, whatever the number of rows; built in parts of 4 KB, in parallel.
    """
    from_one = named(column) + 1
    parts = (
        numbers.groupBy(F.bitmap_bucket_number(from_one).alias("part"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(from_one)).alias("bits"))
        .collect()
    )
    out = np.zeros((max(bits, 1 << 15) >> 15, 1 << 12), dtype=np.uint8)
    for row in parts:
        out[row.part - 1] = np.frombuffer(row.bits, dtype=np.uint8)
    return out.tobytes()


def in_bitmap(held: bytes, numbers: np.ndarray) -> np.ndarray:
    """Which of the numbers are in a map made by ``bitmap``."""
    flags = np.frombuffer(held, dtype=np.uint8)
    return (flags[numbers >> 3] >> (numbers & 7).astype(np.uint8)) & 1 > 0


def pieces(texts: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes of text, or of one row."""
    sizes = pa.compute.binary_length(texts).to_numpy(zero_copy_only=False)
    first, held = 0, 0
    for row, size in enumerate(sizes.tolist()):
        if row > first and held + size > limit:
            yield first, row
            first, held = row, 0
        held += size
    if first < len(texts):
        yield first, len(texts)


def with_result(
    docs: DataFrame,
    column: str,
    fields: T.StructType,
    compute: Callable[[pa.Array], Sequence[pa.Array]],
    *,
    text: str = "text",
    keep: Sequence[str] | None = None,
    limit: int = PIECE_BYTES,
) -> DataFrame:
    """``docs`` (or its columns ``keep``) and a struct ``column`` computed from each whole text.

    ``compute`` gets an Arrow string array without nulls (a null text is the empty text) and
    returns one array per field. A column of ``docs`` that has the name of the result is
    replaced. Rows stay where they are: no shuffle.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c != column]
    inside = text in keep and isinstance(docs.schema[text].dataType, T.StringType)
    # Plain names on the way to Python: mapInArrow looks its columns up by unquoted name.
    sent = [named(c).alias(f"c{i}") for i, c in enumerate(keep)]
    if not inside:
        sent.append(named(text).cast("string").alias(SENT))
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(column, fields)])
    place = keep.index(text) if inside else len(keep)
    names = [*keep, column]
    kinds = pa.struct([pa.field(f.name, _arrow(f.dataType)) for f in fields.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.compute.fill_null(batch.column(place), "")
            for first, last in pieces(texts, limit):
                arrays = compute(texts.slice(first, last - first))
                made = pa.StructArray.from_arrays(
                    [pa.array(a).cast(k.type) for a, k in zip(arrays, kinds)], fields=list(kinds)
                )
                kept = [batch.column(i).slice(first, last - first) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*kept, made], names=names)

    return docs.select(*sent).mapInArrow(run, schema)


def _arrow(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow(kind.elementType))
    if isinstance(kind, T.StructType):
        return pa.struct([pa.field(f.name, _arrow(f.dataType)) for f in kind.fields])
    return {
        "long": pa.int64(),
        "integer": pa.int32(),
        "double": pa.float64(),
        "boolean": pa.bool_(),
        "string": pa.string(),
        "binary": pa.binary(),
    }[kind.typeName()]
