"""Suffix-array dedup on sparse suffixes: passages of 50 words or more that stand elsewhere too.

Of all suffixes only those are retained whose first words, a phrase of PHRASE words, have the
least hash of some run of 50 words (a minimiser). The choice depends on the words alone, so every
passage of 50 words selects the same phrase wherever it stands. Retained suffixes whose phrase
occurs again are dealt out by ranges of their words and sorted; each is compared with its two
neighbours, to the right from its phrase on and to the left before it. Where both extensions make
up 50 words, the extended match is a passage of both.

The neighbours of a suffix have its longest match to the right, but not always its longest match in
all: where one document shares more on the right, and another more on the left, or where
neighbours lie on two sides of a range's border, a window of 50 words may still stand elsewhere.
So windows that the neighbours do not cover are looked up exactly, by their hashes, among all
windows of repeated phrases. A map of fixed size tells which these are, so that windows of copies,
which the neighbours do cover, are never listed.

A passage that very many documents share gives equal suffixes. They are dealt out by a hash behind
their words, so that a range's border may lie among them, and each still has two neighbours.

Words are lower-cased runs of letters and digits, compared by 32 bits of their hashes, windows by
64 bits.

Defined results: rows of one id (null included) are one document; what only they share is not
reported, but a passage that occurs twice in one text is. Ids may have any type. Null, empty and
short texts have no passages. Documents without passages have no rows in the result; an empty
table gives none. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wellspark.llm import words as W
from wellspark.llm.decontamination import word_hashes
from wellspark.llm.rows import bitmap, in_bitmap, named, pieces, stored

#: Words of a window, the shortest passage that is reported, and of a phrase.
WINDOW = 50
PHRASE = 12
#: Words before a phrase that a window which selects it can have.
BEFORE = WINDOW - PHRASE
#: Bits of the maps of repeated phrases and of windows to look up. They may let others pass, which
#: are then compared in vain; they never hold one back.
MAP_BITS = 1 << 27
#: Stands for a null id while places are compared.
NO_ID = -(1 << 63)

SUFFIX = "doc long, text long, place int, first int, last int, head binary, tail binary"
COMPARED = "doc long, text long, start int, end int, other long, window long"


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values."""
    reach, least = 1, values
    while 2 * reach <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def short_hashes(hashed: np.ndarray) -> np.ndarray:
    """32 bits of each word's hash, never 0."""
    return np.maximum(hashed >> np.uint64(32), np.uint64(1))


def selected(texts: pa.Array) -> tuple[np.ndarray, ...]:
    """The words (32 bits each) and the first word of each text; and for each window of 50 words
    of a text: the text, its first word and the phrase that it selects (as places among all
    words), and the hash of that phrase."""
    hashed, first = word_hashes(texts)
    words = short_hashes(hashed)
    none = np.zeros(0, dtype=np.int64)
    if len(hashed) < WINDOW:
        return words, first, none, none, none, none.astype(np.uint64)
    rows = W.row_of(first)
    at = np.flatnonzero(rows[: len(hashed) - WINDOW + 1] == rows[WINDOW - 1 :])
    phrases = W.window_hashes(words, PHRASE)
    # Of equal phrases the first is taken: the place fills the lower bits.
    bits = np.uint64(max(1, len(phrases).bit_length()))
    places = np.arange(len(phrases), dtype=np.uint64)
    least = sliding_least((phrases >> bits << bits) | places, BEFORE + 1)[at]
    place = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    return words, first, rows[at], at, place, phrases[place]


def in_own_text(rows: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """Which hashes occur twice or more in their own text."""
    return W.repeated(W.mixed(hashed ^ W.mixed(rows.astype(np.uint64))))


def _retained(rows: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first and the last window that selects each retained phrase."""
    fresh = np.ones(len(rows), dtype=bool)
    fresh[1:] = (place[1:] != place[:-1]) | (rows[1:] != rows[:-1])
    first = np.flatnonzero(fresh)
    return first, np.append(first[1:], len(rows)) - 1 if len(rows) else first


def phrase_rows(texts: pa.Array, doc: np.ndarray, text: np.ndarray) -> list:
    """(doc, phrase, twice) for each suffix that is retained."""
    _, _, rows, _, place, phrase = selected(texts)
    first, _ = _retained(rows, place)
    rows, phrase = rows[first], phrase[first]
    return [doc[rows], phrase.view(np.int64), in_own_text(rows, phrase)]


def _may(held: bytes, hashed: np.ndarray) -> np.ndarray:
    return in_bitmap(held, (hashed & np.uint64(MAP_BITS - 1)).astype(np.int64))


def _packed(matrix: np.ndarray) -> pa.Array:
    """Rows of words as binary values that order like the words."""
    width = 4 * matrix.shape[1]
    data = pa.py_buffer(matrix.astype(">u4").tobytes())
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(matrix), [None, data]).cast(pa.binary())


def suffix_rows(texts: pa.Array, doc: np.ndarray, text: np.ndarray, repeated: bytes) -> list:
    """For each retained suffix whose phrase may be repeated: doc, text, the phrase's place in the
    text, how far before it the first and the last window that selects it begin, the words from
    it on (``head``) and those before it, backwards (``tail``); 0 past the ends of the text."""
    words, begin, rows, at, place, phrase = selected(texts)
    first, last = _retained(rows, place)
    again = _may(repeated, phrase[first])
    first, last = first[again], last[again]
    rows, where = rows[first], place[first]
    padded = np.append(words, np.uint64(0))
    ahead = where[:, None] + np.arange(WINDOW)
    head = padded[np.where(ahead < begin[rows + 1][:, None], ahead, len(words))]
    behind = where[:, None] - 1 - np.arange(BEFORE)
    tail = padded[np.where(behind >= begin[rows][:, None], behind, len(words))]
    return [
        doc[rows], text[rows], (where - begin[rows]).astype(np.int32),
        (where - at[first]).astype(np.int32), (where - at[last]).astype(np.int32),
        _packed(head), _packed(tail),
    ]


def window_rows(texts: pa.Array, doc: np.ndarray, text: np.ndarray, repeated: bytes, asked: bytes) -> list:
    """(doc, text, start, window, twice) for each window whose phrase may be repeated and which
    may be one that is looked up."""
    words, begin, rows, at, _, phrase = selected(texts)
    window = W.range_hashes(words, at, at + WINDOW)
    some = _may(repeated, phrase) & _may(asked, window)
    rows, at, window = rows[some], at[some], window[some]
    start = (at - begin[rows]).astype(np.int32)
    return [doc[rows], text[rows], start, window.view(np.int64), in_own_text(rows, window)]


def _agreeing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words rows of two matrices have in common from their beginning."""
    same = (a == b) & (a != 0)
    return np.where(same.all(axis=1), same.shape[1], np.argmin(same, axis=1))


def compared(batch: pa.RecordBatch, low: int, high: int) -> pa.RecordBatch:
    """What the neighbours tell of the sorted suffixes ``low`` to ``high`` of a batch: passages
    (start, end, other), and windows (their hashes) that they do not cover."""
    doc, text, place, first, last = (batch.column(i).to_numpy() for i in range(5))
    n = batch.num_rows

    def words(column: int, width: int) -> np.ndarray:
        data = b"".join(batch.column(column).to_pylist())
        return np.frombuffer(data, dtype=">u4").reshape(n, width).astype(np.uint32)

    head, tail = words(5, WINDOW), words(6, BEFORE)
    right, left = _agreeing(head[1:], head[:-1]), _agreeing(tail[1:], tail[:-1])
    own_text = (doc[1:] == doc[:-1]) & (text[1:] == text[:-1]) & (place[1:] != place[:-1])
    match = ((doc[1:] != doc[:-1]) | own_text) & (left + right >= WINDOW)
    offsets = np.arange(BEFORE + 1)
    within = (offsets <= first[:, None]) & (offsets >= last[:, None])
    covered = np.zeros((n, BEFORE + 1), dtype=bool)
    spans = []
    # Of each two neighbours the upper one learns of the lower one, and the other way round.
    for me, other in ((np.arange(1, n), np.arange(n - 1)), (np.arange(n - 1), np.arange(1, n))):
        me, other, back, ahead = me[match], other[match], left[match], right[match]
        covered[me] |= (offsets <= back[:, None]) & (WINDOW - offsets <= ahead[:, None])
        mine = (me >= low) & (me < high)
        spans.append((me[mine], other[mine], back[mine], ahead[mine]))
    me, other, back, ahead = (np.concatenate(x) for x in zip(*spans))
    rest = within & ~covered
    rest[:low] = rest[high:] = False
    row, offset = np.nonzero(rest)
    line = np.concatenate([tail[:, ::-1], head], axis=1).astype(np.uint64)
    starts = row * line.shape[1] + BEFORE - offset
    asked = W.range_hashes(line.ravel(), starts, starts + WINDOW).view(np.int64)
    passages = [
        pa.array(doc[me]),
        pa.array(text[me]),
        pa.array(place[me] - back, pa.int32()),
        pa.array(place[me] + ahead, pa.int32()),
        pa.array(doc[other], mask=doc[other] == doc[me]),
    ]
    columns = [pa.concat_arrays([c, pa.nulls(len(row), c.type)]) for c in passages]
    columns.append(pa.concat_arrays([pa.nulls(len(me), pa.int64()), pa.array(asked)]))
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in COMPARED.split(", ")])


def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compares sorted suffixes with the ones before and after them, across batches too."""
    held, known = None, 0
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            part = batch.slice(at, 4096)
            if held is not None:
                part = pa.Table.from_batches([held, part]).combine_chunks().to_batches()[0]
            # The last suffix waits for its second neighbour, and keeps its first one.
            yield compared(part, known, part.num_rows - 1)
            keep = min(2, part.num_rows)
            held, known = part.slice(part.num_rows - keep), keep - 1
    if held is not None:
        yield compared(held, known, held.num_rows)


def flattened(docs: DataFrame, make, schema: str) -> DataFrame:
    """Rows that ``make`` gives for pieces of (said, doc, text)."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        for batch in batches:
            texts = pa.compute.fill_null(batch.column(0), "")
            doc, text = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for first, last in pieces(texts):
                made = make(texts.slice(first, last - first), doc[first:last], text[first:last])
                yield pa.RecordBatch.from_arrays([a if isinstance(a, pa.Array) else pa.array(a) for a in made], names)

    return docs.mapInArrow(run, schema)


def looked_up(sent: DataFrame, asked: DataFrame, repeated) -> DataFrame:
    """(doc, text, start, end, other) of the windows in ``asked`` that stand in two documents, or
    twice in one text."""
    context = sent.sparkSession.sparkContext
    bit = F.col("window").bitwiseAND(F.lit(MAP_BITS - 1)).alias("bit")
    wanted = context.broadcast(bitmap(asked.select(bit), "bit", MAP_BITS))
    windows = stored(
        flattened(
            sent, lambda texts, doc, text: window_rows(texts, doc, text, repeated.value, wanted.value),
            "doc long, text long, start int, window long, twice boolean",
        ),
        "windows",
    )
    shared = (
        windows.groupBy("window")
        .agg(F.min("doc").alias("low"), F.max("doc").alias("high"))
        .where("low <> high")
        # Another form of the key: both sides are dealt out for the join, and hot windows split.
        .select(F.bitwise_not("window").alias("key"), "low", "high")
    )
    other = F.when(F.col("low") != F.col("doc"), F.col("low")).otherwise(F.col("high"))
    return (
        windows.withColumn("key", F.bitwise_not("window"))
        .drop("window")
        .join(shared, "key", "left")
        .where("twice or low is not null")
        .select("doc", "text", "start", (F.col("start") + WINDOW).alias("end"), other.alias("other"))
    )


def joined(spans: DataFrame) -> DataFrame:
    """(doc, start, end, other): the spans of each text, where they overlap or touch as one; the
    other document is that of the first of them."""

    def run(batches):
        for batch in batches:
            lists = batch.column(1)
            flat = lists.flatten()
            row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            start, end = (flat.field(i).to_numpy().astype(np.int64) for i in (0, 1))
            order = np.lexsort((-end, start, row))
            row, start, end = row[order], start[order], end[order]
            # Ends of one text lie above those of the texts before it.
            step = int(end.max(initial=0)) + 2
            reach = np.maximum.accumulate(end + row * step)
            fresh = np.ones(len(row), dtype=bool)
            fresh[1:] = (row[1:] != row[:-1]) | (start[1:] + row[1:] * step > reach[:-1])
            begin = np.flatnonzero(fresh)
            last = np.append(begin[1:], len(row)) - 1 if len(row) else begin
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row[begin])),
                    pa.array(start[begin]),
                    pa.array((reach[last] - row[last] * step)),
                    flat.field(2).take(pa.array(order[begin])),
                ],
                ["doc", "start", "end", "other"],
            )

    lists = spans.groupBy("doc", "text").agg(F.collect_list(F.struct("start", "end", "other")).alias("spans"))
    return lists.select("doc", "spans").mapInArrow(run, "doc long, start long, end long, other long")


def passages(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, start_word, end_word (exclusive), n_words and other_doc_id (a document that holds
    the beginning of the passage too; null if only the text itself does) of every passage."""
    context = docs.sparkSession.sparkContext
    said, given = named(text).cast("string"), named(doc_id)
    whole = isinstance(docs.schema[doc_id].dataType, T.IntegralType)
    number = given.cast("long") if whole else F.when(given.isNotNull(), F.xxhash64(given))
    sent = docs.select(
        said.alias("said"),
        F.coalesce(number, F.lit(NO_ID)).alias("doc"),
        F.xxhash64(F.coalesce(said, F.lit(""))).alias("text"),
    )
    heads = (
        flattened(sent, phrase_rows, "doc long, phrase long, twice boolean")
        .groupBy("phrase")
        .agg(F.min("doc").alias("low"), F.max("doc").alias("high"), F.max("twice").alias("twice"))
        .where("low <> high or twice")
        .select(F.col("phrase").bitwiseAND(F.lit(MAP_BITS - 1)).alias("bit"))
    )
    repeated = context.broadcast(bitmap(heads, "bit", MAP_BITS))
    suffixes = flattened(
        sent, lambda texts, doc, row: suffix_rows(texts, doc, row, repeated.value), SUFFIX
    ).withColumn("salt", F.xxhash64("doc", "text", "place"))
    ordered = suffixes.repartitionByRange("head", "salt").sortWithinPartitions("head", "salt").drop("salt")
    found = stored(ordered.mapInArrow(neighbours, COMPARED), "neighbours")
    matched = found.where("doc is not null").drop("window")
    rest = looked_up(sent, found.where("window is not null").select("window"), repeated)
    spans = joined(matched.unionByName(rest))
    if whole:
        names = lambda c: F.when(F.col(c) != NO_ID, F.col(c)).cast(docs.schema[doc_id].dataType)
    else:
        # The numbers of ids that are no numbers, for what is left.
        ids = docs.where(given.isNotNull()).select(F.xxhash64(given).alias("n"), given.alias("id")).distinct()
        spans = spans.join(ids.select(F.col("n").alias("doc"), F.col("id").alias("doc_name")), "doc", "left")
        spans = spans.join(ids.select(F.col("n").alias("other"), F.col("id").alias("other_name")), "other", "left")
        names = lambda c: F.col(f"{c}_name")
    return spans.select(
        names("doc").alias("doc_id"),
        F.col("start").alias("start_word"),
        F.col("end").alias("end_word"),
        (F.col("end") - F.col("start")).alias("n_words"),
        names("other").alias("other_doc_id"),
    ).distinct()
