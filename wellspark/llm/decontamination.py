"""Benchmark decontamination: suffix arrays over the training texts, searched by test suffixes.

Each task builds the suffix array of a shard of documents and looks up every suffix of every
benchmark item by binary search. A window is 13 consecutive words of an item (all of a shorter
item); the places found are marked as hit, joined along their diagonals into the longest verbatim
matches, and counted per document. Documents stay whole in their shard, so nothing is shuffled.

Spark deals the benchmark's items out to blocks of some BLOCK_BYTES. One block at a time is
broadcast and searched against every document, and what it has hit is written down by text; hits
of several blocks are joined for each text, and its documents take the result by the text's hash.
So no task and no step of the driver holds more than one block. With a single block the documents
have their result at once.

Defined results: null and empty texts have no words, no hits and are not contaminated; items
without words, or without an id, match nothing; repeated items and ids count once; repeated
documents are judged one by one. An empty benchmark contaminates nothing. A column named like
the result is replaced. Words are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wellspark.llm import words as W
from wellspark.llm.rows import named, stored, with_result
from wellspark.llm.suffixes import SuffixArray, expanded

#: Words of a window, and hits per word from which on a document is contaminated.
WINDOW = 13
ONE_IN = 20
#: Bytes of benchmark text in one broadcast block, about, unless a single item is longer.
BLOCK_BYTES = 6 << 20
#: Bytes of documents in one suffix array, unless a single text is longer.
SHARD_BYTES = 3 << 20

FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("n_items", T.LongType()),
        T.StructField("items_sha256", T.StringType()),
        T.StructField("contaminated", T.BooleanType()),
        T.StructField("longest_item", T.StringType()),
        T.StructField("longest_item_word", T.LongType()),
        T.StructField("longest_doc_word", T.LongType()),
        T.StructField("longest_words", T.LongType()),
    ]
)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of letters and digits, and the first word of each text."""
    data, borders = W.buffers(texts)
    data = W.LOWER[data]
    starts, ends, first = W.runs(W.LETTERS_DIGITS[data], borders)
    return W.hashes(data, starts, ends), first


@dataclass
class Block:
    """Items' words one after another, and the suffixes that are searched: where each starts
    among the words, its item, its place in the item, and the words of its window."""

    words: np.ndarray
    start: np.ndarray
    item: np.ndarray
    place: np.ndarray
    length: np.ndarray
    names: list[str]


def block_of(names: list[str], texts: list[str]) -> Block:
    hashed, first = word_hashes(pa.array(texts, pa.string()))
    item = W.row_of(first)
    place = np.arange(len(hashed)) - first[item]
    size = np.diff(first)[item]
    begins = (place + WINDOW <= size) | (place == 0)
    at = np.flatnonzero(begins)
    return Block(hashed, at, item[at], place[at], np.minimum(size[at], WINDOW), names)


def blocks(benchmark: DataFrame, item_id: str, text: str) -> tuple[DataFrame, int]:
    """(block, item_id, text): each item once, stored, and the number of blocks."""
    items = benchmark.where(named(item_id).isNotNull() & named(text).isNotNull()).select(
        named(item_id).cast("string").alias("item_id"), named(text).cast("string").alias("text")
    )
    items = stored(items.distinct(), "items")
    size = items.agg(F.sum(F.octet_length("text") + F.octet_length("item_id"))).first()[0] or 0
    # Half full on average, so that few are more than full.
    n = -(-2 * size // BLOCK_BYTES) if size > BLOCK_BYTES else 1
    return items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n))), n


def occurrences(array: SuffixArray, vocabulary: np.ndarray, block: Block):
    """(suffix of the block, place in the shard) for each occurrence of each window."""
    rank = np.searchsorted(vocabulary, block.words)
    rank = np.minimum(rank, max(0, len(vocabulary) - 1))
    ranks = np.where(vocabulary[rank] == block.words, rank + 1, -1)
    ranks = np.concatenate([ranks, np.full(WINDOW, -1)])
    patterns = ranks[block.start[:, None] + np.arange(WINDOW)]
    low, high = array.ranges(patterns, block.length)
    which, member = expanded(low, high)
    return which, array.order[member]


@dataclass
class Hits:
    """What a block has hit in some texts: all words one after another and which are hit, the
    first word of each text, the names of the items in each text, and its longest match."""

    marked: np.ndarray
    first: np.ndarray
    items: dict[int, set[str]]
    longest: list[tuple[int, str, int, int]]


def search(texts: pa.Array, block: Block) -> Hits:
    hashed, first = word_hashes(texts)
    n_texts, n_words = len(texts), np.diff(first)
    longest = [(0, "", 0, 0)] * n_texts
    if not len(hashed):
        return Hits(np.zeros(0, dtype=bool), first, {}, longest)
    vocabulary, inverse = np.unique(hashed, return_inverse=True)
    # Places with a 0 after each text.
    spread = np.arange(len(hashed)) + W.row_of(first)
    ranks = np.zeros(len(hashed) + n_texts, dtype=np.int64)
    ranks[spread] = inverse + 1
    text_of = np.repeat(np.arange(n_texts), n_words + 1)
    begin_of = first[:-1] + np.arange(n_texts)
    array = SuffixArray(ranks, len(vocabulary), WINDOW)
    suffix, place = occurrences(array, vocabulary, block)
    hit = np.bincount(place, minlength=len(ranks) + 1)
    hit -= np.bincount(place + block.length[suffix], minlength=len(ranks) + 1)
    items: dict[int, set[str]] = {}
    if len(suffix):
        text = text_of[place]
        for code in np.unique(text * len(block.names) + block.item[suffix]).tolist():
            items.setdefault(code // len(block.names), set()).add(block.names[code % len(block.names)])
        _join_matches(block, suffix, place, text, begin_of, longest)
    return Hits((np.cumsum(hit)[:-1] > 0)[spread], first, items, longest)


def searched(texts: pa.Array, block: Block) -> list:
    """The fields of FOUND for each text."""
    hits = search(texts, block)
    n_texts, n_words = len(texts), np.diff(hits.first)
    n_hit = W.sums_by_text(hits.marked, hits.first)
    none = hashlib.sha256(b"").hexdigest()
    digests = [none] * n_texts
    n_items = np.zeros(n_texts, dtype=np.int64)
    for text, found in hits.items.items():
        n_items[text] = len(found)
        digests[text] = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    longest = hits.longest
    return [
        n_words,
        n_hit,
        n_items,
        digests,
        (n_hit > 0) & (ONE_IN * n_hit >= n_words),
        [m[1] if m[0] else None for m in longest],
        [m[2] if m[0] else None for m in longest],
        [m[3] if m[0] else None for m in longest],
        [m[0] for m in longest],
    ]


PART = T.StructType(
    [
        T.StructField("spans", T.ArrayType(T.LongType())),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("item", T.StringType()),
        T.StructField("item_word", T.LongType()),
        T.StructField("doc_word", T.LongType()),
        T.StructField("words", T.LongType()),
    ]
)


def part_of(texts: pa.Array, block: Block) -> list:
    """The fields of PART for each text: starts and ends of the runs of words hit, by turns."""
    hits = search(texts, block)
    starts, ends, first = W.runs(hits.marked, hits.first)
    borders = np.stack([starts, ends], axis=1) - hits.first[W.row_of(first)][:, None]
    lists = pa.ListArray.from_arrays(pa.array(2 * first, pa.int32()), pa.array(borders.ravel()))
    longest = hits.longest
    return [
        lists,
        pa.array([sorted(hits.items.get(i, ())) for i in range(len(texts))], pa.list_(pa.string())),
        *[pa.array([m[k] for m in longest], pa.string() if k == 1 else pa.int64()) for k in (1, 2, 3, 0)],
    ]


def _join_matches(block, suffix, place, text, begin_of, longest) -> None:
    """Windows that follow one another in both texts are one match; each text's longest is kept,
    at equal length the one of the lowest item, then the first in the text."""
    item, at = block.item[suffix], block.place[suffix]
    order = np.lexsort((place, place - at, item, text))
    item, at, place, text = item[order], at[order], place[order], text[order]
    length = block.length[suffix][order]
    joined = np.zeros(len(order), dtype=bool)
    joined[1:] = (
        (text[1:] == text[:-1]) & (item[1:] == item[:-1])
        & (place[1:] == place[:-1] + 1) & (at[1:] == at[:-1] + 1)
    )
    begins = np.flatnonzero(~joined)
    steps = np.diff(np.append(begins, len(order))) - 1
    for i, size in zip(begins.tolist(), (length[begins] + steps).tolist()):
        row = int(text[i])
        found = (size, block.names[int(item[i])], int(at[i]), int(place[i] - begin_of[row]))
        if (-found[0], found[1], found[3], found[2]) < (
            -longest[row][0], longest[row][1], longest[row][3], longest[row][2]
        ):
            longest[row] = found


def decontaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    into: str = "contamination",
    keep: list[str] | None = None,
) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the struct ``into``: words hit, items that occur,
    the verdict, and the longest verbatim match with its places."""
    items, n = blocks(benchmark, item_id, item_text)
    if n == 1:
        sent = _sent(items)

        def compute(texts: pa.Array) -> list:
            return searched(texts, sent.value)

        return with_result(docs, into, FOUND, compute, text=text, keep=keep, limit=SHARD_BYTES)
    keep = [c for c in (docs.columns if keep is None else keep) if c != into]
    said = named(text).cast("string")
    rows = docs.select(F.struct(*[named(c) for c in keep]).alias("row"), said.alias("said"), _text_key(said).alias("key"))
    parts = None
    for number in range(n):
        part = _hits_of_block(rows.select("key", "said"), items.where(F.col("block") == number))
        parts = part if parts is None else parts.unionByName(part)

    def count(texts: pa.Array) -> list:
        return [np.diff(word_hashes(texts)[1])]

    n_words = T.StructType([T.StructField("n", T.LongType())])
    counted = with_result(rows, "words", n_words, count, text="said", keep=["row", "key"])
    found = stored(_joined_hits(parts), "hits")
    hits = F.coalesce(F.col("n_hit"), F.lit(0).cast("long"))
    total = F.col("words.n")
    result = F.struct(
        total.alias("n_words"),
        hits.alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.concat_ws(",", "items"), F.lit("")).cast("binary"), 256).alias("items_sha256"),
        ((hits > 0) & (ONE_IN * hits >= total)).alias("contaminated"),
        F.col("longest.item").alias("longest_item"),
        F.col("longest.item_word").alias("longest_item_word"),
        F.col("longest.doc_word").alias("longest_doc_word"),
        F.coalesce(F.col("longest.words"), F.lit(0).cast("long")).alias("longest_words"),
    )
    made = counted.join(found, "key", "left").select("row", result.alias("result"))
    return made.select(*[F.col("row").getField(c).alias(c) for c in keep], F.col("result").alias(into))


def _text_key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def _sent(items: DataFrame):
    """The items of one block, broadcast."""
    rows = items.select("item_id", "text").collect()
    block = block_of([r.item_id for r in rows], [r.text for r in rows])
    return items.sparkSession.sparkContext.broadcast(block)


def _hits_of_block(texts: DataFrame, items: DataFrame) -> DataFrame:
    """(key, part) of the texts in which a block hits something, stored."""
    sent = _sent(items)

    def compute(some: pa.Array) -> list:
        return part_of(some, sent.value)

    found = with_result(texts, "part", PART, compute, text="said", keep=["key"], limit=SHARD_BYTES)
    found = found.where(F.size("part.items") > 0).groupBy("key").agg(F.first("part").alias("part"))
    out = stored(found, "hits-of-block")
    # It has been searched, and the next one takes its place.
    sent.destroy()
    return out


def _joined_hits(parts: DataFrame) -> DataFrame:
    """(key, n_hit, items, longest): the hits of all blocks in each text."""
    lists = parts.groupBy("key").agg(F.collect_list("part").alias("parts"))
    words = F.col("parts")
    runs = F.transform(
        words,
        lambda p: F.transform(
            F.sequence(F.lit(0), F.size(p["spans"]) - 1, F.lit(2)),
            lambda i: F.struct(F.get(p["spans"], i).alias("start"), F.get(p["spans"], i + 1).alias("end")),
        ),
    )
    none = F.struct(F.lit(0).cast("long").alias("reach"), F.lit(0).cast("long").alias("n"))

    def longer(acc: Column, run: Column) -> Column:
        fresh = F.greatest(run["end"] - F.greatest(run["start"], acc["reach"]), F.lit(0).cast("long"))
        return F.struct(F.greatest(acc["reach"], run["end"]).alias("reach"), (acc["n"] + fresh).alias("n"))

    best = F.array_sort(
        F.transform(
            words,
            lambda p: F.struct((-p["words"]).alias("less"), p["item"].alias("item"), p["doc_word"].alias("doc_word"),
                               p["item_word"].alias("item_word"), p["words"].alias("words")),
        )
    )
    return lists.select(
        "key",
        F.aggregate(F.array_sort(F.flatten(runs)), none, longer)["n"].alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.transform(words, lambda p: p["items"])))).alias("items"),
        F.get(best, F.lit(0)).alias("longest"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their own columns."""
    mark = "__contamination"
    return decontaminated(docs, benchmark, into=mark, **options).where(
        ~F.col(f"{mark}.contaminated")
    ).select(*[named(c) for c in docs.columns])
