"""Near-duplicates by order MinHash, verified by banded alignment.

Words are lower-cased runs of letters and digits. A text's k-mers are its shingles of five words
(all its words, if fewer), each labelled with its occurrence in the text. For each of TABLES hash
functions the few k-mers of least hash are taken and put back into the order in which they stand
in the text; the hash of that sequence is a band. Texts that share a band are candidates: each is
compared with the band's least text first, so a band of n texts gives n - 1 pairs. Where that
leaves a band of up to CROWD texts in several classes, every two of its texts from different
classes are compared too: in blocks, by their words as bags, which bound the alignment from
below, and those that the bound lets pass by the alignment. Texts of an open band larger than that
first get finer bands of more k-mers by other hash functions (FINER), which part texts that share a
passage and keep together those alike, and the same is done with these. Those of the first bands
that are open even then are compared exactly, by rare runs of words: so few edits leave a number
of common runs that is known, so two texts alike have one of their rarest runs in common. Every
two texts of crowds and of different classes that have one are compared: no link of a band is lost.

A pair is a link if its banded alignment on words needs at most (1 - SIMILARITY) * (words of the
longer) edits. Links are followed to classes.

Copies are not compared at all: texts are keyed by their md5, each distinct text is handled once,
and its copies join its class by key. Pairs that earlier links have already put into one class
are not aligned again.

Defined results: a null text is the empty text; texts without words are alike only if equal.
Rows of one id are documents of their own, and null ids are allowed: the class id is the lowest
id of the class, null if it has none. An empty table gives no rows. Other columns pass through.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wellspark.llm import words as W
from wellspark.llm.components import components
from wellspark.llm.decontamination import word_hashes
from wellspark.llm.rows import bitmap, in_bitmap, in_tasks, named, pieces, stored, with_result

SHINGLE = 5
SIMILARITY = 0.8
TABLES = 16
#: K-mers kept for each hash function: a pair of Jaccard similarity 0.8 shares a band of two
#: with a chance of about 0.64, so all of 16 miss it once in ten million pairs.
KEPT = (2, 4)
#: Bits that tell texts with candidates from others before their words are read again.
FILTER_BITS = 1 << 23
#: Hash functions and k-mers of the finer bands, level by level: pairs of similarity 0.8 share
#: none of a level 1 to 14 times in 100,000.
FINER = ((16, 3), (24, 5), (48, 8))
#: Texts of a band that are compared with each other, or with as many others, in one task.
BLOCK = 1024
#: Texts of a band of which all are compared in blocks that are not in one class yet.
CROWD = 2048
#: Words in the runs that texts of larger bands are compared by: each text takes the kind that
#: promises fewer others. Two words are rarer than one, unless a passage fills most of a text.
RUNS = (1, 2)
#: Slots that occurrences of runs are counted by, to tell which are rare.
RUN_SLOTS = 1 << 18
#: Counts of words by hash that a text is first compared by; they stop at 255.
BINS = 128
#: Rows of keys, texts, and pairs to be aligned that a task works on.
ROWS_PER_TASK = 50_000
TEXTS_PER_TASK = 5_000
PAIRS_PER_TASK = 1_000
#: Words of a text of which all are compared before the alignment; longer texts have counts only.
BAG_WORDS = 4096

SIGNATURE = T.StructType([T.StructField("bands", T.ArrayType(T.LongType()))])


def node_of(text: Column) -> Column:
    """What equal texts have in common."""
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary")))


def kmers(hashed: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingle hashes, labelled hashes, and the first shingle of each text."""
    n_words = np.diff(first)
    counts = np.where(n_words >= SHINGLE, n_words - SHINGLE + 1, np.minimum(n_words, 1))
    begin = np.concatenate([[0], np.cumsum(counts)])
    rows = np.repeat(np.arange(len(counts)), counts)
    at = first[rows] + np.arange(begin[-1]) - begin[rows]
    padded = np.concatenate([hashed, np.zeros(SHINGLE, dtype=np.uint64)])
    shingles = np.zeros(len(at), dtype=np.uint64)
    for j in range(SHINGLE):
        within = j < n_words[rows]
        shingles = shingles * W.STEP + np.where(within, padded[at + j], np.uint64(0))
    shingles = W.mixed(shingles)
    occurrence = occurrences(shingles ^ W.mixed(rows.astype(np.uint64)))
    return shingles, W.mixed(shingles + occurrence * W.STEP), begin


def occurrences(keys: np.ndarray) -> np.ndarray:
    """How many equal keys stand before each one."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    fresh = np.ones(len(ranked), dtype=bool)
    fresh[1:] = ranked[1:] != ranked[:-1]
    since = np.arange(len(ranked))
    out = np.zeros(len(ranked), dtype=np.uint64)
    out[order] = since - np.maximum.accumulate(np.where(fresh, since, 0))
    return out


def bands(
    texts: pa.Array, tables: int = TABLES, keeps: tuple[int, ...] = KEPT, level: int = 0
) -> list[pa.Array]:
    """For each text one band for each hash function and number of k-mers; none without words.

    Every level has hash functions of its own.
    """
    hashed, first = word_hashes(texts)
    shingles, labelled, begin = kmers(hashed, first)
    filled = np.flatnonzero(np.diff(begin))
    starts, sizes = begin[:-1][filled], np.diff(begin)[filled]
    found = np.zeros((len(filled), tables * len(keeps)), dtype=np.uint64)
    none = np.iinfo(np.uint64).max
    for table in range(tables if len(filled) else 0):
        name = 1000 * level + table + 1
        rank = W.mixed(labelled ^ W.mixed(np.full(1, name, dtype=np.uint64)))
        picked = np.full((len(filled), max(keeps)), len(rank), dtype=np.int64)
        for i in range(max(keeps)):
            least = np.minimum.reduceat(rank, starts)
            hit = np.flatnonzero(rank == np.repeat(least, sizes))
            text = np.searchsorted(starts, hit, "right") - 1
            # In a text with fewer k-mers all are used up by now and hit again: nothing is added.
            fresh = rank[hit] != none
            hit, text = hit[fresh], text[fresh]
            picked[text, i] = hit
            rank[hit] = none
        said = np.append(shingles, np.uint64(0))
        for k, kept in enumerate(keeps):
            inorder = np.sort(picked[:, :kept], axis=1)
            band = np.full(len(filled), name * len(keeps) + k - len(keeps) + 1, dtype=np.uint64)
            for i in range(kept):
                band = W.mixed(band * W.STEP + said[inorder[:, i]])
            found[:, table * len(keeps) + k] = band
    width = tables * len(keeps)
    borders = np.zeros(len(texts) + 1, dtype=np.int32)
    borders[filled + 1] = width
    values = pa.array(found.ravel().view(np.int64))
    return [pa.ListArray.from_arrays(pa.array(np.cumsum(borders, dtype=np.int32)), values)]


def packed_words(texts: pa.Array) -> list[bytes]:
    """Each text's words as 32-bit numbers."""
    hashed, first = word_hashes(texts)
    data = (hashed >> np.uint64(32)).astype(np.uint32).tobytes()
    return [data[4 * a : 4 * b] for a, b in zip(first[:-1], first[1:])]


def edits(a: np.ndarray, b: np.ndarray, limit: int) -> int:
    """The edit distance of two word sequences, or ``limit`` + 1 if it is larger.

    A band of ``limit`` diagonals to either side moves along; a column of the band is one
    integer, and its cells are computed together by bit operations.
    """
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > limit:
        return limit + 1
    same = a[: len(b)] == b
    head = len(b) if same.all() else int(np.argmin(same))
    a, b = a[head:], b[head:]
    same = a[len(a) - len(b) :][::-1] == b[::-1]
    tail = len(b) if same.all() else int(np.argmin(same))
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    if not len(b):
        return len(a)
    limit = min(limit, len(a))
    places: dict[int, int] = {}
    for i, word in enumerate(a.tolist()):
        places[word] = places.get(word, 0) | 1 << i
    width = 2 * limit + 2
    mask = (1 << width) - 1
    up = mask & (mask << (width - limit - 1))
    down = 0
    distance = limit
    corner = 1 << (width - 1)
    side = 1 << (width - 2)
    diagonal = len(a) - limit
    worst = limit + len(b) - diagonal
    shift = limit + 1 - width
    for i, word in enumerate(b.tolist()):
        equal = places.get(word, 0)
        equal = (equal >> shift if shift >= 0 else equal << -shift) & mask
        zero = ((((equal & up) + up) ^ up) | equal | down) & mask
        right = down | (mask & ~(zero | up))
        left = zero & up
        if i < diagonal:
            distance += not zero & corner
        else:
            distance += bool(right & side) - bool(left & side)
            side >>= 1
        if distance > worst:
            return limit + 1
        half = zero >> 1
        up = left | (mask & ~(half | right))
        down = half & right
        shift += 1
    return distance if distance <= limit else limit + 1


def alike(a: bytes, b: bytes, similarity: float) -> bool:
    """Whether the alignment of two packed word sequences is similar enough."""
    x, y = np.frombuffer(a, dtype=np.uint32), np.frombuffer(b, dtype=np.uint32)
    longer = max(len(x), len(y))
    if not min(len(x), len(y)):
        return False
    limit = int((1 - similarity) * longer + 1e-9)
    return edits(x, y, limit) <= limit


def shared_bands(texts: DataFrame) -> DataFrame:
    """(band, node, b): the texts of each band that several have, and the least of them."""
    each = with_result(texts, "s", SIGNATURE, bands, keep=["node"])
    return _shared(each.groupBy("node").agg(F.first("s.bands").alias("bands")))


def finer_bands(texts: DataFrame, nodes: DataFrame, tables: int, kept: int, level: int) -> DataFrame:
    """As ``shared_bands``, for the texts in ``nodes`` and the bands of a level of FINER."""

    def signed(some: pa.Array) -> pa.Array:
        return bands(some, tables, (kept,), level)[0]

    each = made_of(texts, nodes, signed, "array<bigint>", "bands")
    return _shared(each.join(nodes, "node", "left_semi"))


def _shared(signed: DataFrame) -> DataFrame:
    rows = stored(signed.select("node", F.explode("bands").alias("band")), "bands")
    n = rows.count()
    hubs = (
        rows.groupBy("band")
        .agg(F.min("node").alias("b"), F.count("*").alias("n"))
        .where("n > 1")
        # Another form of the key: both sides are dealt out for the join, and hot bands split.
        .select(F.bitwise_not("band").alias("key"), "b")
    )
    both = rows.withColumn("key", F.bitwise_not("band")).join(in_tasks(hubs, n, ROWS_PER_TASK), "key")
    return in_tasks(both, n, ROWS_PER_TASK).select("band", "node", "b")


def candidates(shared: DataFrame) -> DataFrame:
    """(a, b, n): a text, the least text of bands that both have, and how many those are."""
    found = shared.where("node <> b").groupBy(F.col("node").alias("a"), "b").agg(F.count("*").alias("n"))
    return in_tasks(found, shared.count(), ROWS_PER_TASK)


def made_of(
    texts: DataFrame, nodes: DataFrame, make: Callable[[pa.Array], pa.Array], kind: str, column: str
) -> DataFrame:
    """(node, column): what ``make`` gives for the texts in ``nodes``, each text once.

    A bitmap of fixed size keeps most other texts from being read; it may let some pass.
    """
    bit = F.pmod(F.xxhash64("node"), F.lit(FILTER_BITS)).alias("bit")
    sent = texts.sparkSession.sparkContext.broadcast(bitmap(nodes.select(bit), "bit", FILTER_BITS))

    def some(batches):
        for batch in batches:
            batch = batch.filter(pa.array(in_bitmap(sent.value, batch.column(2).to_numpy())))
            said = pa.compute.fill_null(batch.column(1), "")
            for first, last in pieces(said):
                made = make(said.slice(first, last - first))
                node = batch.column(0).slice(first, last - first)
                yield pa.RecordBatch.from_arrays([node, made], ["node", column])

    made = texts.select("node", "text", bit).mapInArrow(some, f"node binary, {column} {kind}")
    made = made.groupBy("node").agg(F.first(column).alias(column))
    return in_tasks(made, nodes.count(), TEXTS_PER_TASK)


def words_of(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """(node, words) of the texts in ``pairs``, each once."""
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node")))
    return made_of(texts, ends, lambda said: pa.array(packed_words(said), pa.binary()), "binary", "words")


def links(pairs: DataFrame, words: DataFrame, similarity: float, bags: bool = False) -> DataFrame:
    """The pairs (a, b) whose alignment is similar enough; with ``bags`` for pairs of which most
    are not, compared as bags of words first."""
    pairs = stored(pairs.select("a", "b"), "meeting")
    n = pairs.count()
    if not n:
        return pairs
    # Few pairs may still meet many words.
    n = max(n, words.count() * PAIRS_PER_TASK // TEXTS_PER_TASK)
    left = words.select(F.col("node").alias("a"), F.col("words").alias("x"))
    right = words.select(F.col("node").alias("b"), F.col("words").alias("y"))
    half = in_tasks(pairs.join(left, "a"), n, PAIRS_PER_TASK)
    both = in_tasks(half.join(right, "b"), n, PAIRS_PER_TASK).select("a", "b", "x", "y")

    def verified(batches):
        for batch in batches:
            x, y = batch.column(2), batch.column(3)
            each = ((x[i].as_py(), y[i].as_py()) for i in range(batch.num_rows))
            good = [
                not (bags and unlike_bags(one, two, similarity)) and alike(one, two, similarity)
                for one, two in each
            ]
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    return both.mapInArrow(verified, "a binary, b binary")


def unlike_bags(a: bytes, b: bytes, similarity: float) -> bool:
    """Whether the packed words of two texts, in any order, prove that they are unlike."""
    x, y = np.frombuffer(a, dtype=np.uint32), np.frombuffer(b, dtype=np.uint32)
    longer = max(len(x), len(y))
    both = np.sort(np.concatenate([runs_of(x, 1)[1], runs_of(y, 1)[1]]))
    return longer - np.count_nonzero(both[1:] == both[:-1]) > int((1 - similarity) * longer + 1e-9)


def runs_of(hashed: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a text's runs of ``size`` words, and the same with their occurrence mixed in."""
    n = max(0, len(hashed) - size + 1)
    made = np.full(n, size, dtype=np.uint64)
    for j in range(size):
        made = W.mixed(made * W.STEP + hashed[j : j + n].astype(np.uint64))
    return made, W.mixed(made + occurrences(made) * W.STEP)


def shared_runs(n: int, size: int, similarity: float) -> int:
    """How many runs of ``size`` words a text of ``n`` words shares with any text it is linked to,
    at least: an edit changes ``size`` runs of the longer text at most."""
    longer = np.arange(n, int(n / similarity) + 2)
    limit = ((1 - similarity) * longer + 1e-9).astype(np.int64)
    return int((longer - size + 1 - size * limit).min())


def rare_runs(
    words: np.ndarray, counts: np.ndarray, similarity: float
) -> tuple[np.ndarray, np.ndarray]:
    """Runs one of which a text has in common with each text it is linked to, and which of them
    it looks for: those of one size, as the other texts have those of every size.

    Texts that share t of their g runs share one of the g - t + 1 that come first in any order;
    here by ``counts``.
    """
    keys, costs, sizes = [], [], []
    for place, size in enumerate(RUNS):
        made, labelled = runs_of(words, size)
        least = shared_runs(len(words), size, similarity)
        often = counts[place * RUN_SLOTS + (made % np.uint64(RUN_SLOTS)).astype(np.int64)]
        first = np.lexsort((labelled, often))[: max(0, len(made) - max(1, least) + 1)]
        keys.append(labelled[first])
        costs.append(often[first].sum() if least > 0 else np.inf)
        sizes.append(np.full(len(first), size))
    return np.concatenate(keys), np.concatenate(sizes) == RUNS[int(np.argmin(costs))]


def run_counts(words: DataFrame) -> np.ndarray:
    """How often runs occur, by size and slot; of fixed size, whatever the number of texts."""

    def run(batches):
        seen = np.zeros(len(RUNS) * RUN_SLOTS, dtype=np.int64)
        for batch in batches:
            for value in batch.column(0):
                hashed = np.frombuffer(value.as_buffer(), dtype=np.uint32)
                for place, size in enumerate(RUNS):
                    slot = runs_of(hashed, size)[0] % np.uint64(RUN_SLOTS)
                    np.add.at(seen, place * RUN_SLOTS + slot.astype(np.int64), 1)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(seen[at])], ["slot", "n"])

    parts = words.select("words").mapInArrow(run, "slot int, n long")
    found = parts.groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(len(RUNS) * RUN_SLOTS, dtype=np.int64)
    counts[found["slot"].to_numpy()] = found["n"].to_numpy()
    return counts


def by_runs(nodes: DataFrame, roots: DataFrame, words: DataFrame, similarity: float) -> DataFrame:
    """(a, b): every two of ``nodes`` from different classes that may be alike, by their rare runs."""
    root = F.coalesce("root", "node").alias("root")
    nodes = stored(nodes, "crowd")
    said = in_tasks(nodes.join(roots, "node", "left"), max(nodes.count(), roots.count()), ROWS_PER_TASK)
    said = in_tasks(said.select("node", root).join(words, "node"), words.count(), TEXTS_PER_TASK)
    said = stored(said.select("node", "root", "words"), "said")
    context = said.sparkSession.sparkContext
    sent = context.broadcast(run_counts(said))

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                hashed = np.frombuffer(batch.column(2)[row].as_buffer(), dtype=np.uint32)
                keys, sought = rare_runs(hashed, sent.value, similarity)
                which = pa.array(np.full(len(keys), row))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys.view(np.int64)),
                        pa.array(sought),
                        pa.array(np.full(len(keys), len(hashed), dtype=np.int32)),
                        batch.column(0).take(which),
                        batch.column(1).take(which),
                    ],
                    ["key", "sought", "n", "node", "root"],
                )

    runs = stored(said.mapInArrow(run, "key long, sought boolean, n int, node binary, root binary"), "runs")
    rows = runs.count()
    # Runs of one class alone, and those that nobody looks for, link nothing.
    several = (
        runs.groupBy("key")
        .agg(F.min("root").alias("low"), F.max("root").alias("high"), F.max("sought").alias("any"))
        .where("low <> high and any")
        .select(F.bitwise_not("key").alias("other"))
    )
    several = in_tasks(several, rows, ROWS_PER_TASK)
    runs = runs.withColumn("other", F.bitwise_not("key")).join(several, "other").drop("other")
    runs = stored(in_tasks(runs, rows, ROWS_PER_TASK), "several")
    one = runs.where("sought").select("key", *[F.col(c).alias(f"{c}_a") for c in ("n", "node", "root")])
    two = runs.select("key", *[F.col(c).alias(f"{c}_b") for c in ("n", "node", "root")])
    longer = F.greatest("n_a", "n_b")
    limit = F.floor(F.lit(1 - similarity) * longer + F.lit(1e-9))
    pairs = one.join(two, "key").where(
        (F.col("root_a") != F.col("root_b")) & (longer - F.least("n_a", "n_b") <= limit)
    )
    pairs = pairs.select(F.greatest("node_a", "node_b").alias("a"), F.least("node_a", "node_b").alias("b"))
    return pairs.distinct()


def word_bins(words: bytes) -> bytes:
    """How many of the packed words fall into each of BINS, up to 255."""
    hashed = np.frombuffer(words, dtype=np.uint32)
    return np.minimum(np.bincount(hashed % BINS, minlength=BINS), 255).astype(np.uint8).tobytes()


def word_bag(words: bytes) -> bytes:
    """The packed words as 16-bit numbers, each with its occurrence in the text mixed in, so that
    equal words are told apart; empty for more than BAG_WORDS."""
    hashed = np.frombuffer(words, dtype=np.uint32)
    if len(hashed) > BAG_WORDS:
        return b""
    labelled = W.mixed(hashed.astype(np.uint64) + occurrences(hashed) * W.STEP)
    return (labelled >> np.uint64(48)).astype(np.uint16).tobytes()


class Texts:
    """What a block of texts is compared by before any alignment."""

    def __init__(self, n: np.ndarray, bins: list[bytes], bags: list[bytes]):
        self.n = n
        self.bins = np.frombuffer(b"".join(bins), dtype=np.uint8).reshape(-1, BINS)
        self.bags = [np.frombuffer(b, dtype=np.uint16) for b in bags]
        self.held = np.zeros(1 << 16, dtype=bool)

    def may_be_alike(self, i: int, js: np.ndarray, similarity: float) -> np.ndarray:
        """Those of ``js`` that their words do not prove to be unlike text ``i``.

        There are at least as many edits as there are words too many, or words too few.
        """
        n, bins = self.n, self.bins
        limit = ((1 - similarity) * np.maximum(n[js], n[i]) + 1e-9).astype(np.int64)
        close = np.abs(n[js] - n[i]) <= limit
        js, limit = js[close], limit[close]
        # Counts by bins call for fewer edits than the bags do, and are looked at first.
        most = np.maximum(bins[js], bins[i])
        more = (most - bins[i]).sum(axis=1, dtype=np.int64)
        less = (most - bins[js]).sum(axis=1, dtype=np.int64)
        close = np.maximum(more, less) <= limit
        js, limit = js[close], limit[close]
        if not len(js) or not len(self.bags[i]):
            return js
        self.held[self.bags[i]] = True
        common = np.array([np.count_nonzero(self.held[self.bags[j]]) for j in js.tolist()])
        self.held[self.bags[i]] = False
        # Words of j that i has; more of them by chance, as numbers have 16 bits, only let pass.
        full = np.array([len(self.bags[j]) > 0 for j in js.tolist()])
        return js[~full | (np.maximum(self.n[js], self.n[i]) - common <= limit)]


def across(shared: DataFrame, roots: DataFrame, words: DataFrame, similarity: float) -> DataFrame:
    """(a, b): texts of one band and of different classes that may be alike, every such pair.

    A band's classes are dealt out to blocks, a large class to blocks of its own, and each two
    blocks meet in a row of their own, but for those of one large class. A pair is made in the
    least of the bands that both texts are in.
    """
    members = with_roots(shared, roots)
    rows = members.count()
    sizes = members.groupBy("band", "root").agg(F.count("*").alias("m"))
    sizes = in_tasks(sizes, rows, ROWS_PER_TASK)
    small = F.sum(F.when(F.col("m") <= BLOCK, F.col("m")).otherwise(0))
    open_bands = sizes.groupBy("band").agg(F.count("*").alias("c"), small.alias("small")).where("c > 1")
    open_bands = in_tasks(open_bands, rows, ROWS_PER_TASK)
    large = F.col("m") > BLOCK
    parts = in_tasks(sizes.join(open_bands, "band"), rows, ROWS_PER_TASK).select(
        F.bitwise_not("band").alias("key"),
        F.hex("root").alias("root_key"),
        F.ceil(F.when(large, F.col("m")).otherwise(F.col("small")) / BLOCK).alias("parts"),
        F.when(large, F.col("root")).alias("alone"),
    )
    within = F.pmod(F.xxhash64("node"), F.col("parts"))
    block = F.when(F.col("alone").isNull(), F.pmod(F.xxhash64("root"), F.col("parts")))
    placed = (
        members.withColumn("key", F.bitwise_not("band"))
        .withColumn("root_key", F.hex("root"))
        .join(parts, ["key", "root_key"])
        .select("band", "node", "root", "alone", F.coalesce(block, F.xxhash64("root", within)).alias("block"))
    )
    placed = stored(in_tasks(placed, rows, ROWS_PER_TASK), "placed")
    left = placed.count()
    if not left:
        return placed.select(F.col("node").alias("a"), F.col("node").alias("b"))
    # A text has as many bands as there are hash functions and numbers of k-mers, at most.
    own = placed.groupBy("node").agg(F.sort_array(F.collect_set("band")).alias("bands"))
    own = in_tasks(own, left, TEXTS_PER_TASK)
    said = in_tasks(own.join(words, "node"), max(left, words.count()), TEXTS_PER_TASK)
    said = said.select("node", "words", "bands")

    def bagged(batches):
        for batch in batches:
            packed = batch.column(1).to_pylist()
            n = pa.array([len(w) // 4 for w in packed], pa.int64())
            bins = pa.array([word_bins(w) for w in packed], pa.binary())
            bags = pa.array([word_bag(w) for w in packed], pa.binary())
            columns = [batch.column(0), batch.column(2), n, bins, bags]
            yield pa.RecordBatch.from_arrays(columns, ["node", "bands", "n", "bins", "bag"])

    bags = said.mapInArrow(bagged, "node binary, bands array<bigint>, n long, bins binary, bag binary")
    each = placed.groupBy("band", "block").agg(F.first("alone").alias("alone"))
    each = in_tasks(each, left, ROWS_PER_TASK)
    one = each.select("band", F.col("block").alias("i"), F.col("alone").alias("alone_i"))
    two = each.select("band", F.col("block").alias("j"), F.col("alone").alias("alone_j"))
    meet = one.join(two, "band").where("i <= j and (alone_i = alone_j) is not true").select("band", "i", "j")
    ends = F.array_distinct(F.array("i", "j"))
    meet = in_tasks(meet.select("band", "i", "j", F.explode(ends).alias("block")), left, ROWS_PER_TASK)
    # First who meets where, then once the words.
    met = placed.join(meet, ["band", "block"]).select("band", "i", "j", "block", "node", "root")
    met = stored(in_tasks(met, left, ROWS_PER_TASK), "met")
    n = met.count()
    both = in_tasks(met.join(bags, "node"), n, TEXTS_PER_TASK).groupBy("band", "i", "j")
    both = both.agg(F.collect_list(F.struct("block", "node", "root", "bands", "n", "bins", "bag")).alias("texts"))
    both = in_tasks(both, n, TEXTS_PER_TASK).select("i", "j", "texts", "band")

    def passing(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                given = batch.column(2)[row].values
                block = given.field("block").to_numpy()
                node, root = given.field("node"), given.field("root").to_pylist()
                texts = Texts(
                    given.field("n").to_numpy(), given.field("bins").to_pylist(), given.field("bag").to_pylist()
                )
                known: dict[bytes, int] = {}
                root = np.array([known.setdefault(r, len(known)) for r in root])
                bands = given.field("bands").to_pylist()
                band = batch.column(3)[row].as_py()
                i, j = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
                left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
                a, b = [], []
                for x in left.tolist():
                    js = right[right > x] if i == j else right
                    js = texts.may_be_alike(x, js[root[js] != root[x]], similarity)
                    # In the bands before this one, either text is without the other.
                    before = {other for other in bands[x] if other < band}
                    js = np.array([y for y in js.tolist() if before.isdisjoint(bands[y])], dtype=np.int64)
                    a.append(np.full(len(js), x))
                    b.append(js)
                a, b = np.concatenate(a or [left]), np.concatenate(b or [left])
                for k in range(0, len(a), BLOCK * 16):
                    some = slice(k, k + BLOCK * 16)
                    yield pa.RecordBatch.from_arrays([node.take(pa.array(a[some])), node.take(pa.array(b[some]))], ["a", "b"])

    found = both.mapInArrow(passing, "a binary, b binary")
    return found.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def with_roots(shared: DataFrame, roots: DataFrame) -> DataFrame:
    """(band, node, root): the texts of the bands and the classes that they are in so far."""
    root = F.coalesce("root", "node")
    rows = max(shared.count(), roots.count())
    members = in_tasks(shared.join(roots, "node", "left"), rows, ROWS_PER_TASK)
    return stored(members.select("band", "node", root.alias("root")), "members")


def by_size(shared: DataFrame, roots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The open bands of up to CROWD texts, and the larger ones (both as ``shared``)."""
    members = with_roots(shared, roots)
    rows = members.count()
    # The number of texts, and whether they are of one class: no list of either.
    size = (
        members.groupBy("band")
        .agg(F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high"))
        .where("low <> high")
        .select(F.bitwise_not("band").alias("key"), "n")
    )
    size = in_tasks(size, rows, ROWS_PER_TASK)
    sized = shared.withColumn("key", F.bitwise_not("band")).join(size, "key")
    sized = stored(in_tasks(sized, rows, ROWS_PER_TASK).select("band", "node", "b", "n"), "open")
    few = F.col("n") <= CROWD
    return sized.where(few).drop("n"), sized.where(~few).drop("n")


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs, a stored table, whose ends are in different classes so far."""
    n = max(pairs.count(), roots.count())
    of_a = roots.select(F.col("node").alias("a"), F.col("root").alias("root_a"))
    of_b = roots.select(F.col("node").alias("b"), F.col("root").alias("root_b"))
    known = in_tasks(pairs.join(of_a, "a", "left"), n, ROWS_PER_TASK)
    known = in_tasks(known.join(of_b, "b", "left"), n, ROWS_PER_TASK)
    return known.where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b", "n")


def rooted(texts: DataFrame, similarity: float) -> DataFrame:
    """(node, root) of the texts that are like another text, but for the roots themselves."""
    shared = stored(shared_bands(texts), "shared")
    pairs = stored(candidates(shared), "pairs")
    words = stored(words_of(texts, pairs), "words")
    # First the pairs that share most bands, one for each text; then those still apart.
    best = pairs.groupBy("a").agg(F.max_by("b", F.struct("n", "b")).alias("b"))
    best = stored(in_tasks(best, pairs.count(), ROWS_PER_TASK), "best")
    roots = stored(components(stored(links(best, words, similarity), "links")), "roots")
    apart = _apart(pairs, roots).join(best, ["a", "b"], "left_anti")
    roots = joined(roots, stored(links(apart, words, similarity), "links"))
    first = None
    for level in range(len(FINER) + 1):
        few, crowds = by_size(shared, roots)
        rest = links(across(few, roots, words, similarity), words, similarity)
        roots = joined(roots, stored(rest, "links"))
        if level == 0:
            first = crowds
        if level == len(FINER) or crowds.isEmpty():
            break
        # Only texts of crowds go on, in finer bands, where each meets the least text again.
        crowded = stored(crowds.select("node").distinct(), "crowded")
        shared = stored(finer_bands(texts, crowded, *FINER[level], level + 1), "shared")
        apart = _apart(stored(candidates(shared), "pairs"), roots)
        roots = joined(roots, stored(links(apart, words, similarity), "links"))
    if first.isEmpty():
        return roots
    # What finer bands have parted may be alike all the same.
    _, still = by_size(first, roots)
    rest = by_runs(still.select("node").distinct(), roots, words, similarity)
    return joined(roots, stored(links(rest, words, similarity, bags=True), "links"))


def joined(roots: DataFrame, found: DataFrame) -> DataFrame:
    """The classes ``roots`` with further links, which start from what is known of them."""
    if found.isEmpty():
        return roots
    known = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
    # Written, as a plan over a checkpoint keeps what is known of its columns, more each time.
    return stored(components(known.unionByName(found)), "roots")


def _text_classes(docs: DataFrame, doc_id: str, text: str, similarity: float) -> DataFrame:
    """(node, class_id, keeper) of each different text, however many copies it has."""
    texts = docs.select(node_of(named(text)).alias("node"), named(text).cast("string").alias("text"))
    roots = rooted(texts, similarity)
    ids = docs.select(named(doc_id).alias("doc_id"), node_of(named(text)).alias("node"))
    least = ids.groupBy("node").agg(F.min("doc_id").alias("low"))
    of_text = stored(
        least.join(roots, "node", "left").select("node", "low", F.coalesce("root", "node").alias("root")),
        "texts",
    )
    of_class = of_text.groupBy("root").agg(
        F.min("low").alias("class_id"),
        F.min_by("node", F.struct(F.col("low").isNull(), "low", "node")).alias("keeper"),
    )
    of_class = of_class.select(F.hex("root").alias("key"), "class_id", "keeper")
    names = of_text.withColumn("key", F.hex("root")).join(of_class, "key")
    return names.select("node", "class_id", "keeper")


def keepers(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY
) -> DataFrame:
    """(node, keeper) for each different text: its key, and that of the text its class keeps."""
    return stored(_text_classes(docs, doc_id, text, similarity).select("node", "keeper"), "keepers")


def classes(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY
) -> DataFrame:
    """One row for each document: doc_id, node (its text's key), class_id (the lowest doc_id of
    its class) and keeper (the key of that document's text)."""
    names = _text_classes(docs, doc_id, text, similarity)
    ids = docs.select(named(doc_id).alias("doc_id"), node_of(named(text)).alias("node"))
    return ids.join(names, "node").select("doc_id", "node", "class_id", "keeper")


def one_of_each(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY
) -> DataFrame:
    """``docs`` with one document of each class, that of the lowest id, and its own columns."""
    found = classes(docs, doc_id=doc_id, text=text, similarity=similarity)
    kept = (
        found.where(F.col("node") == F.col("keeper"))
        .where(F.col("doc_id").eqNullSafe(F.col("class_id")))
        .groupBy(F.col("doc_id").alias("kept_id"), F.col("node").alias("kept_node"))
        .agg(F.lit(1).alias("one"))
    )
    # The whole row as one column, so that no name of its columns can be taken.
    whole = docs.select(
        F.struct(*[named(c) for c in docs.columns]).alias("row"),
        named(doc_id).alias("row_id"),
        node_of(named(text)).alias("row_node"),
    )
    same = F.col("row_id").eqNullSafe(F.col("kept_id")) & (F.col("row_node") == F.col("kept_node"))
    return (
        whole.join(kept, same)
        .dropDuplicates(["kept_id", "kept_node"])
        .select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
    )
