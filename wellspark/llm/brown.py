"""A class-based bigram model: exchange clustering, class transitions and word emissions.

Words are put into CLASSES classes so that the classes of neighbouring words tell as much of each
other as they can. Each round counts, for every word, the classes before and after it, and moves
half of the words to the class where the likelihood of the class bigrams is highest, the others
being fixed. A text's probability is the product of class transitions, smoothed towards the class
frequencies, and of word emissions, smoothed by adding 0.1 to each count, with 0.1 for unknown
words in the class of rare words.

Every word that occurs LEAST times has a class of its own choice, in a small corpus and in a large
one; rarer words share the class of rare words. The EXCHANGED most frequent ones are moved in each
round, the others are placed by the same rule once these have settled. What tasks share of the
others has a fixed size: a map of which words (by MEMBER_BITS of their hash) occur LEAST times,
and the class of each of SLOTS slots; words of one slot are placed together. In a corpus of a
million such words one in nine shares its slot with another.

Texts are read three times: to count words, to be written as ids of exchanged words and slots of
the others, which the rounds, the placement and the transitions are counted from, and to be
scored. Counts of neighbours travel by blocks of words, in a row for each block and task, and are
summed as arrays.

What is counted covers all training texts. Counts are sent to tasks for words of a share of one in
SENT, of which there are SENT at most; occurrences of the others join the table of counts. That is
a choice of transport, results do not depend on it.

Defined results: a null text is the empty text, one end token. A null id reads as the empty text,
whose remainder is 0, so it is held out. Ids may have any type. Rows are scored one by one,
repeated ones alike; in training each counts. Without training texts, or with an empty table,
there is no model to speak of: every word is unknown, and rows get the probabilities of an empty
training set.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wellspark.llm import words as W
from wellspark.llm.rows import bitmap, in_bitmap, named, pieces, stored

log = logging.getLogger(__name__)

CLASSES = 24
ROUNDS = 8
#: Occurrences from which a word is put into a class.
LEAST = 4
#: Words that are exchanged between classes in each round, the most frequent ones.
EXCHANGED = 65_000
#: Slots that the other words are placed by, and bits of the map of words that are placed.
SLOTS = 1 << 23
MEMBER_BITS = 26
#: Words of at least this share of the tokens (one in ...) have their counts sent to all tasks.
SENT = 1 << 22
HELD_OUT_ONE_IN = 10
ADDED = 0.1

#: Classes beside the learnt ones, and what stands for other words and for the end in sequences.
RARE, END = CLASSES, CLASSES + 1
ALL = CLASSES + 2
OTHER_ID, END_ID = 65_535, 65_534
#: The hash of the end token; no word is hashed to it but by chance.
END_HASH = np.uint64(0x656E64206F662074)
#: Rows in an Arrow batch of counts, and distinct words a task holds before it sends them.
BATCH = 1 << 16
HELD = 1 << 20
#: Tokens that are counted together, blocks that the exchanged words are dealt out to, and slots
#: in a block of slots.
TOGETHER = 1 << 20
BLOCKS = 256
BLOCK_SLOTS = 1 << 14


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words, an end after each text, and the first of each text."""
    data, borders = W.buffers(texts)
    data = W.LOWER[data]
    starts, ends, first = W.runs(W.BETWEEN_SPACES[data], borders)
    out = np.full(len(starts) + len(texts), END_HASH, dtype=np.uint64)
    out[np.arange(len(starts)) + W.row_of(first)] = W.hashes(data, starts, ends)
    return out, first + np.arange(len(first))


def counted(keys: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and how often they occur, or the sums of ``n``."""
    if n is None:
        return np.unique(keys, return_counts=True)
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else order
    return keys[first], np.add.reduceat(n, first) if len(keys) else n


class Counter:
    """Counts of keys in a task, handed on when there are many."""

    def __init__(self) -> None:
        self.keys: list[np.ndarray] = []
        self.n: list[np.ndarray] = []
        self.held = 0

    def add(self, keys: np.ndarray) -> None:
        found, n = counted(keys)
        self.keys.append(found)
        self.n.append(n)
        self.held += len(found)
        if self.held > HELD:
            self.merge()

    def merge(self) -> None:
        if self.keys:
            keys, n = counted(np.concatenate(self.keys), np.concatenate(self.n))
            self.keys, self.n, self.held = [keys], [n], len(keys)

    def full(self) -> bool:
        return self.held > HELD // 2 and len(self.keys) == 1

    def batches(self, make):
        """Record batches that ``make`` builds of sorted keys and counts; nothing is held
        afterwards."""
        self.merge()
        if self.keys:
            keys, n = self.keys[0], self.n[0]
            self.keys, self.n, self.held = [], [], 0
            yield from make(keys, n)


def _texts(batches):
    """Pieces of the first column without nulls, and their rows."""
    for batch in batches:
        said = pa.compute.fill_null(batch.column(0), "")
        for first, last in pieces(said):
            yield batch.slice(first, last - first), said.slice(first, last - first)


def word_counts(training: DataFrame) -> DataFrame:
    """(h, n): the hash of every training token and how often it occurs."""

    def run(batches):
        seen = Counter()

        def made(keys, n):
            for a in range(0, len(keys), BATCH):
                some = keys[a : a + BATCH].view(np.int64), n[a : a + BATCH]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in some], ["h", "n"])

        for _, texts in _texts(batches):
            seen.add(tokens(texts)[0])
            if seen.full():
                yield from seen.batches(made)
        yield from seen.batches(made)

    return training.mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


@dataclass
class Words:
    """The more frequent words, sorted by hash: counts, classes, and places among those
    exchanged (OTHER_ID for others); and the classes of the words that are placed."""

    hashes: np.ndarray
    counts: np.ndarray
    classes: np.ndarray
    ids: np.ndarray
    member: bytes
    slots: np.ndarray

    @cached_property
    def begins(self) -> tuple[np.ndarray, np.ndarray, np.uint64]:
        """The hashes with the largest number behind them, where those of the same first bits
        begin, and by how much a hash is shifted to get these."""
        bits = max(1, len(self.hashes).bit_length())
        shift = np.uint64(64 - bits)
        first = np.searchsorted(self.hashes, np.arange(1 << bits, dtype=np.uint64) << shift)
        return np.append(self.hashes, np.uint64(2**64 - 1)), first, shift

    def __getstate__(self) -> dict:
        # Not sent along: built where it is needed.
        return {k: v for k, v in self.__dict__.items() if k != "begins"}

    def find(self, hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of each hash, and whether it is there."""
        if not len(self.hashes):
            return np.zeros(len(hashed), dtype=np.int64), np.zeros(len(hashed), dtype=bool)
        # Few have the same first bits, so the next ones are looked at in turn.
        there, first, shift = self.begins
        at = first[hashed >> shift]
        later = np.flatnonzero(there[at] < hashed)
        while len(later):
            at[later] += 1
            later = later[there[at[later]] < hashed[later]]
        at = np.minimum(at, len(self.hashes) - 1)
        return at, self.hashes[at] == hashed

    @property
    def of_ids(self) -> np.ndarray:
        """The class of each id; words that are not exchanged are rare until they are placed."""
        classes = np.full(1 << 16, RARE, dtype=np.int8)
        classes[END_ID] = END
        classes[self.ids[self.ids < END_ID]] = self.classes[self.ids < END_ID]
        return classes

    def placed(self, hashed: np.ndarray) -> np.ndarray:
        """The class of each word that is not exchanged."""
        if not len(self.slots):
            return np.full(len(hashed), RARE)
        there = in_bitmap(self.member, (hashed >> np.uint64(64 - MEMBER_BITS)).astype(np.int64))
        return np.where(there, self.slots[slot_of(hashed)], RARE)

    def classes_of(self, hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The place of each token, whether it is there, and its class."""
        at, known = self.find(hashed)
        classes = self.placed(hashed)
        if len(self.hashes):
            exchanged = known & (self.ids[at] < END_ID)
            classes = np.where(exchanged, self.classes[at], classes)
        return at, known, np.where(hashed == END_HASH, END, classes).astype(np.int64)


def slot_of(hashed: np.ndarray) -> np.ndarray:
    return (hashed % np.uint64(SLOTS)).astype(np.int64)


def size_class(n: Column) -> Column:
    """Numbers of occurrences in steps of an eighth of a doubling."""
    return F.floor(F.log2(n) * 8).cast("int")


def least_exchanged(counts: DataFrame) -> int:
    """The size class from which on there are at most EXCHANGED words."""
    often = counts.where(F.col("n") >= LEAST).groupBy(size_class(F.col("n")).alias("size")).agg(F.count("*").alias("v"))
    left, least = EXCHANGED, 1 << 20
    # A few hundred rows, whatever the counts.
    for size, words in sorted(often.collect(), reverse=True):
        left -= words
        if left < 0:
            break
        least = size
    return least


def frequent(counts: DataFrame, total: int) -> Words:
    """Words that are exchanged or have a share of one in SENT."""
    least = least_exchanged(counts)
    exchanged = (F.col("n") >= LEAST) & (size_class(F.col("n")) >= least)
    some = counts.select("h", "n", exchanged.alias("exchanged"))
    rows = some.where((F.col("n") * SENT >= total) | F.col("exchanged")).toArrow()
    hashes = rows["h"].to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    hashes, n = hashes[order], rows["n"].to_numpy()[order]
    ids = np.full(len(n), OTHER_ID, dtype=np.uint16)
    rank = np.lexsort((hashes, -n))
    chosen = rows["exchanged"].to_numpy(zero_copy_only=False)[order]
    rank = rank[chosen[rank] & (hashes[rank] != END_HASH)]
    ids[rank] = np.arange(len(rank))
    classes = np.full(len(n), RARE, dtype=np.int8)
    # At first words go round the classes in order of their frequency.
    classes[rank] = np.arange(len(rank)) % CLASSES
    ids[hashes == END_HASH] = END_ID
    classes[hashes == END_HASH] = END
    place_of = F.shiftrightunsigned("h", 64 - MEMBER_BITS).alias("place")
    member = bitmap(counts.where(F.col("n") >= LEAST).select(place_of), "place", 1 << MEMBER_BITS)
    return Words(hashes, n, classes, ids, member, np.zeros(0, dtype=np.int8))


def sequences(training: DataFrame, sent) -> DataFrame:
    """The training texts as 16-bit ids of exchanged words, many texts in a row of bytes, and the
    slot of each other word, or -1 for one that is not placed."""

    def run(batches):
        words = sent.value
        for _, texts in _texts(batches):
            hashed, _ = tokens(texts)
            at, known = words.find(hashed)
            ids = np.where(known, words.ids[at], OTHER_ID) if len(words.ids) else np.full(len(at), OTHER_ID)
            ids[hashed == END_HASH] = END_ID
            other = hashed[ids == OTHER_ID]
            there = in_bitmap(words.member, (other >> np.uint64(64 - MEMBER_BITS)).astype(np.int64))
            slots = np.where(there, slot_of(other), -1).astype(np.int32)
            ids = np.concatenate([[END_ID], ids]).astype(np.uint16)
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids.tobytes()], pa.binary()), pa.array([slots.tobytes()], pa.binary())], ["ids", "slots"]
            )

    return training.mapInArrow(run, "ids binary, slots binary")


def _sequences(batches):
    """Ids, and slots where they are given, of about TOGETHER tokens at a time. Each sequence
    begins and ends with an end, so two of them in a row are one with an end between, once that
    of the second is left out."""
    ids, slots, held = [], [], 0
    for batch in batches:
        for row in range(batch.num_rows):
            some = np.frombuffer(batch.column(0)[row].as_buffer(), dtype=np.uint16)
            ids.append(some[1:] if held else some)
            held += len(ids[-1])
            if batch.num_columns > 1:
                slots.append(np.frombuffer(batch.column(1)[row].as_buffer(), dtype=np.int32))
            if held >= TOGETHER:
                yield np.concatenate(ids), np.concatenate(slots) if slots else None
                ids, slots, held = [], [], 0
    if held:
        yield np.concatenate(ids), np.concatenate(slots) if slots else None


def neighbour_counts(rows: DataFrame, classes: np.ndarray, context) -> DataFrame:
    """(w, near): for each exchanged word the counts of the classes before it and after it, as
    numbers of 64 bits; and for -1 the class bigrams."""
    held = context.broadcast(classes)

    def run(batches):
        of = held.value.astype(np.int64)
        before = np.zeros((1 << 16) * ALL, dtype=np.int64)
        after = np.zeros((1 << 16) * ALL, dtype=np.int64)
        for ids, _ in _sequences(batches):
            place, own = ids.astype(np.int64) * ALL, of[ids]
            before += np.bincount(place[1:] + own[:-1], minlength=len(before))
            after += np.bincount(place[:-1] + own[1:], minlength=len(after))
        before, after = before.reshape(-1, ALL), after.reshape(-1, ALL)
        whole = np.zeros((ALL, ALL), dtype=np.int64)
        np.add.at(whole, of, before)
        before[END_ID:], after[END_ID:] = 0, 0
        # Rows are the classes before, as in class_bigrams.
        yield _packed(-1, whole.T.ravel())
        for block in range(BLOCKS):
            near = np.concatenate([before[block::BLOCKS], after[block::BLOCKS]], axis=1)
            if near.any():
                yield _packed(block, near.ravel())

    def summed(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, at, n in _unpacked(batch):
                if block not in sums:
                    sums[block] = np.zeros(ALL * ALL if block < 0 else (1 << 16) // BLOCKS * 2 * ALL, dtype=np.int64)
                sums[block][at] += n
        for block, near in sums.items():
            near = near.reshape(1, -1) if block < 0 else near.reshape(-1, 2 * ALL)
            there = np.flatnonzero(near.any(axis=1)) if block >= 0 else np.zeros(1, dtype=np.int64)
            w = block + there * BLOCKS
            yield pa.RecordBatch.from_arrays(
                [pa.array(w.astype(np.int32)), pa.array([x.tobytes() for x in near[there]], pa.binary())], ["w", "near"]
            )

    # As many rows as blocks for each task, and sums of fixed size, whatever the number of tasks.
    parts = rows.select("ids").mapInArrow(run, PACKED)
    return parts.repartition("block").mapInArrow(summed, "w int, near binary")


PACKED = "block int, at binary, n binary"


def _packed(block: int, values: np.ndarray) -> pa.RecordBatch:
    """A row of the counts that are not zero."""
    at = np.flatnonzero(values)
    return _row(block, at, values[at])


def _row(block: int, at: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    columns = [[at.astype(np.int32).tobytes()], [n.astype(np.int64).tobytes()]]
    return pa.RecordBatch.from_arrays(
        [pa.array([block], pa.int32()), *[pa.array(c, pa.binary()) for c in columns]], ["block", "at", "n"]
    )


def _unpacked(batch: pa.RecordBatch):
    for row in range(batch.num_rows):
        at, n = (batch.column(c)[row].as_buffer() for c in (1, 2))
        yield batch.column(0)[row].as_py(), np.frombuffer(at, dtype=np.int32), np.frombuffer(n, dtype=np.int64)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def best_class(near: np.ndarray, own: np.ndarray, bigrams: np.ndarray) -> np.ndarray:
    """The class for each word in which the likelihood of the class bigrams gains most.

    ``near`` has the counts of classes before and after each word, ``own`` its class or -1, and
    ``bigrams`` the class bigrams, where the word counts in its own class.
    """
    before, after = near[:, :ALL].astype(np.float64), near[:, ALL:].astype(np.float64)
    into, out_of = bigrams.sum(axis=0), bigrams.sum(axis=1)
    gain = np.zeros((len(near), CLASSES))

    def gained(before, after, column, row, left, right):
        return (
            (_xlogx(column + before) - _xlogx(column)).sum(axis=1)
            + (_xlogx(row + after) - _xlogx(row)).sum(axis=1)
            - (_xlogx(left + after.sum(axis=1)) - _xlogx(left))
            - (_xlogx(right + before.sum(axis=1)) - _xlogx(right))
        )

    for c in range(CLASSES):
        column, row = bigrams[:, c], bigrams[c, :]
        gain[:, c] = gained(before, after, column, row, out_of[c], into[c])
        # A word is taken out of its own class before that class is looked at.
        mine = np.flatnonzero(own == c)
        b, a = before[mine], after[mine]
        left, right = np.maximum(out_of[c] - a.sum(axis=1), 0), np.maximum(into[c] - b.sum(axis=1), 0)
        gain[mine, c] = gained(b, a, np.maximum(column - b, 0), np.maximum(row - a, 0), left, right)
    return gain.argmax(axis=1)


def best_classes(w: np.ndarray, near: np.ndarray, own: np.ndarray | None, bigrams: np.ndarray):
    """Record batches of words and their best classes; ``near`` has a row for each word."""
    for a in range(0, len(w), 4096):
        some = w[a : a + 4096]
        classes = best_class(near[a : a + 4096], own[some] if own is not None else np.full(len(some), -1), bigrams)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array(classes.astype(np.int32))], ["w", "class"]
        )


def moved(near: DataFrame, own: np.ndarray, bigrams: np.ndarray, context) -> tuple[np.ndarray, np.ndarray]:
    """Exchanged words, of which there are EXCHANGED at most, and their best classes."""
    held = context.broadcast((own, bigrams))

    def run(batches):
        for batch in batches:
            counts = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.int64)
            yield from best_classes(batch.column(0).to_numpy(), counts.reshape(-1, 2 * ALL), *held.value)

    found = near.mapInArrow(run, "w int, class int").toArrow()
    return found["w"].to_numpy(), found["class"].to_numpy()


def likelihood(bigrams: np.ndarray) -> float:
    """What the classes of neighbours tell of each other: natural log, for each pair of tokens."""
    told = _xlogx(bigrams).sum() - _xlogx(bigrams.sum(axis=0)).sum() - _xlogx(bigrams.sum(axis=1)).sum()
    pairs = bigrams.sum()
    return float((told + _xlogx(pairs)) / max(1, pairs))


def exchange(rows: DataFrame, words: Words, context) -> tuple[list[tuple[float, int]], np.ndarray]:
    """Moves words between classes, some of them at a time, until few move or ROUNDS are over.

    Words that move together do not see each other's moves, so a round may lose: then its moves
    are undone, and a quarter as many words are looked at from there on. The classes with the
    highest likelihood stay. Returns for each round the likelihood that it started from and the
    number of words that it moved, and at last the likelihood that was reached; and the class
    bigrams of the classes that stay.
    """
    n_ids = int((words.ids < END_ID).sum())
    classes = words.of_ids
    if not n_ids:
        return [], class_bigrams(rows, words, context)
    told: list[tuple[float, int]] = []
    one_in, best, kept = 2, -np.inf, None
    for step in range(ROUNDS + 1):
        near = stored(neighbour_counts(rows, classes, context), "neighbours")
        bigrams = np.zeros((ALL, ALL))
        for r in near.where("w = -1").collect():
            bigrams += np.frombuffer(r.near, dtype=np.int64).reshape(ALL, ALL)
        value = likelihood(bigrams)
        if value >= best:
            best, kept = value, (classes.copy(), near, bigrams)
        else:
            one_in *= 4
        classes, near, bigrams = kept[0].copy(), kept[1], kept[2]
        few = told and told[-1][1] * 1000 < n_ids
        if step == ROUNDS or few:
            told.append((best, 0))
            break
        turn = F.pmod(F.xxhash64("w", F.lit(step)), F.lit(one_in)) == 0
        who, choice = moved(near.where((F.col("w") >= 0) & turn), classes.astype(np.int64), bigrams, context)
        told.append((best, int((classes[who] != choice).sum())))
        classes[who] = choice
    exchanged = words.ids < END_ID
    words.classes[exchanged] = classes[words.ids[exchanged]]
    return told, bigrams


def place(rows: DataFrame, words: Words, bigrams: np.ndarray, context) -> None:
    """Puts the words that occur LEAST times and are not exchanged into the classes where their
    neighbours fit best, by slots; what comes back are bits of SLOTS slots."""
    held = context.broadcast((words.of_ids, bigrams))
    width = BLOCK_SLOTS * 2 * ALL

    def run(batches):
        of = held.value[0]
        seen = Counter()

        def made(keys, n):
            # Keys are sorted: those of each block of slots stand together.
            blocks = np.unique(keys // width)
            borders = [*np.searchsorted(keys, blocks * width).tolist(), len(keys)]
            for block, a, b in zip(blocks.tolist(), borders, borders[1:]):
                yield _row(block, keys[a:b] - block * width, n[a:b])

        for ids, slots in _sequences(batches):
            classes = of[ids].astype(np.int64)
            other = np.flatnonzero(ids == OTHER_ID)
            own, slot = other[slots >= 0], slots[slots >= 0].astype(np.int64)
            # An end stands before the first word of a sequence, and after the last one.
            seen.add(slot * 2 * ALL + classes[own - 1])
            seen.add(slot * 2 * ALL + ALL + classes[own + 1])
            if seen.full():
                yield from seen.batches(made)
        yield from seen.batches(made)

    def best(batches):
        bigrams = held.value[1]
        now, near = None, np.zeros(width, dtype=np.int64)

        def done():
            counts = near.reshape(-1, 2 * ALL)
            there = np.flatnonzero(counts.any(axis=1))
            return best_classes(now * BLOCK_SLOTS + there, counts[there], None, bigrams)

        for batch in batches:
            for block, at, n in _unpacked(batch):
                if block != now:
                    if now is not None:
                        yield from done()
                    now = block
                    near[:] = 0
                near[at] += n
        if now is not None:
            yield from done()

    # Blocks follow each other, so a task holds the sums of one block, of fixed size.
    parts = rows.select("ids", "slots").mapInArrow(run, PACKED)
    found = parts.repartition("block").sortWithinPartitions("block").mapInArrow(best, "w int, class int")
    best = stored(found, "placed")
    slots = np.full(SLOTS, 0, dtype=np.int8)
    numbers = np.arange(SLOTS)
    taken = in_bitmap(bitmap(best.select("w"), "w", SLOTS), numbers)
    for bit in range(CLASSES.bit_length()):
        some = best.where(F.col("class").bitwiseAND(F.lit(1 << bit)) != 0).select("w")
        slots |= in_bitmap(bitmap(some, "w", SLOTS), numbers).astype(np.int8) << bit
    words.slots = np.where(taken, slots, RARE).astype(np.int8)
    held.destroy()


def class_bigrams(rows: DataFrame, words: Words, context) -> np.ndarray:
    """Counts of class pairs over the training texts, with the words placed so far; each text
    begins after an end."""
    held = context.broadcast((words.of_ids, words.slots))

    def run(batches):
        of, of_slots = held.value
        out = np.zeros(ALL * ALL, dtype=np.int64)
        for ids, slots in _sequences(batches):
            classes = of[ids].astype(np.int64)
            if len(of_slots):
                classes[ids == OTHER_ID] = np.where(slots >= 0, of_slots[slots], RARE)
            out += np.bincount(classes[:-1] * ALL + classes[1:], minlength=len(out))
        at = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(out[at])], ["key", "n"])

    parts = rows.select("ids", "slots").mapInArrow(run, "key int, n long")
    found = parts.groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    held.destroy()
    out = np.zeros(ALL * ALL)
    out[found["key"].to_numpy()] = found["n"].to_numpy()
    return out.reshape(ALL, ALL)


@dataclass
class Model:
    """What a task needs to score texts, but for the counts of rare words."""

    words: Words
    emission: np.ndarray
    unigram: np.ndarray
    transition: np.ndarray
    total: int
    distinct: int
    #: Counts with what is added to them, by class.
    mass: np.ndarray
    #: Likelihood and words moved, round by round, and the share of the tokens (but ends) with
    #: a class of their own choice.
    rounds: list[tuple[float, int]]
    classed: float

    @property
    def base_total(self) -> float:
        return self.total + ADDED * (self.distinct + 1)


def class_sizes(counts: DataFrame, held) -> tuple[np.ndarray, np.ndarray]:
    """Occurrences and words of each class, over all words of the training texts."""

    def run(batches):
        n, v = np.zeros(ALL, dtype=np.int64), np.zeros(ALL, dtype=np.int64)
        for batch in batches:
            hashed, times = batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy()
            classes = held.value.classes_of(hashed)[2]
            np.add.at(n, classes, times)
            v += np.bincount(classes, minlength=ALL)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(ALL), pa.int32()), pa.array(n), pa.array(v)], ["c", "n", "v"])

    parts = counts.select("h", "n").mapInArrow(run, "c int, n long, v long")
    n, v = np.zeros(ALL), np.zeros(ALL)
    for r in parts.groupBy("c").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect():
        n[r.c], v[r.c] = r.n, r.v
    return n, v


def fitted(training: DataFrame, counts: DataFrame, context) -> Model:
    """The model of the training texts."""
    total, distinct = (x or 0 for x in counts.agg(F.sum("n"), F.count("*")).first())
    words = frequent(counts, total)
    sent = context.broadcast(words)
    rows = stored(sequences(training, sent), "sequences")
    sent.destroy()
    rounds, bigrams = exchange(rows, words, context)
    place(rows, words, bigrams, context)
    bigrams = class_bigrams(rows, words, context)
    held = context.broadcast(words)
    n, v = class_sizes(counts, held)
    held.destroy()
    # Unknown words.
    v[RARE] += 1
    mass = n + ADDED * v
    classes = words.classes_of(words.hashes)[2]
    emission = np.log10((words.counts + ADDED) / mass[classes])
    emission[classes == END] = 0.0
    usual = (n + 1) / (n.sum() + ALL)
    transition = np.log10((bigrams + ALL * usual) / (bigrams.sum(axis=1, keepdims=True) + ALL))
    classed = float(n[:CLASSES].sum() / max(1.0, total - n[END]))
    model = Model(words, emission, words.counts, transition, total, distinct, mass, rounds, classed)
    model.unigram = np.log10((words.counts + ADDED) / model.base_total)
    told = ", ".join(f"{x:.4f} ({changed} moved)" for x, changed in rounds)
    log.info("log-likelihood per pair, round by round: %s; %.1f %% of the tokens classed", told, 100 * classed)
    return model


def partly_scored(docs: DataFrame, model: Model, context) -> DataFrame:
    """For each text a row (h is null) with what the sent words give, and a row for each other
    word of it, with its class, and its number of occurrences in ``n``."""
    held = context.broadcast(model)
    schema = T.StructType(
        [
            T.StructField("row", T.LongType()),
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("held_out", T.BooleanType()),
            *[T.StructField(c, T.LongType()) for c in ("h", "c", "n", "known")],
            *[T.StructField(c, T.DoubleType()) for c in ("base", "score")],
        ]
    )
    names = schema.names

    def run(batches):
        model = held.value
        for batch, texts in _texts(batches):
            hashed, first = tokens(texts)
            at, known, classes = model.words.classes_of(hashed)
            text = W.row_of(first)
            previous = np.concatenate([[END], classes[:-1]])
            said = model.transition[previous, classes]
            base = np.zeros(len(hashed))
            said[known] += model.emission[at[known]]
            base[known] = model.unigram[at[known]]
            n = len(texts)
            row, doc_id, held_out = (batch.column(i) for i in (1, 2, 3))
            yield pa.RecordBatch.from_arrays(
                [
                    row, doc_id, held_out,
                    pa.nulls(n, pa.int64()),
                    pa.nulls(n, pa.int64()),
                    pa.array(np.diff(first)),
                    pa.array(np.bincount(text[known], minlength=n)),
                    pa.array(np.bincount(text, weights=base, minlength=n)),
                    pa.array(np.bincount(text, weights=said, minlength=n)),
                ],
                names,
            )
            rest = np.flatnonzero(~known)
            if not len(rest):
                continue
            key = W.mixed(hashed[rest] ^ W.mixed(text[rest].astype(np.uint64)))
            _, sample, times = np.unique(key, return_index=True, return_counts=True)
            sample = rest[sample]
            yield pa.RecordBatch.from_arrays(
                [
                    row.take(pa.array(text[sample])),
                    pa.nulls(len(sample), doc_id.type),
                    pa.nulls(len(sample), pa.bool_()),
                    pa.array(hashed[sample].view(np.int64)),
                    pa.array(classes[sample]),
                    pa.array(times.astype(np.int64)),
                    pa.nulls(len(sample), pa.int64()),
                    pa.nulls(len(sample), pa.float64()),
                    pa.nulls(len(sample), pa.float64()),
                ],
                names,
            )

    return docs.mapInArrow(run, schema)


def scored(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and perplexity of
    each text, with the model of the texts that are not held out."""
    context = docs.sparkSession.sparkContext
    name = F.coalesce(named(doc_id).cast("string"), F.lit(""))
    held_out = F.crc32(name.cast("binary")) % HELD_OUT_ONE_IN == 0
    training = docs.where(~held_out).select(named(text).cast("string").alias("text"))
    counts = stored(word_counts(training), "counts")
    model = fitted(training, counts, context)
    sent = docs.select(
        named(text).cast("string").alias("text"),
        F.monotonically_increasing_id().alias("row"),
        named(doc_id).alias("doc_id"),
        held_out.alias("held_out"),
    )
    # Written once, so a row keeps its number.
    part = stored(partly_scored(sent, model, context), "scored")
    whole = part.where("h is null")
    count = F.coalesce(F.col("count"), F.lit(0).cast("long"))
    mass = F.get(F.array(*[F.lit(float(m)) for m in model.mass]), F.col("c"))
    # An unknown word is one of the class of rare words, also where its hash looks like another's.
    # The end is known by its place, not sent only where there are no training texts.
    mass = F.when(count > 0, mass).otherwise(F.lit(float(model.mass[RARE])))
    rare = (
        part.where("h is not null")
        .select("row", "h", F.col("c").cast("int").alias("c"), F.col("n").alias("times"))
        .join(counts.select("h", F.col("n").alias("count")), "h", "left")
        .groupBy("row")
        .agg(
            F.sum(F.when(count > 0, F.col("times")).otherwise(0)).alias("rare_known"),
            F.sum(F.col("times") * F.log10((count + ADDED) / F.lit(model.base_total))).alias("rare_base"),
            F.sum(F.col("times") * F.log10((count + ADDED) / mass)).alias("rare_score"),
        )
    )
    score = F.col("score") + F.coalesce("rare_score", F.lit(0.0))
    return whole.join(rare, "row", "left").select(
        "doc_id",
        "held_out",
        F.col("n").alias("n_tokens"),
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"),
        score.alias("score"),
        F.pow(F.lit(10.0), -score / F.col("n")).alias("perplexity"),
    )
