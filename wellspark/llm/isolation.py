"""Quality rules: an isolation forest on rule statistics.

Every whole text gives a row of rule statistics (lengths, symbols, repeated lines and words,
capitals, marks). A forest of random splits, grown on a bounded sample of labelled rows, gives
each document a path length; short paths mean unusual statistics. The threshold on the score
comes from all labelled rows, good and bad: it is the one of least balanced error among those
that keep a stated share of the good ones. As in any isolation forest, what is to be found must be the lesser part of the rows it is grown on.

Defined results: a null text is the empty text, has no words and fails the base rules. Rows are
judged one by one, so repeated rows get equal verdicts and null ids do no harm; a null id has no
label. Several labels of one id count as their lowest. Without labelled rows of good quality
there is nothing to calibrate on, and only the base rules reject; with good ones alone the
threshold is the lowest that keeps another stated share of them. An empty table gives no rows.
A column named like the result is replaced.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wellspark.llm import words as W
from wellspark.llm.rows import named, with_result

log = logging.getLogger(__name__)

#: Labelled rows the forest may be grown on; those with the lowest hash of their id are taken.
FIT_ROWS = 8192
TREES = 300
TREE_ROWS = 256
#: The share of good labelled rows, among those the base rules pass, that the threshold keeps
#: where no bad ones are labelled, and the least share that it keeps where some are.
KEEP_GOOD = 0.995
LEAST_GOOD = 0.98
#: Bins of the score, which lies between 0 and 1, when the threshold is looked for.
BINS = 4000

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True
MARKS = np.zeros(256, dtype=bool)
MARKS[list(b"!|\"'()[]{}<>=+~^_\\/@;:?")] = True
CAPITALS = np.zeros(256, dtype=bool)
CAPITALS[ord("A") : ord("Z") + 1] = True

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["n_lines", "n_distinct", "n_capitals", "n_marks"]
STATISTICS = T.StructType([T.StructField(c, T.LongType()) for c in [*BASE, *MORE]])
VERDICT = T.StructType(
    [
        *STATISTICS.fields,
        T.StructField("base_failed", T.BooleanType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("kept", T.BooleanType()),
    ]
)


def statistics(texts: pa.Array) -> list[np.ndarray]:
    """The rule statistics of each text, in the order of STATISTICS."""
    data, borders = W.buffers(texts)
    inside = W.BETWEEN_SPACES[data]
    starts, ends, first = W.runs(inside, borders)
    n_words = np.diff(first)
    rows = W.row_of(first)
    salt = W.mixed(np.arange(len(texts), dtype=np.uint64))

    def per_text(marked: np.ndarray) -> np.ndarray:
        return np.diff(np.searchsorted(np.flatnonzero(marked), borders))

    hashed = W.hashes(data, starts, ends) ^ salt[rows]
    by_word = np.argsort(hashed)
    ranked = hashed[by_word]
    fresh = np.ones(len(ranked), dtype=bool)
    fresh[1:] = ranked[1:] != ranked[:-1]
    n_distinct = np.bincount(rows[by_word[fresh]], minlength=len(texts))

    windows = W.window_hashes(hashed, WINDOW)
    whole = np.flatnonzero(rows[: len(windows)] == rows[WINDOW - 1 :]) if len(windows) else np.zeros(0, np.int64)
    twice = whole[W.repeated(windows[whole])]
    again = W.covered(twice, twice + WINDOW, len(starts))

    line_starts, line_ends, first_line = W.runs(W.NOT_NEWLINE[data], borders)
    words_before = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(inside, out=words_before[1:])
    filled = words_before[line_ends] > words_before[line_starts]
    line_rows = W.row_of(first_line)[filled]
    lines = W.hashes(data, line_starts[filled], line_ends[filled]) ^ salt[line_rows]
    by_line = np.argsort(lines)
    same = lines[by_line[1:]] == lines[by_line[:-1]]
    n_dup_lines = np.bincount(line_rows[by_line[1:]][same], minlength=len(texts))

    return [
        n_words,
        per_text(inside & ((data & 0xC0) != 0x80)),
        per_text(SYMBOLS[data]),
        n_dup_lines,
        W.sums_by_text(again, first),
        np.bincount(line_rows, minlength=len(texts)),
        n_distinct,
        per_text(CAPITALS[data]),
        per_text(MARKS[data]),
    ]


def base_failed(n_words: np.ndarray, n_repeat_words: np.ndarray) -> np.ndarray:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words)


def features(columns: list[np.ndarray]) -> np.ndarray:
    """Shares that do not grow with the length of a text; short texts are drawn towards usual
    values by a few units in the denominators."""
    n, chars, symbols, dup, again, lines, distinct, capitals, marks = (
        np.asarray(c, dtype=np.float64) for c in columns
    )
    return np.column_stack(
        [
            chars / np.maximum(n, 1),
            symbols / (chars + 50),
            dup / (lines + 3),
            again / (n + 10),
            # Distinct words grow like a power of the words.
            distinct / np.maximum(n, 1) ** 0.9,
            capitals / (chars + 50),
            marks / (chars + 50),
        ]
    )


@dataclass
class Forest:
    """Complete binary trees in arrays: a row for each tree, a column for each node."""

    feature: np.ndarray
    cut: np.ndarray
    length: np.ndarray
    depth: int
    usual: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """2 ** (-mean path length / usual path length): near 1 for rows isolated at once."""
        total = np.zeros(len(x))
        at_row = np.arange(len(x))
        for feature, cut, length in zip(self.feature, self.cut, self.length):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                f = feature[node]
                right = x[at_row, np.maximum(f, 0)] >= cut[node]
                node = np.where(f < 0, node, 2 * node + 1 + right)
            total += length[node]
        return 2.0 ** (-total / (len(self.feature) * self.usual))


def usual_length(n: np.ndarray | int) -> np.ndarray:
    """The mean path length of an unsuccessful search among ``n`` rows."""
    n = np.asarray(n, dtype=np.float64)
    many = 2 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2 * (n - 1) / np.maximum(n, 1)
    return np.where(n > 2, many, np.where(n == 2, 1.0, 0.0))


def grow(x: np.ndarray, trees: int = TREES, tree_rows: int = TREE_ROWS, seed: int = 7) -> Forest:
    """A forest on the rows of ``x``: random feature, random cut within the node's range."""
    random = np.random.default_rng(seed)
    tree_rows = min(tree_rows, len(x))
    depth = max(1, int(np.ceil(np.log2(max(2, tree_rows)))))
    nodes = 2 ** (depth + 1) - 1
    feature = np.full((trees, nodes), -1, dtype=np.int64)
    cut = np.zeros((trees, nodes))
    length = np.zeros((trees, nodes))
    for t in range(trees):
        todo = [(0, 0, x[random.choice(len(x), tree_rows, replace=False)])]
        while todo:
            node, level, rows = todo.pop()
            low, high = rows.min(axis=0), rows.max(axis=0)
            open_features = np.flatnonzero(high > low)
            if level == depth or len(rows) <= 1 or not len(open_features):
                length[t, node] = level + usual_length(len(rows))
                continue
            f = random.choice(open_features)
            at = random.uniform(low[f], high[f])
            right = rows[:, f] >= at
            feature[t, node], cut[t, node] = f, at
            todo.append((2 * node + 1, level + 1, rows[~right]))
            todo.append((2 * node + 2, level + 1, rows[right]))
    return Forest(feature, cut, length, depth, float(max(usual_length(tree_rows), 1e-9)))


def labelled_statistics(docs: DataFrame, labels: DataFrame, text: str, doc_id: str) -> DataFrame:
    """The statistics of each document that has a label, and its quality."""
    found = with_result(
        docs.select(named(doc_id).alias("doc_id"), named(text).alias("text")),
        "found", STATISTICS, statistics, keep=["doc_id"],
    )
    quality = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
    )
    return found.join(quality, "doc_id").select("doc_id", "quality", "found.*")


def threshold(bins: np.ndarray, good: np.ndarray, bad: np.ndarray) -> tuple[float, int, int]:
    """The score from which on rows are rejected, the good rows kept and the bad ones rejected.

    ``good`` and ``bad`` count the rows of each of the ascending ``bins``. Of thresholds with
    equal error the one that keeps most is taken.
    """
    n_good, n_bad = int(good.sum()), int(bad.sum())
    if not n_good:
        return 2.0, 0, 0
    kept, passed = np.cumsum(good), np.cumsum(bad)
    if n_bad:
        error = (1 - kept / n_good) + passed / n_bad
        error[kept < LEAST_GOOD * n_good] = np.inf
        last = len(error) - 1 - int(np.argmin(error[::-1]))
    else:
        last = min(int(np.searchsorted(kept / n_good, KEEP_GOOD)), len(bins) - 1)
    return float((bins[last] + 1) / BINS), int(kept[last]), n_bad - int(passed[last])


def fitted(docs: DataFrame, labels: DataFrame, text: str, doc_id: str) -> tuple[Forest | None, float]:
    """The forest and the score from which on documents are rejected."""
    from wellspark.llm.rows import stored

    seen = stored(labelled_statistics(docs, labels, text, doc_id), "labelled")
    names = [*BASE, *MORE]
    sample = (
        seen.select("doc_id", *names)
        .orderBy(F.xxhash64("doc_id"), *names)
        .limit(FIT_ROWS)
        .select(*names)
        .toPandas()
    )
    if sample.empty:
        return None, 1.0
    forest = grow(features([sample[c].to_numpy() for c in names]))

    def scored(batches):
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in names]
            yield pa.RecordBatch.from_arrays(
                [batch.column("quality").cast(pa.int64()), pa.array(forest.scores(features(columns)))],
                names=["quality", "score"],
            )

    passed = seen.where(
        (F.col("n_words") >= MIN_WORDS)
        & (100 * F.col("n_repeat_words") <= MAX_REPEAT_PERCENT * F.col("n_words"))
    )
    bins = (
        passed.mapInArrow(scored, "quality long, score double")
        .groupBy(F.floor(F.col("score") * BINS).cast("int").alias("bin"))
        .agg(
            F.count(F.when(F.col("quality") > 0, 1)).alias("good"),
            F.count(F.when(F.col("quality") <= 0, 1)).alias("bad"),
        )
        .orderBy("bin")
        .toPandas()
    )
    limit, kept, rejected = threshold(*(bins[c].to_numpy() for c in ("bin", "good", "bad")))
    log.info(
        "the forest keeps %d of %d good labelled rows and rejects %d of %d bad ones",
        kept, bins["good"].sum(), rejected, bins["bad"].sum(),
    )
    return forest, limit


def judged(
    docs: DataFrame,
    labels: DataFrame,
    *,
    text: str = "text",
    doc_id: str = "doc_id",
    into: str = "quality_rules",
    keep: list[str] | None = None,
) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the struct ``into``: statistics, score, verdict."""
    forest, limit = fitted(docs, labels, text, doc_id)

    def compute(texts: pa.Array) -> list[np.ndarray]:
        columns = statistics(texts)
        failed = base_failed(columns[0], columns[4])
        if forest is None:
            score = np.zeros(len(texts))
        else:
            score = forest.scores(features(columns))
        return [*columns, failed, score, ~failed & (score < limit)]

    return with_result(docs, into, VERDICT, compute, text=text, keep=keep)
