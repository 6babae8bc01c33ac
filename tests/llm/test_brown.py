"""The class model: counts and base score by brute force, probabilities that add up, and a
better held-out score where word order tells something."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import SPACED, awkward, documents, lower, prose
from pyspark.sql import functions as F

from wellspark.llm import brown
from wellspark.llm import words as W


def base(rows):
    """(id, held out, tokens, known, training tokens, base score) by the definition."""
    said = [[*SPACED.findall(lower(r[1] or "")), None] for r in rows]
    out = [zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 10 == 0 for r in rows]
    counts = Counter(w for words, held in zip(said, out) if not held for w in words)
    total, distinct = sum(counts.values()), len(counts)
    score = lambda w: math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1)))
    return [
        (r[0], held, len(words), sum(counts[w] > 0 for w in words), total, round(sum(map(score, words)), 6))
        for r, words, held in zip(rows, said, out)
    ]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(17)
    # Words of two languages alternate between two parts of speech, with rare words in between.
    out = awkward(rng)
    for i in range(300):
        language = rng.choice("ab")
        words = []
        for j in range(rng.randint(5, 120)):
            rare = rng.random() < 0.05
            words.append(f"{language}{j % 2}{rng.randrange(10**6 if rare else 30)}")
        out.append((1000 + i, " ".join(words).title(), "en", "a", 1))
    return out


@pytest.mark.parametrize("limits", [(65_000, 4, 1 << 22), (60, 3, 800), (0, 1, 1)])
def test_counts_and_base_score(spark, rows, limits, monkeypatch):
    for name, value in zip(("EXCHANGED", "LEAST", "SENT"), limits):
        monkeypatch.setattr(brown, name, value)
    docs = documents(spark, rows).withColumn("row", F.lit("x")).withColumn("h", F.lit(1))
    out = brown.scored(docs).collect()
    found = [(*r[:5], round(r.base_score, 6)) for r in out]
    assert sorted(found, key=repr) == sorted(base(rows), key=repr)
    later = [r for r in out if r.held_out and r.doc_id is not None and r.doc_id >= 1000]
    assert len(later) > 10
    assert sum(r.score for r in later) > sum(r.base_score for r in later) + {65_000: 1000, 60: 10, 0: -2000}[limits[0]]
    assert all(r.perplexity == pytest.approx(10 ** (-r.score / r.n_tokens)) for r in out)


def test_probabilities_add_up(spark, rows):
    training = documents(spark, rows).select("text")
    counts = brown.word_counts(training)
    context = spark.sparkContext
    model = brown.fitted(training, counts, context)
    assert np.allclose((10.0**model.transition).sum(axis=1), 1)
    of_word = model.words.classes_of(model.words.hashes)[2]
    inside = np.bincount(of_word, weights=10.0**model.emission, minlength=brown.ALL)
    unknown = brown.ADDED / model.mass[brown.RARE]
    used = np.unique(of_word)
    assert np.allclose(inside[[c for c in used if c != brown.RARE]], 1)
    assert inside[brown.RARE] + unknown == pytest.approx(1)
    # All words are frequent here, so a text's score needs no rare counts.
    said = "A01 b12 a01"
    hashed, _ = brown.tokens(__import__("pyarrow").array([said]))
    at, known, classes = model.words.classes_of(hashed)
    path = [brown.END, *classes]
    by_hand = sum(model.transition[a, b] for a, b in zip(path, path[1:]))
    by_hand += sum(model.emission[a] if k else math.log10(unknown) for a, k in zip(at, known))
    docs = documents(spark, [*rows, (7, said, "en", "a", 1)])
    part = brown.partly_scored(
        docs.where("text = 'A01 b12 a01'").select(
            "text", F.lit(1).cast("long"), "doc_id", F.lit(False)
        ),
        model,
        context,
    ).collect()
    rest = sum(math.log10(unknown) for k in known if not k)
    assert sum(r.score or 0 for r in part) + rest == pytest.approx(by_hand)


def spoken(rng, n, words, name):
    """Texts in which words of two parts of speech alternate, with hapax legomena in between."""
    out = []
    for i in range(n):
        said = [f"{name}{j % 2}x{rng.randrange(words)}" for j in range(40)]
        out.append((i, " ".join([*said, f"{name}once{i}", *said[::-1]]), "en", "a", 1))
    return out


@pytest.mark.parametrize("exchanged", [65_000, 150])
def test_a_word_is_treated_alike_in_a_small_and_in_a_large_corpus(spark, monkeypatch, exchanged):
    """Every word that occurs LEAST times has a class, whatever else the corpus holds, and words
    of the same use still share one."""
    monkeypatch.setattr(brown, "EXCHANGED", exchanged)
    rng = random.Random(41)
    small = spoken(rng, 60, 40, "s")
    large = small + spoken(rng, 900, 300, "t")
    counts = Counter(w for r in small for w in r[1].split())
    often = sorted(w for w, n in counts.items() if n >= brown.LEAST)
    hashed = brown.tokens(__import__("pyarrow").array(often))[0][::2]
    once = brown.tokens(__import__("pyarrow").array([w for w, n in counts.items() if n < brown.LEAST]))[0][::2]
    assert len(often) > 60 and len(once) == 60
    for corpus in (small, large):
        training = documents(spark, corpus).select("text")
        model = brown.fitted(training, brown.word_counts(training), spark.sparkContext)
        classes = model.words.classes_of(hashed)[2]
        assert (classes < brown.CLASSES).all()
        assert (model.words.classes_of(once)[2] == brown.RARE).all()
        # Most classes hold words of one part of speech; by chance half would be out of place. Words
        # that are placed once, and have no exchanged word beside them, learn nothing of theirs.
        parts = [{c: 0 for c in range(brown.CLASSES)} for _ in range(2)]
        for word, c in zip(often, classes.tolist()):
            parts[int(word[1])][c] += 1
        mixed = sum(min(parts[0][c], parts[1][c]) for c in range(brown.CLASSES))
        assert exchanged < 65_000 or mixed <= len(often) // 4
        all_counts = Counter(w for r in corpus for w in r[1].split())
        share = sum(n for n in all_counts.values() if n >= brown.LEAST) / sum(all_counts.values())
        assert model.classed == pytest.approx(share)
        told = [x for x, _ in model.rounds]
        assert len(told) >= 2 and told[-1] > told[0]


def test_ids_of_any_type(spark, rows):
    docs = documents(spark, rows[:60])
    named = docs.withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string")))
    out = brown.scored(named)
    assert dict(out.dtypes)["doc_id"] == "string"
    assert sorted(r.doc_id or "" for r in out.collect()) == sorted("" if r[0] is None else f"d{r[0]}" for r in rows[:60])


def test_best_class_is_the_likeliest():
    rng = np.random.default_rng(18)
    n_words = 12
    text = rng.integers(0, n_words, 400)
    own = rng.integers(0, 4, n_words)

    def likelihood(classes):
        pairs = np.zeros((brown.ALL, brown.ALL))
        np.add.at(pairs, (classes[text[:-1]], classes[text[1:]]), 1)
        f = brown._xlogx
        return f(pairs).sum() - f(pairs.sum(axis=0)).sum() - f(pairs.sum(axis=1)).sum()

    # A word next to itself moves on both sides; the rule leaves that out, so keep them apart.
    text = text[np.append(True, text[1:] != text[:-1])]
    text = text[np.append(True, text[1:] != text[:-1])]
    near = np.zeros((n_words, 2 * brown.ALL), dtype=np.int64)
    np.add.at(near, (text[1:], own[text[:-1]]), 1)
    np.add.at(near, (text[:-1], brown.ALL + own[text[1:]]), 1)
    bigrams = np.zeros((brown.ALL, brown.ALL))
    np.add.at(bigrams, (own[text[:-1]], own[text[1:]]), 1)
    best = brown.best_class(near, own, bigrams)
    for w in range(n_words):
        tried = [likelihood(np.where(np.arange(n_words) == w, c, own)) for c in range(brown.CLASSES)]
        assert tried[best[w]] >= max(tried) - 3.0
        assert tried[best[w]] >= tried[own[w]] - 1e-9 or best[w] == own[w]


def test_empty_tables(spark, rows):
    docs = documents(spark, rows)
    assert brown.scored(docs.limit(0)).count() == 0
    held = [r for r in rows if zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 10 == 0]
    out = brown.scored(documents(spark, held)).collect()
    assert {r.train_tokens for r in out} == {0} and {r.n_known for r in out} == {0}
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in out)


def test_hash_of_the_end_is_no_word():
    texts = __import__("pyarrow").array(["", "a", " a\tB\n"])
    hashed, first = brown.tokens(texts)
    assert first.tolist() == [0, 1, 3, 6]
    assert hashed[[0, 2, 5]].tolist() == [int(brown.END_HASH)] * 3
    assert hashed[1] == hashed[3] != hashed[4]
    assert W.row_of(first).tolist() == [0, 1, 1, 2, 2, 2]


def test_counts_of_neighbours_are_one_row_for_each_word(spark, rows):
    """What the rounds shuffle and sum are blocks of words, not a row for each pair of word and class."""
    context = spark.sparkContext
    training = documents(spark, rows).select("text").repartition(3)
    counts = brown.word_counts(training)
    words = brown.frequent(counts, counts.agg(F.sum("n")).first()[0])
    classes, sent = words.of_ids, context.broadcast(words)
    seq = brown.stored(brown.sequences(training, sent), "sequences")
    near, bigrams = Counter(), Counter()
    for text in [r.text for r in training.collect()]:
        hashed, _ = brown.tokens(__import__("pyarrow").array([text or ""]))
        at, known = words.find(hashed)
        ids = [brown.END_ID, *np.where(hashed == brown.END_HASH, brown.END_ID, words.ids[at]).tolist()]
        for a, b in zip(ids, ids[1:]):
            bigrams[classes[a], classes[b]] += 1
            near[b, classes[a]] += 1
            near[a, brown.ALL + classes[b]] += 1
    found = brown.neighbour_counts(seq, classes, context).collect()
    assert len(found) == len({r.w for r in found}) == (words.ids < brown.END_ID).sum() + 1 > 50
    by_word = {r.w: np.frombuffer(r.near, dtype=np.int64) for r in found}
    whole = by_word.pop(-1).reshape(brown.ALL, brown.ALL)
    assert {(a, b): whole[a, b] for a, b in zip(*np.nonzero(whole))} == bigrams
    assert {(w, k): n[k] for w, n in by_word.items() for k in np.flatnonzero(n)} == {
        k: n for k, n in near.items() if k[0] < brown.END_ID
    }
    assert (brown.class_bigrams(seq, words, context) == whole).all()


def test_sequences_are_joined_at_their_ends(monkeypatch):
    made = [[brown.END_ID, 1, brown.OTHER_ID, brown.END_ID], [brown.END_ID, brown.END_ID], [brown.END_ID, 2, brown.END_ID]]
    slots = [[7], [], []]
    pack = lambda x, kind: np.array(x, dtype=kind).tobytes()
    batch = __import__("pyarrow").RecordBatch.from_arrays(
        [[pack(x, np.uint16) for x in made], [pack(x, np.int32) for x in slots]], ["ids", "slots"]
    )
    for together in (1, 5, 100):
        monkeypatch.setattr(brown, "TOGETHER", together)
        out = list(brown._sequences([batch, batch]))
        pairs = Counter(p for ids, _ in out for p in zip(ids.tolist(), ids[1:].tolist()))
        assert pairs == Counter(p for x in made * 2 for p in zip(x, x[1:]))
        assert all((ids == brown.OTHER_ID).sum() == len(some) for ids, some in out)


def test_words_are_found_by_their_first_bits():
    rng = np.random.default_rng(52)
    for n in (1, 2, 3, 1000):
        hashes = np.sort(np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) << np.uint64(1)))
        if n == 1000:
            hashes = np.unique(np.append(hashes, [np.uint64(0), *(np.uint64(2**64 - 1 - k) for k in range(40))]))
        words = brown.Words(hashes, hashes, hashes, hashes, b"", np.zeros(0))
        sought = np.concatenate([hashes, hashes + np.uint64(1), rng.integers(0, 1 << 62, 500, dtype=np.uint64)])
        at, known = words.find(sought)
        assert known.tolist() == np.isin(sought, hashes).tolist()
        assert (hashes[at[known]] == sought[known]).all()
        assert "begins" not in words.__getstate__()
