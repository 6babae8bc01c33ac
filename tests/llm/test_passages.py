"""Repeated passages by brute force over all windows of 50 words."""

import random
from collections import defaultdict

import numpy as np
from helpers import LETTERS, awkward, documents, lower, prose
from pyspark.sql import functions as F

from wellspark.llm import sparse_suffixes


def passages(rows):
    """(doc_id, start, end) of the maximal runs of words in windows that stand elsewhere."""
    holders = defaultdict(set)
    texts = {(r[0], r[1]) for r in rows if r[1]}
    said = {t: LETTERS.findall(lower(t[1])) for t in texts}
    for key, words in said.items():
        for i in range(len(words) - 49):
            holders[tuple(words[i : i + 50])].add((key, i))
    out = []
    for key, words in said.items():
        covered = [False] * (len(words) + 1)
        for i in range(len(words) - 49):
            places = holders[tuple(words[i : i + 50])]
            if len({k[0] for k, _ in places}) > 1 or len({p for k, p in places if k == key}) > 1:
                covered[i : i + 50] = [True] * 50
        start = None
        for i, c in enumerate(covered):
            if c and start is None:
                start = i
            elif not c and start is not None:
                out.append((key[0], start, i))
                start = None
    return sorted(out, key=repr)


def test_passages_equal_brute_force(spark):
    rng = random.Random(12)
    rows = [r for r in awkward(rng) if r[0] != 6]
    base = prose(rng, 300).split(" ")
    for i in range(40):
        a = rng.randrange(200)
        cut = base[a : a + rng.choice([48, 49, 50, 51, 70, 100])]
        rows.append((1000 + i, f"{prose(rng, 30)} {' '.join(cut).upper()} {prose(rng, 30)}", "en", "a", 1))
    for i in range(30):
        near = list(base)
        for _ in range(6):
            near[rng.randrange(300)] = "changed"
        rows.append((2000 + i, " ".join(near), "en", "a", 1))
    twice = prose(rng, 60)
    rows += [(3000, f"{twice} between {twice}", "en", "a", 1), (3001, "la " * 120, "en", "a", 1)]
    rows += [(3002, prose(rng, 80), "en", "a", 1)] * 3 + [(None, prose(rng, 90), "en", "a", 1)]
    rows += [(3003, rows[-1][1], "en", "a", 1), (None, prose(rng, 90), "en", "a", 1)]
    docs = documents(spark, rows).withColumn("doc", F.lit(1)).withColumn("window", F.lit("x"))
    found = sparse_suffixes.passages(docs).collect()
    assert sorted(((r.doc_id, r.start_word, r.end_word) for r in found), key=repr) == passages(rows)
    assert all(r.n_words == r.end_word - r.start_word >= 50 for r in found)
    said = defaultdict(set)
    for r in rows:
        words = LETTERS.findall(lower(r[1] or ""))
        said[r[0]] |= {tuple(words[i : i + 50]) for i in range(len(words) - 49)}
    for r in found:
        if r.doc_id is not None and r.other_doc_id is not None:
            assert r.other_doc_id != r.doc_id and said[r.doc_id] & said[r.other_doc_id]
    assert sparse_suffixes.passages(docs.limit(0)).count() == 0


def test_neighbours_on_two_sides_of_a_border_and_on_two_sides_of_a_phrase(spark):
    """A suffix whose longest matches to the right and to the left are with different documents,
    and many more ranges than suffixes: nothing is lost."""
    rng = random.Random(77)
    left, right = [prose(rng, 45, 10**6).split() for _ in range(2)]
    rows = [(1, " ".join([*left, *right]), "en", "a", 1)]
    for cut in range(0, 45, 4):
        rows.append((100 + cut, " ".join([*prose(rng, 9, 10**6).split(), *left[cut:], *right[: cut + 8], "x"]), "en", "a", 1))
        rows.append((200 + cut, " ".join([*right[cut:], *prose(rng, 40, 10**6).split()]), "en", "a", 1))
    rows += [(300 + i, " ".join(right) + f" {i} " + prose(rng, 30, 10**6), "en", "a", 1) for i in range(30)]
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = sparse_suffixes.passages(documents(spark, rows)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted(((r.doc_id, r.start_word, r.end_word) for r in found), key=repr) == passages(rows)


def test_copies_are_told_by_their_neighbours(spark, monkeypatch):
    """No window of a large group of copies has to be looked up."""
    asked = []
    real = sparse_suffixes.looked_up

    def counted(sent, windows, repeated):
        asked.append(windows.count())
        return real(sent, windows, repeated)

    monkeypatch.setattr(sparse_suffixes, "looked_up", counted)
    rng = random.Random(5)
    copied, shared = prose(rng, 400), prose(rng, 30)
    rows = [(i, copied, "en", "a", 1) for i in range(300)]
    rows += [(1000 + i, f"{prose(rng, 60)} {shared} {prose(rng, 60)}", "en", "a", 1) for i in range(5)]
    found = sparse_suffixes.passages(documents(spark, rows)).collect()
    assert sorted((r.doc_id, r.start_word, r.end_word) for r in found) == [(i, 0, 400) for i in range(300)]
    assert all(r.other_doc_id != r.doc_id for r in found)
    # At most the ends of the ranges, and the windows around the short passage.
    assert asked[0] <= 4 * 2 * 39 + 5 * 2 * 39


def test_passages_of_ids_that_are_no_numbers(spark):
    rng = random.Random(6)
    shared = prose(rng, 60)
    rows = [(i, f"{prose(rng, 20)} {shared}", "en", "a", 1) for i in range(3)] + [(None, shared, "en", "a", 1)]
    docs = documents(spark, rows).withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string")))
    found = sparse_suffixes.passages(docs).collect()
    assert {r.doc_id for r in found} == {"d0", "d1", "d2", None}
    assert all(r.other_doc_id != r.doc_id for r in found if r.doc_id)


def test_sliding_least():
    values = np.random.default_rng(1).integers(0, 100, 200)
    for width in (1, 2, 3, 31, 32, 39, 41):
        expected = [values[i : i + width].min() for i in range(len(values) - width + 1)]
        assert sparse_suffixes.sliding_least(values, width).tolist() == expected
