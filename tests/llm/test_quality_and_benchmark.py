"""Isolation forest on rule statistics, and suffix arrays against a benchmark, by brute force."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import LETTERS, SPACED, awkward, documents, lower, prose
from pyspark.sql import functions as F

from wellspark.llm import decontamination, isolation
from wellspark.llm.suffixes import SuffixArray


def base_rules(text):
    text = text or ""
    words = SPACED.findall(text)
    places = {}
    for i in range(len(words) - 7):
        places.setdefault(tuple(words[i : i + 8]), []).append(i)
    again = {i + j for p in places.values() if len(p) > 1 for i in p for j in range(8)}
    lines = [line for line in text.split("\n") if SPACED.search(line)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(again),
    )


def test_statistics_equal_brute_force(spark):
    rng = random.Random(1)
    rows = awkward(rng)
    block = prose(rng, 12)
    rows += [
        (50, f"{block}\n{block}\n \n{block} ##", "en", "x", 1),
        (51, "a b c d e f g h " * 30, "en", "x", 1),
        (52, "| a || <b> & $5 *\n\n\n|", "en", "x", 1),
    ]
    texts = pa.array([r[1] or "" for r in rows], pa.string())
    found = list(zip(*(c.tolist() for c in isolation.statistics(texts))))
    assert [f[:5] for f in found] == [base_rules(r[1]) for r in rows]


@pytest.fixture(scope="module")
def graded(spark):
    rng = random.Random(2)
    good = [(i, prose(rng, rng.randint(60, 200)), "en", "a", 1) for i in range(300)]
    bad = [
        (1000 + i, "".join(f"{w}#$% " for w in prose(rng, rng.randint(60, 200)).split()), "en", "a", 1)
        for i in range(40)
    ]
    rows = good + bad + awkward(rng)
    labels = [(i, 1, 0) for i, *_ in good[:200]] + [(1000 + i, 0, 0) for i in range(30)]
    labels += [(None, 1, 0), (0, None, 0), (3, 1, 1), (3, 1, 1)]
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_verdicts_keep_good_and_reject_bad(graded):
    docs, labels = graded
    judged = isolation.judged(docs, labels, into="r").select("doc_id", "text", "r.*").collect()
    assert len(judged) == docs.count()
    good = [r.kept for r in judged if r.doc_id is not None and r.doc_id < 300 and r.n_words >= 60]
    bad = [r.kept for r in judged if r.doc_id is not None and r.doc_id >= 1000]
    assert sum(good) >= 0.97 * len(good)
    assert sum(bad) <= 0.1 * len(bad)
    for r in judged:
        stats = base_rules(r.text)
        assert r.base_failed == (stats[0] < 20 or 100 * stats[4] > 30 * stats[0])
        assert not (r.base_failed and r.kept)


def test_threshold_heeds_bad_labels():
    bins, good = np.arange(10), np.array([300, 300, 200, 150, 35, 5, 4, 3, 2, 1])
    bad = np.array([0, 0, 0, 0, 1, 40, 9, 0, 0, 0])
    # 99.5 % of the good rows would let 50 of the 50 bad ones pass.
    assert isolation.threshold(bins, good, bad) == (5 / isolation.BINS, 985, 49)
    # Never below the floor, however many bad rows lie there.
    assert isolation.threshold(bins, good, bad[::-1])[1] >= isolation.LEAST_GOOD * good.sum()
    assert isolation.threshold(bins, good, 0 * bad) == (8 / isolation.BINS, 997, 0)
    assert isolation.threshold(bins, 0 * good, bad) == (2.0, 0, 0)


def test_no_labels_no_rows_and_clashing_columns(graded):
    docs, labels = graded
    plain = isolation.judged(docs, labels.limit(0), into="r").select("r.base_failed", "r.kept")
    assert all(r.kept != r.base_failed for r in plain.collect())
    assert isolation.judged(docs.limit(0), labels, into="r").count() == 0
    clash = docs.withColumn("n_words", F.lit("x")).withColumn("r", F.lit(1)).withColumn("a.b", F.lit(2))
    out = isolation.judged(clash, labels, into="r")
    assert out.columns == [c for c in clash.columns if c != "r"] + ["r"]
    assert out.where("n_words = 'x'").count() == docs.count()


def contamination(text, items):
    words = LETTERS.findall(lower(text or ""))
    hit, found = set(), set()
    for item_id, item in items:
        own = LETTERS.findall(lower(item or ""))
        width = min(13, len(own))
        if not own or item_id is None:
            continue
        windows = {tuple(own[i : i + width]) for i in range(len(own) - width + 1)}
        for i in range(len(words) - width + 1):
            if tuple(words[i : i + width]) in windows:
                hit.update(range(i, i + width))
                found.add(str(item_id))
    digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(words), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(words)


@pytest.fixture(scope="module")
def tested(spark):
    rng = random.Random(3)
    items = [(i, prose(rng, rng.choice([1, 3, 12, 13, 14, 40])) + f" only{i}") for i in range(20)]
    items += [(20, items[5][1]), (20, items[5][1]), (21, None), (None, items[6][1]), (22, " .,"), (23, "日本語テキスト")]
    rows = awkward(rng)
    for i, (_, item) in enumerate(items[:20]):
        words = item.split()
        rows.append((500 + i, f"{prose(rng, 60)} {item.upper()} {prose(rng, 30)}", "en", "a", 1))
        rows.append((600 + i, f"{prose(rng, 5)} {' '.join(words[2:])}, {' '.join(words[:-2])}", "en", "a", 1))
        rows.append((700 + i, f"{item}\n{item} {prose(rng, 900)}", "en", "a", 1))
    return rows, items


def test_contamination_equals_brute_force(spark, tested, monkeypatch):
    rows, items = tested
    docs = documents(spark, rows)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    sizes, real = [], decontamination.block_of
    monkeypatch.setattr(
        decontamination, "block_of", lambda names, texts: sizes.append(len(names)) or real(names, texts)
    )
    results = []
    for block_bytes in (1 << 20, 1200):
        monkeypatch.setattr(decontamination, "BLOCK_BYTES", block_bytes)
        out = decontamination.decontaminated(docs, benchmark, into="r").select("text", "r.*").collect()
        assert len(out) == len(rows)
        for r in out:
            found = (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)
            assert found == contamination(r.text, items), r.text[:80]
            if r.n_hit:
                item = dict((str(i), t) for i, t in items if t)[r.longest_item]
                own, words = LETTERS.findall(lower(item)), LETTERS.findall(lower(r.text))
                a, b, n = r.longest_item_word, r.longest_doc_word, r.longest_words
                assert own[a : a + n] == words[b : b + n] and n >= min(13, len(own))
                assert a + n == len(own) or b + n == len(words) or own[a + n] != words[b + n]
        results.append(sorted(map(repr, out)))
    # One block with all items, then several, each with some of them; the same to the last field.
    assert results[0] == results[1]
    assert len(sizes) >= 4 and max(sizes[1:]) < sizes[0] == sum(sizes[1:])
    kept = decontamination.clean(docs.withColumn("contamination", F.lit(1)), benchmark)
    assert kept.count() == sum(not contamination(r[1], items)[4] for r in rows)
    assert decontamination.clean(docs, benchmark.limit(0)).count() == len(rows)
    assert decontamination.clean(docs.limit(0), benchmark).count() == 0


def test_suffix_array_is_sorted():
    rng = random.Random(4)
    ranks = [rng.choice([1, 2, 3]) for _ in range(300)] + [0] + [1] * 200 + [0]
    import numpy as np

    for distinct in (3, 1 << 22, 1 << 40):
        array = SuffixArray(np.array(ranks), distinct, 13)
        heads = [tuple((ranks + [0] * 40)[p : p + 13]) for p in array.order]
        assert heads == sorted(heads)
