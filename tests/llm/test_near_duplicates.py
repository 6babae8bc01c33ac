"""Order MinHash with banded alignment, and components, by brute force."""

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from helpers import LETTERS, awkward, documents, lower, prose
from pyspark.sql import functions as F

from wellspark.llm import order_minhash
from wellspark.llm.components import components


def distance(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a):
        row = [i + 1]
        for j, y in enumerate(b):
            row.append(min(row[-1] + 1, last[j + 1] + 1, last[j] + (x != y)))
        last = row
    return last[-1]


def test_alignment_equals_full_table():
    rng = random.Random(9)
    for _ in range(3000):
        few = rng.choice([2, 3, 6])
        a = [rng.randint(1, few) for _ in range(rng.randint(0, 14))]
        b = list(a) if rng.random() < 0.6 else [rng.randint(1, few) for _ in range(rng.randint(0, 14))]
        for _ in range(rng.randint(0, 4)):
            if b and rng.random() < 0.5:
                b.pop(rng.randrange(len(b)))
            else:
                b.insert(rng.randint(0, len(b)), rng.randint(1, few))
        limit = rng.randint(0, 14)
        found = order_minhash.edits(np.array(a, np.uint32), np.array(b, np.uint32), limit)
        assert found == min(distance(a, b), limit + 1), (a, b, limit)


def test_bands_keep_text_order():
    one, other = "a b c d e f g h i j k l m n o p", "i j k l m n o p a b c d e f g h"
    same = order_minhash.bands(pa.array([one, one.upper() + " !", other, "a b", "b a", ""]))[0].to_pylist()
    assert same[0] == same[1] and same[0] != same[2] and same[3] != same[4] and same[5] == []
    assert len(same[3]) == order_minhash.TABLES * len(order_minhash.KEPT)
    # The same shingle again is another k-mer, so a repetition changes the bands.
    again = order_minhash.bands(pa.array(["x y z u v " * 2, "x y z u v " * 9]))[0].to_pylist()
    assert again[0] != again[1]


def edited(rng, text, n):
    words = text.split(" ")
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randint(0, 99)}"
    return " ".join(words)


def test_classes_equal_brute_force(spark):
    rng = random.Random(10)
    rows = awkward(rng)
    for g in range(30):
        base = prose(rng, rng.randint(4, 150))
        for i in range(rng.randint(1, 8)):
            rows.append((10_000 + 100 * g + i, edited(rng, base, rng.choice([0, 0, 1, 2])), "en", "a", 1))
    # A passage that many texts share, and a large group of copies of near copies.
    shared = prose(rng, 60)
    rows += [(20_000 + i, f"{prose(rng, 40)} {shared} {prose(rng, 40)}", "en", "a", 1) for i in range(80)]
    rows += [(30_000 + i, edited(rng, shared, i % 3), "en", "a", 1) for i in range(80)]
    rng.shuffle(rows)
    words = [LETTERS.findall(lower(r[1] or "")) for r in rows]
    shingles = [
        {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in words
    ]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    must = []
    for i in range(len(rows)):
        for j in range(i):
            equal = (rows[i][1] or "") == (rows[j][1] or "")
            near = shingles[i] and len(shingles[i] & shingles[j]) >= 0.8 * len(shingles[i] | shingles[j])
            if equal or near:
                must.append((i, j))
            n = max(len(words[i]), len(words[j]))
            limit = int(0.2 * n + 1e-9)
            close = words[i] and words[j] and order_minhash.edits(
                np.array([hash(w) & 0xFFFFFFFF for w in words[i]], np.uint32),
                np.array([hash(w) & 0xFFFFFFFF for w in words[j]], np.uint32),
                limit,
            ) <= limit
            if equal or close:
                parent[root(i)] = root(j)
    docs = documents(spark, rows).withColumn("node", F.lit(1)).withColumn("a", F.lit("x"))
    found = order_minhash.classes(docs).collect()
    assert len(found) == len(rows)
    by_key = {}
    for r in found:
        by_key[r.node.hex()] = (r.class_id, r.keeper)
    import hashlib

    mine = [by_key[hashlib.md5((r[1] or "").encode()).hexdigest()] for r in rows]
    assert all(mine[i] == mine[j] for i, j in must)
    # Nothing that no chain of close pairs joins is in one class.
    groups = defaultdict(set)
    for i in range(len(rows)):
        groups[mine[i]].add(root(i))
    assert all(len(g) == 1 for g in groups.values())
    kept = order_minhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len(groups)
    ids = Counter(r.doc_id for r in kept.collect())
    assert all(ids[c] == 1 for c, _ in groups if c is not None)
    assert order_minhash.classes(docs.limit(0)).count() == 0
    assert order_minhash.one_of_each(docs.limit(0)).count() == 0


@pytest.mark.parametrize("block, crowd", [(order_minhash.BLOCK, order_minhash.CROWD), (16, 40), (16, 3)])
def test_members_of_a_band_meet_each_other(spark, block, crowd, monkeypatch):
    """Variants of an absent text, each with a block of its own rewritten: few are like the hub,
    but chains of overlapping blocks make them one class, also by way of finer bands."""
    monkeypatch.setattr(order_minhash, "BLOCK", block)
    monkeypatch.setattr(order_minhash, "CROWD", crowd)
    rng = random.Random(21)
    base = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    rows = []
    for i in range(120):
        at = rng.randrange(256)
        made = [f"n{rng.randrange(10**6)}" for _ in range(45)]
        rows.append((i, " ".join([*base[:at], *made, *base[at + 45 :]]), "en", "a", 1))
    said = [np.array([hash(w) & 0xFFFFFFFF for w in r[1].split()], np.uint32) for r in rows]
    links = [
        (i, j) for i in range(120) for j in range(i) if order_minhash.edits(said[i], said[j], 60) <= 60
    ]
    root = list(range(120))
    for i, j in links * 8:
        root[i] = root[j] = min(root[i], root[j])
    for i in reversed(range(120)):
        while root[i] != root[root[i]]:
            root[i] = root[root[i]]
    found = {r.doc_id: r.class_id for r in order_minhash.classes(documents(spark, rows)).collect()}
    assert [found[i] for i in range(120)] == root


@pytest.mark.parametrize("size", [100, 300, 1000])
def test_large_families_are_one_class(spark, size):
    """Variants of an absent text, a sixth of each rewritten, beside texts with a common passage."""
    rng = random.Random(size)
    base = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    rows = []
    for i in range(size):
        at = rng.randrange(256)
        made = [f"n{rng.randrange(10**6)}" for _ in range(45)]
        rows.append((i, " ".join([*base[:at], *made, *base[at + 45 :]]), "en", "a", 1))
    for i in range(size):
        own = [f"p{rng.randrange(10**6)}" for _ in range(60)]
        rows.append((10_000 + i, " ".join([*own, *base[:50]]), "en", "a", 1))
    found = {r.doc_id: r.class_id for r in order_minhash.classes(documents(spark, rows)).collect()}
    assert {found[i] for i in range(size)} == {0}
    assert all(found[10_000 + i] == 10_000 + i for i in range(size))


def test_a_crowd_that_shares_a_passage_is_parted(spark, monkeypatch):
    """Pairs of near copies within a crowd of unlike texts are found by finer bands, and no pair
    is made for texts that share the passage alone."""
    monkeypatch.setattr(order_minhash, "CROWD", 20)
    made = []
    real = order_minhash.across

    def counted(*args):
        made.append(real(*args))
        return made[-1]

    monkeypatch.setattr(order_minhash, "across", counted)
    rng = random.Random(31)
    passage = prose(rng, 60)
    rows = []
    for i in range(150):
        text = f"{prose(rng, 70, 5000)} {passage} {prose(rng, 40, 5000)}"
        rows.append((2 * i, text, "en", "a", 1))
        rows.append((2 * i + 1, edited(rng, text, 3), "en", "a", 1))
    found = {r.doc_id: r.class_id for r in order_minhash.classes(documents(spark, rows)).collect()}
    assert all(found[2 * i] == found[2 * i + 1] == 2 * i for i in range(150))
    assert len(made) >= 2 and sum(m.count() for m in made) < 300


def test_names_of_other_columns_are_free(spark):
    names = ["__key", "__node", "__doc_id", "row", "row_id", "kept_id", "kept_node", "one", "node", "key", "band"]
    docs = documents(spark, awkward(random.Random(3)))
    for name in names:
        docs = docs.withColumn(name, F.lit(name))
    out = order_minhash.one_of_each(docs)
    assert out.columns == docs.columns and out.schema == docs.schema
    assert all(r[name] == name for r in out.collect() for name in names)


def test_bound_of_words_is_below_the_alignment():
    rng, refused = random.Random(22), 0
    for _ in range(300):
        a = np.array([rng.randrange(200) for _ in range(rng.randint(1, 60))], np.uint32)
        b = a.tolist()
        for _ in range(rng.randint(0, 20)):
            b.insert(rng.randint(0, len(b)), rng.randrange(200))
            b.pop(rng.randrange(len(b))) if rng.random() < 0.6 else None
        b = np.array(b, np.uint32)
        packed = [x.tobytes() for x in (a, b)]
        texts = order_minhash.Texts(
            np.array([len(a), len(b)]),
            [order_minhash.word_bins(x) for x in packed],
            [order_minhash.word_bag(x) for x in packed],
        )
        may = texts.may_be_alike(0, np.array([1]), 0.8).tolist()
        if order_minhash.alike(*packed, 0.8):
            assert may == [1]
        refused += not may
    assert refused > 10


def test_components(spark):
    rng = random.Random(11)
    links = [(i, i + 1) for i in range(40)] + [(100, 100), (None, 3), (50, 60), (60, 50), (50, 60)]
    links += [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(50)]
    out = components(spark.createDataFrame(links, "a long, b long")).collect()
    found = {r.node: r.root for r in out}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    assert found == {x: root(x) for x in parent if root(x) != x}
    assert len(out) == len(found)


def test_links_of_a_crowd_that_share_no_finer_band(spark, monkeypatch):
    """Every third word that a text has of its own is another one in its partner, so they share no
    run of five words but those of the passage that the whole crowd has."""
    monkeypatch.setattr(order_minhash, "CROWD", 20)
    rng = random.Random(41)
    passage = [f"p{rng.randrange(10**6)}" for _ in range(150)]
    rows = []
    for i in range(40):
        own = [f"w{rng.randrange(10**6)}" for _ in range(60)]
        other = [f"n{rng.randrange(10**6)}" if k % 3 == 0 else w for k, w in enumerate(own)]
        rows.append((2 * i, " ".join([*passage, *own]), "en", "a", 1))
        rows.append((2 * i + 1, " ".join([*passage, *other]), "en", "a", 1))
    found = {r.doc_id: r.class_id for r in order_minhash.classes(documents(spark, rows)).collect()}
    assert found == {i: i - i % 2 for i in range(80)}


@pytest.mark.parametrize("similarity", [0.8, 0.6])
def test_linked_texts_have_a_rare_run_in_common(similarity):
    rng, linked = random.Random(42), 0
    for _ in range(600):
        few = rng.choice([3, 50, 10_000])
        a = [rng.randrange(few) for _ in range(rng.randint(1, 60))]
        b = list(a)
        for _ in range(rng.randint(0, 14)):
            b.insert(rng.randint(0, len(b)), rng.randrange(few))
            b.pop(rng.randrange(len(b))) if rng.random() < 0.6 else None
        a, b = np.array(a, np.uint32), np.array(b, np.uint32)
        if not order_minhash.alike(a.tobytes(), b.tobytes(), similarity):
            continue
        linked += 1
        counts = np.array([rng.randrange(9) for _ in range(64)] * (order_minhash.RUN_SLOTS // 32))
        one, sought = order_minhash.rare_runs(a, counts, similarity)
        two, wanted = order_minhash.rare_runs(b, counts, similarity)
        assert set(one[sought].tolist()) & set(two.tolist())
        assert set(two[wanted].tolist()) & set(one.tolist())
        assert not order_minhash.unlike_bags(a.tobytes(), b.tobytes(), similarity)
    assert linked > 50


def test_few_rows_are_worked_on_in_few_tasks(spark):
    """With many partitions that nothing joins together, small steps do not become tasks by the
    hundred each: it is the rows that decide."""
    rng = random.Random(51)
    rows = []
    for i in range(60):
        text = prose(rng, 80, 5000)
        rows += [(2 * i, text, "en", "a", 1), (2 * i + 1, edited(rng, text, 4), "en", "a", 1)]
    docs = documents(spark, rows)
    partitions, joined = "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled"
    before = {name: spark.conf.get(name) for name in (partitions, joined)}
    context, tracker = spark.sparkContext, spark.sparkContext.statusTracker()
    context.setJobGroup("few rows", "")
    try:
        spark.conf.set(partitions, "100")
        spark.conf.set(joined, "false")
        roots = order_minhash.rooted(docs.select(order_minhash.node_of(F.col("text")).alias("node"), "text"), 0.8)
        assert roots.count() == 60
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        for name, value in before.items():
            spark.conf.set(name, value)
    stages = {s for j in tracker.getJobIdsForGroup("few rows") for s in tracker.getJobInfo(j).stageIds}
    done = [tracker.getStageInfo(s) for s in stages]
    assert sum(s.numCompletedTasks for s in done if s) < 1000
