"""The stages one after another, each against its operator's definition on its own input."""

import random

import corpus_pipeline
import pytest
from helpers import LETTERS, awkward, documents, lower, prose

from wellspark.llm import order_minhash, queries
from wellspark.llm.rows import stored


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    """documents, labels and benchmark with all that the stages look for."""
    rng = random.Random(19)
    folder = tmp_path_factory.mktemp("sf")
    rows = awkward(rng)
    good = [(1000 + i, prose(rng, rng.randint(60, 150)), "en", rng.choice("abc"), 1) for i in range(200)]
    bad = [(2000 + i, "".join(f"{w}#$% " for w in prose(rng, 80).split()), "en", "a", 1) for i in range(30)]
    lined = [(3000 + i, f"{prose(rng, 60)}\nthe same line everywhere\n{prose(rng, 9)}", "en", "d", 1) for i in range(20)]
    item = prose(rng, 40)
    leaked = [(4000 + i, f"{prose(rng, 50)} {item} {prose(rng, 50)}", "en", "a", 1) for i in range(10)]
    near = [(5000 + i, good[i][1] + " more", "en", "a", 1) for i in range(10)]
    same = [(6000 + i, good[i][1], "en", "a", 1) for i in range(10)]
    documents(spark, rows + good + bad + lined + leaked + near + same).write.parquet(f"{folder}/documents.parquet")
    labels = [(r[0], 1, 0) for r in good[:150]] + [(r[0], 0, 0) for r in bad[:6]]  # anomalies are few
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_each_stage_takes_effect(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, sf), "stage")
        if name != "pieces":
            assert docs.columns == names
        kept.append({r.doc_id: r.text for r in docs.select("doc_id", "text").collect()})
    rules, lines, near, clean, pieces = kept
    assert len([i for i in rules if i is not None and 2000 <= i < 3000]) <= 3
    assert len([i for i in rules if i is not None and 1000 <= i < 2000]) >= 195
    assert rules.keys() == lines.keys()
    assert "the same line everywhere" in rules[3000] and "the same line" not in lines[3000]
    for i in range(10):
        assert len({1000 + i, 5000 + i, 6000 + i} & near.keys()) <= 1
    assert [i for i in near if i is not None and 4000 <= i < 5000]
    assert not [i for i in clean if i is not None and 4000 <= i < 5000]
    assert pieces == clean
    assert docs.where("not round_trip").count() == 0


def test_copies_of_a_text_are_no_boilerplate(spark, sf):
    rng = random.Random(23)
    line = "a line of many texts"
    copied = f"{prose(rng, 40)}\n{line}\n{prose(rng, 30)}"
    rows = [(i, copied, "en", "s", 1) for i in range(40)]
    rows += [(100 + i, f"{prose(rng, 50)}\n{line}", "en", "s", 1) for i in range(20)]
    rows += [(200, None, "en", "s", 1), (201, copied, "en", None, 1)]
    out = corpus_pipeline.lines(spark, documents(spark, rows), sf)
    texts = {r.doc_id: r.text for r in out.collect()}
    assert len(texts) == len(rows)
    assert {texts[i] for i in range(40)} == {copied.replace(f"\n{line}\n", "\n")}
    assert all(texts[100 + i] == rows[40 + i][1].split(f"\n{line}")[0] for i in range(20))
    assert texts[200] is None and texts[201] == copied


def test_a_family_of_near_copies_keeps_its_lines(spark, sf):
    """60 texts of ten lines, one line changed in each, among 300 others of one source, and a
    line that the others share: only that one goes, and one text of the family stays whole."""
    rng = random.Random(29)
    shared = [prose(rng, 20).replace("\n", " ") for _ in range(10)]
    rows = []
    for i in range(60):
        own = list(shared)
        own[i % 10] = prose(rng, 20).replace("\n", " ")
        rows.append((i, "\n".join(own), "en", "s", 1))
    line = "a line of many texts"
    rows += [(1000 + i, f"{prose(rng, 70)}\n{line}\n{prose(rng, 9)}", "en", "s", 1) for i in range(300)]
    docs = stored(corpus_pipeline.lines(spark, documents(spark, rows), sf), "stage")
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(texts[i] == rows[i][1] for i in range(60))
    assert not any(line in texts[1000 + i] for i in range(300))
    kept = {r.doc_id: r.text for r in corpus_pipeline.near_copies(spark, docs, sf).collect()}
    assert [i for i in kept if i < 1000] == [0] and kept[0] == rows[0][1]
    held = {said for text in kept.values() for said in text.split("\n")}
    assert set(shared[1:]) <= held and len(kept) == 301


def test_run_is_the_stages(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
    key = lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
    assert key(out) == key(docs)


def test_empty_documents(spark, sf, tmp_path):
    import shutil

    for name in ("labels", "benchmark"):
        shutil.copytree(f"{sf}/{name}.parquet", f"{tmp_path}/{name}.parquet")
    spark.read.parquet(f"{sf}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_queries_are_named_by_operator():
    numbers = [int(q[2:].split("_")[0]) for q in queries.QUERIES]
    assert numbers == list(range(1, 14))
    words = LETTERS.findall(lower("A b"))
    assert order_minhash.SHINGLE == 5 and order_minhash.SIMILARITY == 0.8 and words == ["a", "b"]
