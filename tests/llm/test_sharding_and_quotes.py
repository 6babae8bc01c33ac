"""Sampled splitters and quotation linking, by brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

from helpers import awkward, documents, prose
from pyspark.sql import functions as F

from wellspark.llm import queries, quotations, splitters


def placed(rows, shards):
    keyed = []
    for doc_id, text, *_ in rows:
        said = (text or "").encode()
        name = "" if doc_id is None else str(doc_id)
        key = hashlib.md5(said).hexdigest() + hashlib.md5(name.encode()).hexdigest()
        keyed.append((key, doc_id, len(said) + 16, zlib.crc32(said)))
    keyed.sort(key=lambda r: r[0])
    total, at, slots, out = sum(r[2] for r in keyed), 0, Counter(), []
    for _, doc_id, size, crc in keyed:
        shard = (2 * at + size) * shards // (2 * total)
        out.append((doc_id, size, crc, shard, slots[shard]))
        slots[shard] += 1
        at += size
    return sorted(out, key=repr)


def test_shards_equal_brute_force(spark, monkeypatch):
    rng = random.Random(7)
    rows = awkward(rng) + [(7000 + i, "the same text", "en", "a", 1) for i in range(400)]
    rows += [(1, "again", "en", "a", 1)] * 30
    docs = documents(spark, rows).withColumn("key", F.lit(1)).withColumn("size", F.lit(1))
    found = sorted((tuple(r) for r in splitters.sharded(docs, shards=5).collect()), key=repr)
    assert found == placed(rows, 5)
    # Few sampled keys: ranges start overfull and are subdivided.
    monkeypatch.setattr(splitters, "SAMPLE", 2)
    monkeypatch.setattr(splitters, "OVERFULL", 1)
    found = sorted((tuple(r) for r in splitters.sharded(docs, shards=3).collect()), key=repr)
    assert found == placed(rows, 3)
    assert splitters.sharded(docs.limit(0)).count() == 0


def test_sizes_near_equal_and_slots_gapless(spark, sf_dir):
    out = queries.op5_sampled_splitters(spark, sf_dir).collect()
    sizes, slots, largest = Counter(), defaultdict(list), max(r["size"] for r in out)
    for r in out:
        sizes[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    mean = sum(sizes.values()) / 40
    assert all(abs(sizes[s] - mean) <= largest for s in range(40))
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert {r.law for r in out} == {"bytes"} and {r.grown_shard for r in out} == {None}


def conversation(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_nested_quotes_link_and_go(spark):
    rows = [
        (1, 0, "user", "Shall we meet?\nOn Monday, say."),
        (1, 1, "assistant", "> Shall we   MEET?\n> On Monday, say.\n\nYes, at ten.\n"),
        (1, 2, "user", "On Friday A wrote:\n> > On Monday,\n>> say.\n> Yes, at ten.\nThen at ten it is."),
        (1, 3, "user", "Something else."),
        (1, 4, "assistant", ">Something else.\n>> never said\nIndeed > that."),
        (1, 5, "user", "> Shall we meet?\nI ask again."),
        (1, 5, "assistant", "Same turn."),
        (1, 5, "assistant", "Same turn."),
        (1, 6, "user", "> quoted and nothing else"),
        (2, 3, "user", "> Yes, at ten.\nAnother conversation."),
        (None, 1, "user", "> Shall we meet?\nNowhere."),
        (2, None, "user", None),
        (2, 4, None, None),
        (2, 5, "user", ""),
    ]
    frame = conversation(spark, rows).withColumn("position", F.lit("x")).withColumn("level", F.lit(1))
    out = {(r.conv_id, r.turn, r.role): r for r in quotations.conversations(frame).collect()}
    assert len(out) == 13
    get = lambda *key: out[key][3:]
    assert get(1, 0, "user") == ("Shall we meet?\nOn Monday, say.", 0, 0, None, 0, 0)
    assert get(1, 1, "assistant") == ("Yes, at ten.", 1, 1, 0, 0, 1)
    assert get(1, 2, "user") == ("Then at ten it is.", 2, 2, 1, 0, 2)
    assert get(1, 5, "user") == ("I ask again.", 1, 1, 0, 0, 4)
    assert get(1, 5, "assistant") == ("Same turn.", 0, 0, None, 0, 3)
    assert get(1, 3, "user") == ("Something else.", 0, 0, None, 3, 5)
    assert get(1, 4, "assistant") == ("Indeed > that.", 2, 1, 3, 3, 6)
    assert get(1, 6, "user") == ("", 1, 0, None, 6, 7)
    assert get(2, 3, "user") == ("Another conversation.", 1, 0, None, 3, 0)
    assert get(None, 1, "user") == ("Nowhere.", 1, 0, None, None, None)
    assert get(2, None, "user") == (None, 0, 0, None, None, None)
    assert get(2, 4, None) == (None, 0, 0, None, 4, 1)
    assert get(2, 5, "user") == ("", 0, 0, None, 5, 2)
    assert quotations.conversations(frame.limit(0)).count() == 0


def test_long_chain_and_stretches(spark, monkeypatch):
    monkeypatch.setattr(quotations, "STRETCH", 4)
    rng = random.Random(8)
    texts = [f"{prose(rng, 5)} number {i}" for i in range(60)]
    up = [None if i % 20 == 0 else rng.randrange(i - i % 20, i) for i in range(60)]
    rows = [
        (1, i, "user", texts[i] if up[i] is None else "> " + texts[up[i]].replace("\n", "\n> ") + "\n" + texts[i])
        for i in range(60)
    ]
    out = sorted(quotations.conversations(conversation(spark, rows)).collect(), key=lambda r: r.turn)
    assert [r.parent_turn for r in out] == up
    assert [r.thread_turn for r in out] == [i - i % 20 for i in range(60)]
    assert [r.position for r in out] == list(range(60))
    assert [r.text for r in out] == [t.rstrip() for t in texts]


def test_query_gives_back_what_was_said(spark, sf_dir):
    said = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    out = queries.op1_quotation_linking(spark, sf_dir)
    both = out.alias("o").join(said.alias("s"), ["conv_id", "turn"])
    assert both.count() == said.count()
    assert both.where("o.text <> rtrim(s.text) or position is null").count() == 0
    assert out.where("turn > 0 and parent_turn is null").count() == 0
