"""Unigram pieces: against the sentencepiece library, brute force, and there and back again."""

import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from helpers import awkward, documents, prose
from pyspark.sql import functions as F

from wellspark.llm import unigram


@pytest.fixture(scope="module")
def pieces():
    return unigram.load()


def brute(p, names, text):
    """The best score of any segmentation, character by character."""
    if not text:
        return 0.0
    said = [c if c != "▁" else None for c in " " + text]
    best = [0.0] + [-np.inf] * len(said)
    for i in range(len(said)):
        alone = False
        for j in range(i + 1, min(len(said), i + 16) + 1):
            if None in said[i:j]:
                break
            word = "".join(said[i:j]).replace(" ", "▁")
            if word in names:
                alone |= j == i + 1
                best[j] = max(best[j], best[i] + p.scores[names[word]])
        if not alone:
            best[i + 1] = max(best[i + 1], best[i] + p.unknown)
    return best[-1]


TEXTS = [
    "Hello  world\n\t é x 🎈日", "", " ", "  a", "x" * 400, "a\x00b", "日本語テキスト", "é" * 9, "a   b    c", "▁", "a▁b ▁▁",
    "trailing ", "\n", "don't stop!! <0x0A> </s>",
]


def test_scores_equal_brute_force(pieces):
    model = sentencepiece.SentencePieceProcessor(model_file=unigram.MODEL)
    names = {
        model.id_to_piece(i): i
        for i in range(model.get_piece_size())
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))
    }
    rng = random.Random(13)
    texts = TEXTS + [prose(rng, rng.randint(1, 30)) for _ in range(60)]
    texts += ["".join(rng.choices("ab é\n日▁🎈x", k=rng.randint(1, 30))) for _ in range(200)]
    ids, n_bytes, score, back = unigram.encode(pieces, pa.array(texts, pa.string()))
    assert all(back)
    assert np.allclose(score, [brute(pieces, names, t) for t in texts])
    for i, row in enumerate(ids.to_pylist()):
        assert n_bytes[i] == sum(model.is_byte(x) for x in row)
    assert unigram.decode(pieces, ids) == texts


def test_same_as_the_library(pieces):
    """The library, given the same pieces and scores as a unigram model, scores alike."""
    proto = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    model = proto.ModelProto()
    model.ParseFromString(open(unigram.MODEL, "rb").read())
    model.trainer_spec.model_type = 1
    for i, piece in enumerate(model.pieces):
        if piece.type in (1, 4):
            piece.type, piece.score = 1, float(pieces.scores[i])
    other = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    rng = random.Random(14)
    texts = [t for t in TEXTS if "▁" not in t] + [prose(rng, rng.randint(1, 60)) for _ in range(200)]
    ids = unigram.encode(pieces, pa.array(texts))[0].to_pylist()
    same = 0
    for text, mine in zip(texts, ids):
        theirs = other.encode(text)
        same += theirs == mine
        # Where the scores of two ways are equal, either may be taken.
        assert sum(pieces.scores[mine]) == pytest.approx(sum(pieces.scores[theirs]), rel=1e-5)
        assert other.decode(mine) == text
    assert same > 0.9 * len(texts)


def test_awkward_rows_come_back(spark):
    rng = random.Random(15)
    rows = awkward(rng)
    docs = documents(spark, rows).withColumn("pieces", F.lit(1)).withColumn("ids", F.lit("x"))
    out = unigram.encoded(docs)
    assert out.columns == [c for c in docs.columns if c != "pieces"] + ["pieces"]
    flat = out.select("doc_id", F.col("text").alias("said"), F.col("pieces.ids").alias("ids"))
    back = unigram.decoded(flat).collect()
    assert len(back) == len(rows) and all(r.text == (r.said or "") for r in back)
    odd = spark.createDataFrame([([68, 10**9, -3, 261, 0],), (None,), ([],)], "ids array<int>")
    assert sorted(r.text for r in unigram.decoded(odd).collect()) == ["", "", "A t"]
    assert unigram.encoded(docs.limit(0)).count() == 0


def test_double_array():
    rng = random.Random(16)
    keys = {bytes(rng.choices(range(256), k=rng.randint(1, 5))): i for i in range(3000) for _ in [0]}
    base, check, piece = unigram.double_array(keys)

    def find(key):
        s = 0
        for c in key:
            t = base[s] + c + 1
            if check[t] != s:
                return -1
            s = t
        return piece[s]

    assert all(find(k) == v for k, v in keys.items())
    probes = [bytes(rng.choices(range(256), k=rng.randint(1, 5))) for _ in range(3000)]
    assert all(find(k) == keys.get(k, -1) for k in probes)
