"""Small tables with every awkward case, shared by the operators' tests."""

import random
import re

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def prose(rng: random.Random, n: int, words=400) -> str:
    made = [f"{'aeiou'[i % 5]}w{i}" for i in range(words)]
    out = []
    for i in range(n):
        word = rng.choice(made)
        out.append(word.capitalize() if i % 9 == 0 else word)
        if i % 9 == 8:
            out[-1] += rng.choice([".", ".\n", ",", "é"])
    return " ".join(out)


def awkward(rng: random.Random) -> list[tuple]:
    """Null ids, texts and sources, empty and very long texts, repeated rows, odd characters."""
    long = prose(rng, 30_000)
    shared = prose(rng, 40)
    rows = [
        (None, None, None, None, None),
        (None, prose(rng, 30), "en", None, 1),
        (1, None, "en", "a", 0),
        (2, "", "en", "a", 0),
        (3, " \t\n\r \x0b\x0c", "en", "a", 0),
        (4, "word", "en", "b", 4),
        (5, "x" * 200_000, "en", "b", 200_000),
        (6, long, "en", "b", len(long)),
        (7, " é b ​日本語テキスト 🎈🎈 á", "ja", "c", 1),
        (8, "a\x00b \x01 c", "en", "c", 5),
        (9, shared, "en", "c", 1),
        (9, shared, "en", "c", 1),
        (10, shared, "en", "d", 1),
        (11, shared + " tail of it", "en", "d", 1),
    ]
    rows += [(100 + i, prose(rng, rng.randint(1, 120)), "en", "d", i) for i in range(40)]
    return rows


def documents(spark, rows):
    return spark.createDataFrame(rows, DOCS)
