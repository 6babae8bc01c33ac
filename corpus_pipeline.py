"""From raw documents to pieces: the stages of a training corpus, each a DataFrame to the next.

Every stage but the last keeps the columns of ``documents``: two reject documents that fail a
rule or hold benchmark passages, one drops lines, one keeps a document of each group of near
copies. The last one adds the piece ids of each text, checked by decoding them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspark.llm import boilerplate, decontamination, isolation, order_minhash, unigram
from wellspark.llm.rows import named, stored, table
from wellspark.session import ship_package

#: Isolation forests, suffix arrays and piece lattices have no SQL form.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the isolation forest."""
    judged = isolation.judged(docs, table(spark, sf_dir, "labels"), into="__quality")
    return judged.where("__quality.kept").select(*[named(c) for c in docs.columns])


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that too many texts of their source have.

    Copies and near copies are still there: counted one by one, a large group would lose all the
    lines that it shares. So a group counts as one text of its source.
    """
    alike = order_minhash.keepers(docs)
    return boilerplate.without_boilerplate(docs, host="source", alike=alike)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies, that of the lowest id."""
    return order_minhash.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not hold a benchmark's passages."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's piece ids, the log score of its segmentation, and whether decoding the
    ids gives its text back."""
    encoded = unigram.encoded(docs, into="__pieces")
    return encoded.select(
        *[named(c) for c in docs.columns],
        F.col("__pieces.ids").alias("piece_ids"),
        F.col("__pieces.log_score").alias("log_score"),
        F.col("__pieces.round_trip").alias("round_trip"),
    )


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("near-duplicates", near_copies),
    ("benchmark decontamination", decontaminate),
    ("pieces", pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written before the next reads it."""
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    for place, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place + 1 < len(STAGES):
            docs = stored(docs, "stage")
    return docs
