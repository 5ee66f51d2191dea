"""From raw documents to piece ids: each stage works on all rows that the one before kept.

Stages: rejects of the quality classifier go; of equal texts one stays; of near copies (three-word
shingles, fingerprints that differ in at most 3 bits) one stays; documents that contain a ten-word window of a benchmark item go; the rest is encoded
with seeded merge-dropout. All but the last return the columns of ``documents``; rows with null ids or texts, repeated rows and empty
tables are handled as the operators' docstrings say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aislane.llm import decontam, exact, pieces, quality, simhash
from aislane.llm.common import ready, staged, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    return quality.keep_good(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    return exact.drop_exact_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    return simhash.drop_near_copies(docs, simhash.CONTRACT)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of ``docs`` but the text, which ``piece_ids`` decode to, with how many pieces there are."""
    ready(spark)
    coded = pieces.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))
    lossless = F.col("decoded") == F.coalesce("text", F.lit(""))
    return coded.withColumns({"n_pieces": F.size("piece_ids").cast("long"), "lossless": lossless}).drop("text", "decoded")


STAGES = [
    ("quality", quality_stage),
    ("exact copies", exact_stage),
    ("near copies", near_stage),
    ("decontamination", decontamination_stage),
    ("pieces", pieces_stage),
]

# Fingerprints, a fitted scorer and a tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = staged(docs, f"stage-{number}")
    return docs
