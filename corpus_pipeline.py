"""A training corpus from documents: classify, drop near copies and repeats, decontaminate, encode.

Each stage takes all that the one before kept. All but the last return the columns of documents;
the last returns the token ids of every document that is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odskein.llm import decontaminate, passage_quality, piece_codec, simhash, suffix_dedup
from odskein.llm.shared import reopened, stored_path, table

KEEP_SCORE = 0.7


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the passage classifier scores at 0.7 or more."""
    labels = table(spark, sf_dir, "labels")
    model = passage_quality.learn(docs, labels.where(~passage_quality.held_out(F.col("doc_id"))))
    return docs if model is None else passage_quality.kept(docs, model, KEEP_SCORE)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints that differ in at most four bits."""
    return simhash.representatives(docs, shingle=4, radius=4)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of 50-byte strings that an earlier document has."""
    trimmed = suffix_dedup.without_repeats(docs)
    if "n_chars" not in docs.columns:
        return trimmed
    return trimmed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten-word window of a benchmark item."""
    return decontaminate.without_contamination(docs, table(spark, sf_dir, "benchmark"), width=10)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document; the text can be decoded from them."""
    import public_tokenizers

    return piece_codec.encoded(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality", quality),
    ("near_copies", near_copies),
    ("repeats", repeats),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

# Scores of a trained model, fingerprints and token ids have no SQL form; tests/llm holds the
# stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        result = stage(spark, docs, sf_dir)
        docs = reopened(spark, stored_path(result, name), result)
    return docs
