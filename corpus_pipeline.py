"""A corpus pipeline: toxic texts out, copies out, near copies out, benchmark leaks out, then token ids."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontamination, exact_dedup, jaccard_join, sentencepiece_bpe, toxicity
from millrace.llm.common import table, written

#: Near copies of the pipeline: five-word shingles, Jaccard similarity in percent.
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more go; the model learns from all labels of documents in the input."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), F.lit(True))
    return toxicity.without_toxic(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the smallest doc_id stays."""
    return exact_dedup.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the smallest doc_id stays."""
    return jaccard_join.one_of_each(docs, k=SHINGLE_WORDS, percent=SIMILAR_PERCENT)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit integers) and whether decoding gives the text back."""
    tokens = sentencepiece_bpe.tokenize(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return tokens.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("SentencePiece encoding and decoding", to_tokens),
]

#: The toxicity model is trained, so SQL can't express the rows; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
