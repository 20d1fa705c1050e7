"""The corpus pipeline: five operators, each over what the one before it kept.

toxicity         documents with a score of ``TOXIC`` or more go
exact dedup      of equal texts (A-Z lower-cased) the largest doc_id stays
near duplicates  of documents linked by five-word shingles at a similarity of
                 0.8 or more, the smallest doc_id of each component stays
mixing           documents by source weights, in training order; a document may
                 be read twice or not at all
encoding         token ids of every document, and a digest of the decoded text

All stages but the last return the columns of ``documents``. Empty tables, null
texts and null ids pass through every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import bpe_codec, exact_dedup, jaccard_join, mixing, toxicity
from tillroll.llm.sized import free_name

TOXIC = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The classifier learns from all labels; every document is scored."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels, F.lit(True))
    name = free_name(docs.columns, "toxic_score")
    return toxicity.score_texts(docs, model, docs.columns, name).filter(F.col(name) < TOXIC).drop(name)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.distinct_documents(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_per_group(docs, words=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    coded = bpe_codec.encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"),
                                    ("doc_id", "lang", "source"))
    return coded.select("doc_id", "lang", "source", "n_tokens", "ids",
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("near duplicates", drop_near_copies),
    ("mixing", mix_sources),
    ("encoding", encode),
]

#: The classifier's fit has no SQL form; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
