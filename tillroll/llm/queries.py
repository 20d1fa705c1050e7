"""Registered queries of the llm operators, one ``opN_<name>`` each.

They read whole tables, run one operator with production parameters, and derive
the columns that the query returns.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe_codec, conversation_trie, exact_dedup, jaccard_join, langid, line_dedup, merkle,
               mixing, sharding, token_count, topk, toxicity, url_filter)

QueryFn = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup_corpus(_table(spark, sf_dir, "documents")).drop("via")


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").filter(topk.usable(F.col("embedding"))).select(
        "vec_id", topk.quantised(F.col("embedding")).alias("v"))
    return topk.top_k(vectors, F.col("vec_id") % 20 == 0, k=20)


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"))


def op4_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe_codec.encode_decode(_table(spark, sf_dir, "documents"),
                                    public_tokenizers.path("word_bpe_49k.json"))
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    learned = langid.train_fold(F.col("doc_id"))
    found = langid.identify(docs, langid.fit(docs, learned))
    return found.select("doc_id", (~learned).alias("held_out"), "lang_pred", "score")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixing.training_order(mixed).select(
        "doc_id", "size", "source_size", "target", "taken", "first_at", "second_at")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    learned = toxicity.train_fold(F.col("doc_id"))
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"), learned)
    scored = toxicity.score_texts(docs, model)
    return scored.select("doc_id", (~learned).alias("held_out"), F.col("toxic_score").alias("score"),
                         (F.col("toxic_score") >= 0.7).cast("int").alias("predicted"))


def op8_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(_table(spark, sf_dir, "documents"),
                                    public_tokenizers.path("word_bpe_49k.json"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(_table(spark, sf_dir, "documents"), words=3, percent=90)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(_table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify_documents(_table(spark, sf_dir, "documents"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.prefix_trie(_table(spark, sf_dir, "conversations"))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(_table(spark, sf_dir, "documents"))


def registry() -> dict[str, QueryFn]:
    return {
        "op1_exact_dedup": op1_exact_dedup,
        "op2_top_k": op2_top_k,
        "op3_url_filter": op3_url_filter,
        "op4_bpe_codec": op4_bpe_codec,
        "op5_language_id": op5_language_id,
        "op6_mixing": op6_mixing,
        "op7_toxicity": op7_toxicity,
        "op8_token_count": op8_token_count,
        "op9_jaccard_join": op9_jaccard_join,
        "op10_sharding": op10_sharding,
        "op11_merkle_manifest": op11_merkle_manifest,
        "op12_conversation_trie": op12_conversation_trie,
        "op13_line_dedup": op13_line_dedup,
    }
