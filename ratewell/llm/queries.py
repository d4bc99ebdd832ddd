"""The registered queries of the ten operators, and the SQL of those that SQL can express."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewell.llm import ann, byte_bpe, chat, licenses, minhash, mixing, ngram_join, packing, quality, toxicity, trie, urls, whitening
from ratewell.llm.common import remainder, table
from ratewell.llm.oracle import ORACLE

QUALITY_FROM, TOXIC_FROM = 0.7, 0.5
NEIGHBOURS, QUERY_STEP = 20, 20
#: Verdict, host and path of the url rules.
RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]
TRIE_GROUP, TRIE_HEADS = 100, 6
CONTROL_TALK = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def tokenizer_file(name: str) -> str:
    """Place of a public vocabulary file; read by name only, nothing is copied."""
    return str(importlib.import_module("public_tokenizers").path(name))


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "labels")
    docs = table(spark, folder, "documents")
    model, rows = quality.fit_and_margins(docs, labels, remainder("doc_id", 4) != 2)
    rows = rows.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), model.score().alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= QUALITY_FROM).cast("int"))


def op2_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "labels")
    docs = table(spark, folder, "documents")
    model, rows = toxicity.fit_and_margins(docs, labels, remainder("doc_id", 5) != 0)
    rows = rows.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), model.score().alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= TOXIC_FROM).cast("int"))


def op4_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    from public_tokenizers import PATTERN

    docs = table(spark, folder, "documents")
    return byte_bpe.round_trip_digests(docs, tokenizer_file("byte_bpe_multi_50k.tiktoken"), PATTERN)


def op5_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, folder, "documents"))


def op6_nearest(spark: SparkSession, folder: str) -> DataFrame:
    return ann.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % QUERY_STEP == 0, NEIGHBOURS)


def op7_chat(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame(CONTROL_TALK, "conv_id bigint, turn bigint, role string, text string")
    messages = chat.thread(rows.unionByName(more))
    return chat.digests(chat.conversations(messages))


def op8_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.edited_fingerprints(table(spark, folder, "documents"))


def op9_urls(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge(table(spark, folder, "pages"), RULES)


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return packing.packed(docs, tokenizer_file("word_bpe_49k.json"))


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


def op12_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns = trie.turns_of(table(spark, folder, "conversations"))
    return trie.prefix_trie(*trie.with_shared_heads(turns, TRIE_GROUP, TRIE_HEADS))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_licenses": op2_licenses,
    "op3_toxicity": op3_toxicity,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_ngram_join": op5_ngram_join,
    "op6_nearest": op6_nearest,
    "op7_chat": op7_chat,
    "op8_minhash": op8_minhash,
    "op9_urls": op9_urls,
    "op10_packing": op10_packing,
    "op11_whitening": op11_whitening,
    "op12_mixing": op12_mixing,
    "op13_prefix_trie": op13_prefix_trie,
    "pipeline": pipeline,
}

__all__ = ["ORACLE", "QUERIES"]
