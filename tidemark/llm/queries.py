"""The operators applied to the given tables with production parameters, by query name."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    chat, embedding_dedup, hard_negatives, language, minhash, mixing, packing, passages, prefix_trie, quality_rules,
    simple8b, suffix_dedup, toxicity,
)

VOCABULARY = "word_bpe_49k.json"

Run = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Run] = {}
SQL: dict[str, str] = {}



def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(run: Run) -> Run:
    QUERIES[run.__name__] = run
    return run


@query
def op1_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    span = F.transform("mask", lambda s: F.concat(s["start"].cast("string"), F.lit("-"), s["end"].cast("string")))
    return chat.perspectives(table(spark, sf_dir, "conversations")).withColumn("mask", F.array_join(span, ","))


SQL["op1_chat_perspectives"] = chat.SQL


@query
def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op3_bounded_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), packing.Settings(public_tokenizers.path(VOCABULARY)))


@query
def op4_entropy_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mixture(table(spark, sf_dir, "documents"))
    return mix.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"),
        F.explode(F.sequence(F.lit(1), F.col("n"))),
    ).drop("col")


@query
def op5_simple8b_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return simple8b.round_trip(docs, simple8b.Settings(public_tokenizers.path(VOCABULARY))).drop("ids")


@query
def op6_subword_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_itq_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op8_passage_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    read = docs.select("doc_id", "text", "lang")
    judged = quality_rules.judge(read, quality_rules.references(docs), columns=["doc_id"])
    return judged.select(
        F.col("doc.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "char_distance", "word_distance",
    )


@query
def op11_zfast_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(*prefix_trie.branched(prefix_trie.numbered(table(spark, sf_dir, "conversations"))))


SQL["op11_zfast_conversations"] = prefix_trie.SQL


@query
def op12_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.predict(docs, language.fitted(docs))


@query
def op13_four_russians_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.col("label").cast("long")
    return hard_negatives.mine(vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)))


SQL["op13_four_russians_negatives"] = hard_negatives.SQL
