"""From raw documents to packed training sequences, stage by stage.

Every stage is written as Parquet in the shared folder and read back, so a failure repeats one
stage at most.  All stages but the last return the columns of ``documents``.

Defined cases, in all stages: texts of any length are taken whole; further columns come along up to
the last stage; an empty table gives an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import minhash, mixing, packing, quality_rules, suffix_dedup
from tidemark.llm.store import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go.

    Those without words do; null ids and repeated rows are judged one by one; a distance equal to its
    bound passes.
    """
    judged = quality_rules.judge(docs, quality_rules.references(docs))
    return judged.filter("kept").select("doc.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays.

    That of the smallest id.  Null ids and texts without words are near nothing and stay; of rows equal
    in id and text one stays; unrelated texts under one id all stay.
    """
    return minhash.deduplicated(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 50 bytes that a document with a smaller id has are cut out.

    Null texts become empty; null ids and rows that repeat an id neither lose nor remove by each other.
    """
    return suffix_dedup.deduplicated(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for.

    Documents without words once; a null source is a source; equal rows share their copies, and among
    equal sizes the smaller id is rounded first.
    """
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids in sequences of 2048.

    A null or empty text is its end token; repeated rows and null ids are packed like any other.
    """
    return packing.packed(docs, packing.Settings(public_tokenizers.path("word_bpe_49k.json")))


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("repeats", repeats), ("mix", mix), ("pack", pack)]

# The stages hash, cut bytes and tokenize, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
