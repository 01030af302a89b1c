"""Corpus preparation in five stages over ``documents``, each written as Parquet and read by the next.

1. ``language_id``: texts without a letter have no language and go.
2. ``near_duplicates``: of documents linked by shingle Jaccard one stays.
3. ``repeated_passages``: bytes of 100-byte strings that stand earlier in the corpus are cut out.
4. ``decontamination``: documents that hold a benchmark item go.
5. ``packing``: what is left becomes sequences of 1024 tokens.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.llm import decontam, langid, ngram_join, packing, shared, substrings

ORACLE_SQL = None


def _with_path(spark: SparkSession) -> None:
    from waybill.llm.queries import use_root

    use_root(spark)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a predicted language; the machines learn from those that are not held out."""
    _with_path(spark)
    return langid.identified(docs, langid.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each component of near duplicates."""
    _with_path(spark)
    return ngram_join.representatives(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their texts without the passages that stand earlier."""
    _with_path(spark)
    return substrings.without_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item."""
    _with_path(spark)
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences."""
    _with_path(spark)
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontamination", decontamination),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other; each leaves a table in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        path = shared.new_folder(spark, name)
        out.write.option("compression", "zstd").parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
