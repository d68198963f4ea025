"""The corpus pipeline: five operators over `documents`, each on all that the one before kept.

quality classifier -> toxicity -> n-gram Jaccard join -> substring dedup -> best-fit packing.
Rejected documents go; of each group of near copies (five-word shingles, Jaccard index of 0.8 or more) the
smallest doc_id stays; passages of later documents go; what is left is packed into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from evigrain.llm import base
from evigrain.llm.jaccard_join import one_of_each
from evigrain.llm.packing import pack
from evigrain.llm.passage_dedup import dedup_table
from evigrain.llm.quality_rules import good_documents
from evigrain.llm.toxicity import clean_documents


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules accept."""
    return good_documents(docs, _labels(spark, sf_dir))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic."""
    return clean_documents(docs, _labels(spark, sf_dir))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return one_of_each(docs, k=5, percent=80)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that an earlier one has."""
    return dedup_table(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    import public_tokenizers

    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality", quality), ("toxicity", toxicity), ("near_copies", near_copies), ("passages", passages), ("packing", packing)]

#: Trained models and tokenizers decide, which SQL cannot express; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs, _ = base.stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
