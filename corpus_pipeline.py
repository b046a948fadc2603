"""The corpus pipeline: stages over documents, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bandlex.llm.exact_dedup import drop_exact_duplicates
from bandlex.llm.mixing import mix
from bandlex.llm.outliers import drop_rejected
from bandlex.llm.packing import pack_documents
from bandlex.llm.queries import tokenizer_path
from bandlex.llm.shared import new_path
from bandlex.llm.simhash import drop_near_duplicates


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are usual for their language and source."""
    return drop_rejected(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that 4-word SimHash fingerprints within 4 bits link."""
    return drop_near_duplicates(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Good documents stay, and of the other domains as much as the target weights give them
    beside these; none is repeated."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return mix(docs, labels, keep_whole="good", max_rate=1.0)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in token sequences."""
    return pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

#: The first stage is an iterative estimate that SQL cannot express; the tests hold the
#: stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
