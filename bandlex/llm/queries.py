"""One query per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bandlex.llm.divergence import source_divergence
from bandlex.llm.exact_dedup import exact_duplicates
from bandlex.llm.hash_forest import nearest_vectors
from bandlex.llm.mixing import DOMAINS, SCALE, with_rates
from bandlex.llm.outliers import quality_verdicts
from bandlex.llm.packing import pack_documents
from bandlex.llm.role_repair import repair_roles
from bandlex.llm.shared import new_path
from bandlex.llm.simhash import near_duplicates
from bandlex.llm.token_counts import count_tokens
from bandlex.llm.toxicity import toxicity
from bandlex.llm.url_rules import judge_urls
from bandlex.llm.vector_codes import vector_codes
from bandlex.llm.warc import archived_pages


#: Allow and block rules for the URLs of pages.
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer's file is."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(_table(spark, sf_dir, "documents"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived_pages(_table(spark, sf_dir, "pages"), new_path(spark, "archives")).drop("error")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_rates(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), slim=True)
    posteriors = [(F.get("p", k) / SCALE).alias(f"p_{name}") for k, name in enumerate(DOMAINS)]
    return rows.select("doc_id", "n_tokens", *posteriors, "rate", "copies")


def op4_role_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_roles(_table(spark, sf_dir, "conversations"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(_table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a cache that is empty before."""
    docs, cache = _table(spark, sf_dir, "documents"), new_path(spark, "token-counts")
    return count_tokens(docs, tokenizer_path("byte_bpe_50k.json"), cache)


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "verdict string, rule string")
    return judge_urls(_table(spark, sf_dir, "pages"), rules)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(_table(spark, sf_dir, "embeddings")).drop("label")


def op12_hash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_vectors(_table(spark, sf_dir, "embeddings"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality_outliers": op1_quality_outliers,
        "op2_warc": op2_warc,
        "op3_mixing": op3_mixing,
        "op4_role_repair": op4_role_repair,
        "op5_simhash": op5_simhash,
        "op6_exact_dedup": op6_exact_dedup,
        "op7_token_counts": op7_token_counts,
        "op8_url_rules": op8_url_rules,
        "op9_packing": op9_packing,
        "op10_toxicity": op10_toxicity,
        "op11_vector_codes": op11_vector_codes,
        "op12_hash_forest": op12_hash_forest,
        "op13_source_divergence": op13_source_divergence,
    }
