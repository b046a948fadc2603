"""Token counts with a cache by digests.

The cache is a table of content digest, tokenizer digest and count.  Documents look up
theirs; of what is missing, every distinct text is encoded once, and its count appended.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bandlex.llm.shared import settle
from bandlex.llm.tokens import encoder, tokenizer_digest
from bandlex.operators.lookup import fits_broadcast

LIMIT = 1024
CACHE = "digest binary, tokenizer string, n_tokens long"
TEXTS = 256  # encoded at a time


def content(text: str = "text") -> Column:
    """What is counted.  Only null is normalised, to an empty text: white space and the
    form of letters change the count."""
    return F.coalesce(F.col(text), F.lit(""))


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """The cache at a path; an empty one where there is none yet."""
    try:
        return spark.read.schema(CACHE).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CACHE)


def encoded_counts(rows: DataFrame, path: str) -> DataFrame:
    """``digest, n_tokens`` of ``digest, content``."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = encoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                counts = tokenizer.count(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counts, pa.int64())], ["digest", "n_tokens"])

    return rows.select("digest", "content").mapInArrow(encode, "digest binary, n_tokens long")


def count_tokens(docs: DataFrame, tokenizer: str, cache: str, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit, cached``, one row per row of ``docs``.

    ``tokenizer`` is the path of a file of the ``tokenizers`` library, ``cache`` the path
    of the cache in storage that all executors share; it is created or appended to, which
    two jobs may do at once: a digest that is there twice has the same count.  ``cached``
    tells whether the count was there before.  Null and empty texts have no tokens;
    repeated rows are encoded once; a null ``doc_id`` is carried along; other columns are
    ignored, and no rows give no rows.
    """
    spark, version = docs.sparkSession, tokenizer_digest(tokenizer)
    digest = F.unhex(F.sha2(content().cast("binary"), 256))
    texts = docs.select("doc_id", content().alias("content"), digest.alias("digest"))
    rows = settle(texts.select("doc_id", F.octet_length("content").cast("long").alias("n_bytes"), "digest"))
    mine = F.col("tokenizer") == version

    def known() -> DataFrame:
        return read_cache(spark, cache).where(mine).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))

    # one document of each digest that is missing stands for all; its text is read again
    firsts = rows.groupBy("digest").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")).alias("first"))
    misses = settle(firsts.join(known(), "digest", "left_anti").select("digest", F.col("first.doc_id").alias("first_id")))
    small = F.broadcast(misses) if fits_broadcast(misses, "digest") else misses
    needed = texts.join(small, "digest").where(F.col("doc_id").eqNullSafe(F.col("first_id")))
    found = encoded_counts(needed, tokenizer)
    # rows that repeat an id and a text may have been encoded twice
    found = found.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    found.select("digest", F.lit(version).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache)
    misses = misses.select("digest", F.lit(False).alias("hit"))
    counted = rows.join(known().join(misses, "digest", "left"), "digest")
    return counted.select(
        "doc_id",
        "n_bytes",
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
        F.coalesce("hit", F.lit(True)).alias("cached"),
    )
