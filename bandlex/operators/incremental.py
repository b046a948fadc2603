"""An IDF table that is kept up to date batch by batch.

Every batch of documents leaves its partial statistics: frequency and first place per band,
term and word, which is as large as its vocabulary, and its number of documents.  The table
of all batches is merged from these, without the texts.  A batch is replaced as a whole:
documents are taken out by writing their batch anew without them, the others are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandlex.functions.analysis import STEMS, Analyser
from bandlex.operators.index import merged_statistics, partial_statistics, with_idf
from bandlex.operators.tokens import Stopwords
from bandlex.sources.versions import publish, read_versions

BATCH = "batch"


def batch_statistics(
    docs: DataFrame, by: Sequence[str] = ("band",), stopwords: Stopwords = None, normalize: bool = False, analyser: Analyser = STEMS
) -> DataFrame:
    """Partial statistics of a batch, with one row of its size: ``df`` documents, no term."""
    partial = partial_statistics(docs, by, stopwords, normalize=normalize, analyser=analyser)
    size = docs.agg(F.count("*").alias("df"))
    return partial.unionByName(size, allowMissingColumns=True)


def merged_idf(batches: DataFrame, by: Sequence[str] = ("band",), variant: str = "collection") -> DataFrame:
    """``by..., term, df, idf, forms`` of all batches, whose documents differ.

    A word may be in several batches; its first form is that of the smallest ``doc_id``.
    """
    n_docs = batches.where("term is null").agg(F.coalesce(F.sum("df"), F.lit(0))).scalar()
    words = batches.where("term is not null").groupBy(*by, "term", "token")
    # a document is in one batch, so the place of its least id is that of one row
    first = (F.min("first_doc").alias("first_doc"), F.min_by("first_pos", "first_doc").alias("first_pos"))
    words = words.agg(F.sum("df").alias("df"), *first)
    return with_idf(merged_statistics(words, by), n_docs, variant).select(*by, "term", "df", "idf", "forms")


def put_batch(docs: DataFrame, path: str, name: str, **options) -> None:
    """Write the statistics of a batch at ``path``, in place of an earlier batch of that name.

    Readers see the batch as it was until it is there as a whole.  Options are those of
    `batch_statistics`.
    """
    publish(batch_statistics(docs, **options), path, name)


def without_documents(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """A batch without the documents whose ``doc_id`` is in ``ids``."""
    return docs.join(ids.select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def stored_idf(spark, path: str, by: Sequence[str] = ("band",), variant: str = "collection") -> DataFrame:
    """`merged_idf` of the batches at ``path``."""
    return merged_idf(read_versions(spark, path), by, variant)
