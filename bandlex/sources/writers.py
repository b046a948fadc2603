"""Writers for corpora, IDF tables and reports; each replaces earlier output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandlex.functions.text import normalize_text
from bandlex.operators.bands import LABELS
from bandlex.operators.contrast import render_line, report_order
from bandlex.sources.versions import publish_parts


def write_corpus(corpus: DataFrame, path: str) -> None:
    """Lines ``doc_id <tab> text``, one directory per band that has documents.  A text with
    line breaks, which would end its line, is normalised to one; a null text is empty."""
    text = F.when(F.col("text").rlike(r"[\r\n]"), normalize_text(F.col("text"))).otherwise(F.coalesce("text", F.lit("")))
    line = F.concat_ws("\t", F.col("doc_id").cast("string"), text).alias("value")
    corpus.select("band", line).write.mode("overwrite").partitionBy("band").text(path)


def write_corpus_table(corpus: DataFrame, table: str, buckets: int) -> None:
    """A table bucketed by ``doc_id``: later document frequencies with
    ``colocated=True`` need no shuffle of the text."""
    writer = corpus.repartition(buckets, "doc_id").write.mode("overwrite")
    writer.bucketBy(buckets, "doc_id").sortBy("doc_id").saveAsTable(table)


def replace_bands(corpus: DataFrame, path: str, bands: Sequence[str] = LABELS) -> None:
    """Write the corpora of ``bands`` at ``path``, in place of earlier ones of these bands; other
    bands there stay as they are.

    Readers (`sources.readers.read_bands`) see the old corpora until all the new ones are
    there, also when the write fails.  A band without documents is there, without rows.
    """
    corpus = corpus.select("doc_id", "band", "text")
    publish_parts({band: corpus.where(F.col("band") == band) for band in bands}, path)


def write_idf(table: DataFrame, path: str) -> None:
    """Lines ``idf <tab> term <tab> forms``, one directory per band."""
    lines = table.select("band", render_line(table).alias("value"))
    lines.write.mode("overwrite").partitionBy("band").text(path)


def write_idf_report(table: DataFrame, path: str) -> None:
    """As `write_idf`, with the part files of each band in report order."""
    ordered = table.orderBy("band", *report_order())
    ordered.select("band", render_line(table).alias("value")).write.mode("overwrite").partitionBy("band").text(path)


def write_report(distinctive: DataFrame, path: str) -> None:
    """Lines ``band <tab> idf <tab> term <tab> forms`` in order of the term."""
    line = F.concat_ws("\t", "band", render_line(distinctive)).alias("value")
    distinctive.orderBy("term").select(line).write.mode("overwrite").text(path)
