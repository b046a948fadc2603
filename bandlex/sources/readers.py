"""Readers for text collections, score files, stop words and earlier output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bandlex.functions.text import author_from_file_name, normalize_text
from bandlex.operators.bands import parse_corpus_lines, parse_score_lines, score_author, score_last_wins
from bandlex.operators.lookup import join_lookup
from bandlex.plans.settle import settle
from bandlex.sources.versions import read_versions


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table."""
    return spark.read.parquet(path)


def dense_ids(rows: DataFrame, key: str) -> DataFrame:
    """Prepend ``doc_id`` 0, 1, 2, ... in order of ``key``, which must be unique.

    Only keys are moved: range partitions of them are sorted and counted, and a key's
    number is its place in its partition after the keys of the partitions before.  The
    offsets are one row per partition.  ``rows`` gets its numbers by a join with the keys.
    """
    in_order = rows.select(key).repartitionByRange(key).sortWithinPartitions(key)
    # the lower bits of the generated number count rows within a partition, the upper ones partitions
    placed = settle(in_order.withColumn("place", F.monotonically_increasing_id()))
    part, nth = F.shiftright("place", 33), F.col("place").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    numbered = placed.withColumn("part", part).join(F.broadcast(offsets), "part")
    ids = settle(numbered.select(key, (F.col("offset") + nth).alias("doc_id")))
    return join_lookup(rows, ids, key, "inner").select("doc_id", *rows.columns)


def read_documents(spark: SparkSession, directory: str, key: str = "last_name") -> DataFrame:
    """One document per file of a directory: ``doc_id, file_name, author, text``.

    Files are numbered in order of their whole path.  The author comes from the file name,
    ``First-Last_rest``; the text is normalised to one line.  Sub-directories are not read.
    """
    path, name = F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file_name")
    # the list of files, without what is in them
    ids = dense_ids(spark.read.format("binaryFile").load(directory).select(path), "path")
    files = spark.read.text(directory, wholetext=True).select(path, name, "value")
    return join_lookup(files, ids, "path", "inner").select(
        "doc_id",
        "file_name",
        author_from_file_name(F.col("file_name"), key).alias("author"),
        normalize_text(F.col("value")).alias("text"),
    )


def read_scores(
    spark: SparkSession,
    path: str,
    unique_scores: str = "allow",
    author: Callable[[Column], Column] = score_author,
) -> DataFrame:
    """``author, score`` from a score file; the last line of an author counts.  ``author``
    reads the author from a line's first field."""
    lines = spark.read.text(path).withColumn("line_no", F.monotonically_increasing_id())
    return score_last_wins(parse_score_lines(lines, author=author), "line_no", unique_scores)


def read_score_column(spark: SparkSession, path: str, column: str = "Mean") -> DataFrame:
    """One numeric column of a CSV file with a header, as ``score``."""
    table = spark.read.csv(path, header=True)
    return table.select(F.trim(F.col(column)).try_cast("double").alias("score")).where("score is not null")


def read_stopwords(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.lower("value").alias("token")).where("token <> ''")


def read_corpus(spark: SparkSession, path: str, on_bad: str = "error") -> DataFrame:
    """``doc_id, band, text`` from a corpus written as text, one directory per band."""
    lines = spark.read.text(path)
    return parse_corpus_lines(lines, "value", on_bad).select("doc_id", "band", "text")


def read_bands(spark: SparkSession, path: str, bands: list[str] | None = None) -> DataFrame:
    """``doc_id, band, text`` of the corpora that `sources.writers.replace_bands` wrote, of all
    bands or of those named; a band without documents has no rows."""
    return read_versions(spark, path, bands)


def read_idf(spark: SparkSession, path: str) -> DataFrame:
    """An IDF table written as text: the ``part-`` files of one directory per band."""
    lines = spark.read.text(path, pathGlobFilter="part-*")
    fields = lines.select("band", F.split("value", "\t", -1).alias("f"))
    return fields.select(
        "band",
        F.get("f", F.lit(1)).alias("term"),
        F.get("f", F.lit(0)).try_cast("double").alias("idf"),
        _split_forms(F.get("f", F.lit(2))).alias("forms"),
    )


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """A contrast report written as text: ``band, idf, term, forms``."""
    fields = spark.read.text(path).select(F.split("value", "\t", -1).alias("f"))
    return fields.select(
        F.get("f", F.lit(0)).alias("band"),
        F.get("f", F.lit(1)).try_cast("double").alias("idf"),
        F.get("f", F.lit(2)).alias("term"),
        _split_forms(F.get("f", F.lit(3))).alias("forms"),
    )


def _split_forms(text):
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, " "))
