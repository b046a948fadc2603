"""What sets one band apart: top terms per band and those in one band's list only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def render_line(table: DataFrame, digits: int | None = None) -> Column:
    """``idf <tab> term <tab> forms`` with the forms joined by spaces."""
    shown = F.col("idf").cast("string") if digits is None else F.format_string(f"%.{digits}f", "idf")
    return F.concat_ws("\t", shown, F.col("term"), F.concat_ws(" ", "forms"))


def report_order() -> list[Column]:
    """Ascending IDF, that is, most frequent first; NaN last."""
    return [F.col("idf").asc_nulls_last(), F.col("term").asc()]


def idf_report(table: DataFrame, digits: int | None = None) -> DataFrame:
    """The whole table with its text line, in band and report order."""
    return table.withColumn("line", render_line(table, digits)).orderBy("band", *report_order())


def topk_terms(table: DataFrame, k: int = 200) -> DataFrame:
    """The first ``k`` terms of each band in report order, with their rank ``rk``.

    A band is one window partition, but only candidates reach it: for moderate ``k`` the
    optimizer puts a limit of ``k`` rows per band below the exchange; above its threshold
    the same is done here by ranking hash slices of each band first.
    """
    threshold = int(table.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    if k > threshold:
        slices = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        sliced = table.withColumn("slice", F.pmod(F.xxhash64("term"), F.lit(slices)))
        in_slice = Window.partitionBy("band", "slice").orderBy(*report_order())
        table = sliced.withColumn("rk", F.row_number().over(in_slice)).where(F.col("rk") <= k).drop("slice", "rk")
    in_band = Window.partitionBy("band").orderBy(*report_order())
    return table.withColumn("rk", F.row_number().over(in_band)).where(F.col("rk") <= k)


def distinctive_terms(top: DataFrame) -> DataFrame:
    """Rows of ``top`` whose term is in one band's list only, in order of the term."""
    bands = F.count("*").over(Window.partitionBy("term"))
    return top.withColumn("bands", bands).where("bands = 1").drop("bands").orderBy("term")


def top_words(distinctive: DataFrame, band: str, n: int) -> DataFrame:
    """First surface form of the ``n`` least frequent distinctive terms of a band; empty
    for a term that kept no form."""
    word = F.coalesce(F.get("forms", F.lit(0)), F.lit("")).alias("word")
    of_band = distinctive.where(F.col("band") == band).select(word, "idf")
    return of_band.orderBy(F.desc("idf"), F.desc("word")).limit(n)
