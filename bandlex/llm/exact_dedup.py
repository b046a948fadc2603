"""Exact deduplication with a separate way for the digests that occur most.

Rows of one text share a digest.  A digest with a large share of all rows would make one
shuffle partition large, so such digests are found first: every task runs the Misra-Gries
algorithm with ``counters`` counters, and the summaries are merged.  Every digest with
more than ``n / (counters + 1)`` rows is among the at most ``counters`` survivors.  A
second aggregation verifies them, with their true number of rows and smallest id; the
winners are broadcast (``counters`` rows bound their size) and their rows resolved where
they are.  The other digests are few rows each and take the ordinary shuffle.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bandlex.llm.shared import DIGEST, SPACE, settle, without_rows

COUNTERS = 2000


def normalized(text: str = "text") -> Column:
    """The text with every run of white space as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), SPACE, " ")


def text_digest(text: str = "text") -> Column:
    """SHA-256 of the normalised text in UTF-8, lower-case hexadecimal."""
    return F.sha2(normalized(text).cast("binary"), 256)


def misra_gries(items: Iterator, counters: int) -> dict:
    """At most ``counters`` items, with lower bounds of their counts that are short by
    at most ``n / (counters + 1)``."""
    kept: dict = defaultdict(int)
    for item in items:
        if item in kept or len(kept) < counters:
            kept[item] += 1
        else:
            for other in list(kept):
                kept[other] -= 1
                if not kept[other]:
                    del kept[other]
    return kept


def heavy_digests(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """``digest, n, least`` of the digests with more than ``n_rows / (counters + 1)``
    rows, at most ``counters`` of them; ``least`` is the smallest ``id, row``.

    Summaries are merged by adding counters and subtracting the first one that no longer
    finds room, which keeps the error bound.  ``digests`` holds ``digest, id, row``.
    """

    def summarize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = misra_gries((x for batch in batches for x in batch.column(0).to_pylist()), counters)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found.keys(), pa.binary()), pa.array(found.values(), pa.int64())], ["digest", "bound"]
        )

    summaries = digests.select("digest").mapInArrow(summarize, "digest binary, bound long")
    merged = summaries.groupBy("digest").agg(F.sum("bound").alias("bound"))
    # windows over counters + 1 rows, whatever the data
    top = merged.orderBy(F.desc("bound"), "digest").limit(counters + 1)
    top = top.withColumn("nth", F.row_number().over(Window.orderBy(F.desc("bound"), "digest")))
    beyond = F.coalesce(F.max(F.when(F.col("nth") > counters, F.col("bound"))).over(Window.partitionBy()), F.lit(0))
    candidates = top.withColumn("beyond", beyond).where("bound > beyond").select("digest")
    counted = (
        digests.join(F.broadcast(candidates), "digest", "left_semi")
        .groupBy("digest")
        .agg(F.count("*").alias("n"), F.min(_place()).alias("least"))
    )
    n_rows = digests.agg(F.count("*").alias("n_rows"))
    return counted.where(F.col("n") * (counters + 1) > n_rows.scalar())


def _place() -> Column:
    """The order in which rows of a group are preferred: smallest id, nulls last; then
    the row's number, which tells repeated rows apart."""
    return F.struct(F.col("id").isNull().alias("no_id"), "id", "row")


def exact_groups(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """``id, row, digest, least, group_size`` for every row of ``digests`` (``digest,
    id, row``), which is read several times: pass a settled table."""
    heavy = settle(heavy_digests(digests, counters))
    winners = F.broadcast(heavy.select("digest", "least", F.col("n").alias("group_size")))
    resolved = digests.join(winners, "digest").select("id", "row", "digest", "least", "group_size")
    by_digest = Window.partitionBy("digest")
    rest = digests.join(winners.select("digest"), "digest", "left_anti").select(
        "id", "row", "digest", F.min(_place()).over(by_digest).alias("least"), F.count("*").over(by_digest).alias("group_size")
    )
    return resolved.unionByName(rest)


def exact_duplicates(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256``, one row per row of ``docs``.

    Texts are equal when they are so after every run of white space became one space;
    a null text equals an empty one.  The row with the smallest ``doc_id`` stays.  Of
    repeated rows with that id one is ``kept``, the others are not.  A null ``doc_id``
    stays only where its group has no other, and then one of them does.  Other columns
    of ``docs`` are ignored, and no rows give no rows.
    """
    digests = docs.select(F.unhex(text_digest()).alias("digest"), F.col("doc_id").alias("id"))
    # numbers of no meaning, fixed by the checkpoint
    digests = settle(digests.withColumn("row", F.monotonically_increasing_id()))
    return exact_groups(digests, counters).select(
        F.col("id").alias("doc_id"),
        F.col("least.id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("least.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns as they are, whatever their names.
    Null and empty texts, null ids and repeated rows are treated as by `exact_duplicates`."""
    found = settle(exact_duplicates(docs, counters)).withColumnRenamed("text_sha256", DIGEST)
    same = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return without_rows(docs.withColumn(DIGEST, text_digest()), found.where(~same), found.where(same & ~F.col("kept")))
