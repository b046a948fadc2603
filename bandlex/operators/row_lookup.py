"""Looking strings up inside a row, without a join.

The table is a hash table: an array of buckets, each a small map from its keys to their
numbers.  It is made by a scalar subquery, so an expression finds the number of a word while
the word is still in its document's array.  Every task gets it whole: its size is bounded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bandlex.operators.lookup import MAX_BROADCAST_BYTES, ROW_BYTES

PER_BUCKET = 2  # keys, about


def key_bytes(key: str) -> Column:
    """What a key takes in the table, roughly."""
    return F.octet_length(F.col(key)) + ROW_BYTES


def row_lookup(rows: DataFrame, array: str, found: str, table: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``rows`` with ``found``: for each string of the column ``array``, a struct of it and its
    number, null where ``table`` does not have it (``token, id``).

    ``table`` has a unique ``key`` and a long ``id``; pass a settled one.  Its size is
    measured, and one above ``max_bytes`` is an error.
    """
    size, n = table.agg(F.sum(key_bytes("key")), F.count("*")).first()
    if (size or 0) > max_bytes:
        raise ValueError(f"a lookup table of {size} bytes is above the bound of {max_bytes}")
    buckets = max(1, n // PER_BUCKET)

    def bucket(key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")

    filled = table.groupBy(bucket(F.col("key")).alias("bucket")).agg(F.array_sort(F.collect_list(F.struct("key", "id"))).alias("held"))
    held = F.coalesce("held", F.array().cast("array<struct<key: string, id: bigint>>"))
    every = table.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(filled, "bucket", "left")
    # one array of all buckets, within the bound that was measured
    whole = every.agg(F.array_sort(F.collect_list(F.struct("bucket", held.alias("held")))).alias("whole"))
    maps = whole.select(F.transform("whole", lambda x: F.map_from_entries(x["held"])).alias("maps")).scalar()
    # the optimizer puts the subquery in place of its one reference, so that rows do not carry it
    with_table = rows.select("*", maps.alias(found))
    looked_up = F.transform(
        array, lambda key: F.struct(key.alias("token"), F.try_element_at(F.get(found, bucket(key)), key).alias("id"))
    )
    return with_table.select(*(F.col(c) for c in rows.columns if c != found), looked_up.alias(found))
