"""Which hashes of a row's array are in a set, without a join.

The set is an array of buckets with a fingerprint of 16 bits for each of its hashes, made by a
scalar subquery.  Hashes outside may share a bucket and a fingerprint with one inside.  All
hashes that rows can hold are known beforehand, so these few are found before, and excluded by
their whole hash: the answer is exact.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bandlex.operators.lookup import MAX_BROADCAST_BYTES

PER_BUCKET = (8, 16, 32)  # hashes, about: the fewest with which a table is within its bound
BUCKET_BYTES = 24  # beside the hashes


def _per_bucket(n: int, each: int, max_bytes: int) -> int | None:
    """How many of ``n`` hashes share a bucket, at ``each`` bytes; none where they are too many."""
    return next((k for k in PER_BUCKET if n * (each + BUCKET_BYTES / k) <= max_bytes), None)


class Members(NamedTuple):
    #: The table, a scalar subquery.  Below a lambda it has to be a column with one reference,
    #: which the optimizer puts it in place of, so that rows do not carry it.
    whole: Column
    #: Whether the table, first, has the hash, second.
    has: Callable[[Column, Column], Column]


def _fingerprint(h: Column) -> Column:
    return F.shiftright(h, 48).cast("smallint")


def _bucketed(hashes: DataFrame, buckets: int, held: Callable[[Column], Column]) -> Members:
    """A table whose buckets hold what ``held`` makes of their hashes."""
    kind = f"array<{hashes.select(held(F.col('h')).alias('held')).dtypes[0][1]}>"

    def at(h: Column) -> Column:
        return F.pmod(h, F.lit(buckets)).cast("int")

    filled = hashes.groupBy(at(F.col("h")).alias("bucket")).agg(F.collect_list(held(F.col("h"))).alias("held"))
    every = hashes.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(filled, "bucket", "left")
    every = every.select("bucket", F.coalesce("held", F.array().cast(kind)).alias("held"))
    # one array of all buckets, within the bound
    whole = every.agg(F.sort_array(F.collect_list(F.struct("bucket", "held"))).alias("whole"))
    whole = whole.select(F.transform("whole", lambda x: x["held"]).alias("whole")).scalar()
    return Members(whole, lambda table, h: F.array_contains(F.get(table, at(h)), held(h)))


def _members(hashes: DataFrame, n: int, each: int, max_bytes: int, held: Callable[[Column], Column]) -> Members | None:
    per_bucket = _per_bucket(n, each, max_bytes)
    # an odd number: buckets and fingerprints do not depend on the same bits
    return None if per_bucket is None else _bucketed(hashes, (n // per_bucket) | 1, held)


def alike(hashes: DataFrame, n: int, max_bytes: int = MAX_BROADCAST_BYTES) -> Members | None:
    """A table that has the ``n`` hashes of the column ``h``, and a few others; none above the bound."""
    return _members(hashes, n, 2, max_bytes, _fingerprint)


def among(hashes: DataFrame, n: int, max_bytes: int = MAX_BROADCAST_BYTES) -> Members | None:
    """The same, that has the ``n`` hashes alone."""
    return _members(hashes, n, 8, max_bytes, lambda h: h)
