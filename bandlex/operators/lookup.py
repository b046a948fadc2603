"""Joins of a large table with a lookup table of unknown size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_BYTES = 64 << 20
ROW_BYTES = 64  # rough cost of a row beyond its key text


def fits_broadcast(lookup: DataFrame, key: str, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether the measured size of ``lookup`` is within the bound; a query over its key
    column alone."""
    size = lookup.select(F.sum(F.octet_length(F.col(key)) + ROW_BYTES)).first()[0] or 0
    return size <= max_bytes


def join_lookup(rows: DataFrame, lookup: DataFrame, on: str, how: str) -> DataFrame:
    """Join, broadcasting ``lookup`` only when it fits.

    Beyond the bound this is an ordinary shuffled join, in which adaptive execution
    splits the partitions of keys that hold a large share of ``rows``.
    """
    return rows.join(F.broadcast(lookup) if fits_broadcast(lookup, on) else lookup, on, how)
