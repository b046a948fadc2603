"""Nearest neighbours by cosine through a forest of hash prefixes.

Every tree gives a vector a string of ``BITS`` bits, the sides of as many random planes it
lies on.  A tree is the sorted array of these strings: vectors with a common prefix are a
slice of it, and the longer the prefix, the nearer they tend to be.

* **Descending.**  A query is looked up in the array of every tree.  What stands next to its
  place matches the longest prefixes, of whatever length these are.  The best of all trees
  are compared; the score of the last of the nearest found so far is a bound.
* **Ascending.**  All trees go up together, to one prefix length for a query: the longest at
  which a vector as near as the bound shares the prefix in at least one of the trees with
  a chance of ``SURE`` or more.  For vectors at an angle ``a`` a bit agrees with a chance
  of ``1 - a / pi``, whatever the data, so the length follows from the bound alone.  Every
  vector in the slices of that prefix is compared.  Near neighbours allow long prefixes and
  few comparisons; where even the nearest are far away, most vectors are candidates.

The vectors are dealt to shards by a hash; a shard holds the part of every tree that its
vectors make up, and is built and searched by one task.  Queries visit all shards, once for
each step, and the nearest of each shard are merged.  Prefix lengths and bounds are those of
the whole collection, so shards do not change what is a candidate of a query's ascent.
Equal vectors are one vector with the smallest of its ids, as many as a result can hold.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bandlex.llm.shared import settle

NEAREST = 5
EVERY = 50  # ids that this divides are queries
TREES = 24
BITS = 64
SURE = 0.95
BESIDE = 8  # rows looked at on either side of a query's place in a tree
SHARD = 1 << 17  # vectors of a shard at most, about
LEAST = 256  # below this many, vectors are not dealt to more shards
BLOCK = 64  # queries compared at a time
SEED = 42


def planes(width: int, trees: int = TREES, bits: int = BITS) -> np.ndarray:
    """Normals of the random planes, ``width`` by ``trees * bits``."""
    return np.random.default_rng(SEED).standard_normal((width, trees * bits)).astype(np.float32)


def hash_strings(vectors: np.ndarray, trees: int = TREES, bits: int = BITS) -> np.ndarray:
    """The strings of each vector, one unsigned number per tree; the first bit is the
    highest.  ``vectors`` is a matrix of doubles."""
    sides = planes(vectors.shape[1], trees, bits)
    found = np.empty((len(vectors), trees), np.uint64)
    for i in range(0, len(vectors), 4096):
        packed = np.packbits((vectors[i : i + 4096] @ sides > 0).reshape(-1, bits), axis=1)
        wide = np.zeros((len(packed), 8), np.uint8)
        wide[:, : packed.shape[1]] = packed
        found[i : i + 4096] = wide.view(">u8").astype(np.uint64).reshape(-1, trees)
    return found


def prefix_length(bound: Column, trees: int = TREES, bits: int = BITS, sure: float = SURE) -> Column:
    """The longest prefix that a vector with this cosine shares with a query in some tree with
    a chance of ``sure``: ``1 - (1 - agree ** length) ** trees >= sure``.  0 for a null."""
    agree = 1 - F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), bound))) / math.pi
    needed = math.log(1 - (1 - sure) ** (1 / trees))
    length = F.floor(F.lit(needed) / F.log(F.greatest(F.least(agree, F.lit(1 - 1e-15)), F.lit(1e-300))))
    return F.when(bound.isNull(), 0).otherwise(F.least(length, F.lit(bits))).cast("int")


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Each vector times a power of two, so that no square overflows or vanishes."""
    top = np.frexp(np.abs(vectors).max(axis=-1, initial=0))[1]
    return np.ldexp(vectors, -top[..., None])


def units(vectors: np.ndarray) -> np.ndarray:
    """The vectors with a length of 1."""
    scaled = _scaled(vectors)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1))[:, None]


def exact_cosine(a: np.ndarray, b: np.ndarray) -> float:
    """The cosine of two vectors of doubles, with sums that are rounded once."""
    a, b = _scaled(a), _scaled(b)
    dot, aa, bb = (math.fsum((x * y).tolist()) for x, y in ((a, b), (a, a), (b, b)))
    return dot / (math.sqrt(aa) * math.sqrt(bb))


class Shard:
    """The sorted arrays of all trees over some vectors."""

    def __init__(self, ids: list[list[int]], vectors: np.ndarray, trees: int = TREES, bits: int = BITS):
        self.ids, self.vectors, self.bits = ids, vectors, bits
        self.units = units(vectors)
        strings = hash_strings(self.units, trees, bits)
        self.order = np.argsort(strings, axis=0, kind="stable").astype(np.int32)
        self.strings = np.take_along_axis(strings, self.order.astype(np.int64), axis=0)

    def slices(self, strings: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where, in each tree, the rows begin and end that share the prefix of each query."""
        shift = np.uint64(64) - length.astype(np.uint64)[:, None]
        none = shift == 64
        rest = np.where(none, np.uint64((1 << 64) - 1), (np.uint64(1) << np.where(none, np.uint64(0), shift)) - np.uint64(1))
        low = strings & ~rest
        high = low | rest
        columns = range(strings.shape[1])
        begin = np.stack([np.searchsorted(self.strings[:, t], low[:, t], "left") for t in columns], axis=1)
        end = np.stack([np.searchsorted(self.strings[:, t], high[:, t], "right") for t in columns], axis=1)
        return begin, end

    def beside(self, strings: np.ndarray, n: int = BESIDE) -> tuple[np.ndarray, np.ndarray]:
        """The ``n`` rows on either side of each query's place in each tree."""
        columns = range(strings.shape[1])
        at = np.stack([np.searchsorted(self.strings[:, t], strings[:, t], "left") for t in columns], axis=1)
        return np.maximum(at - n, 0), np.minimum(at + n, len(self.vectors))

    def nearest(self, ids: list[int], asked: np.ndarray, begin: np.ndarray, end: np.ndarray, k: int) -> Iterator[tuple]:
        """``query, id, row`` of each query's ``k`` nearest in the slices: each id with the
        row of its vector.  Rows of equal score are all there."""
        dense = None
        for q, own in enumerate(ids):
            listed = np.zeros(len(self.vectors), bool)
            for t, (a, b) in enumerate(zip(begin[q].tolist(), end[q].tolist())):
                listed[self.order[a:b, t]] = True
            rows = np.flatnonzero(listed)
            if not len(rows):
                continue
            if 4 * len(rows) < len(self.vectors):
                found = self.units[rows] @ asked[q]
            else:  # a product with all rows takes less than picking out so many
                dense = asked @ self.units.T if dense is None else dense
                found = dense[q, rows]
            # one row may have the query's id alone
            if len(rows) > k + 1:
                least = np.partition(found, len(rows) - k - 1)[len(rows) - k - 1] - 1e-12
                rows = rows[found >= least]
            for row in rows.tolist():
                for i in self.ids[row]:
                    if i != own:
                        yield q, i, row


def _vectors(column: pa.Array) -> np.ndarray:
    sizes = np.diff(column.offsets.to_numpy())
    if len(sizes) and (sizes != sizes[0]).any():
        raise ValueError("vectors must have one length")
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(sizes), -1)


def _collapsed(rows: DataFrame, ids: int) -> DataFrame:
    """``vector, ids``: every vector once with its smallest ids.  What moves is combined in
    the tasks before, so that a vector of very many rows moves ``ids`` times per batch."""

    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = _vectors(pa.concat_arrays([batch.column(1)])) + 0.0  # one zero
            key = np.ascontiguousarray(raw).view(np.dtype((np.void, raw.shape[1] * 8))).ravel()
            own = batch.column(0).to_numpy()
            order = np.lexsort((own, np.unique(key, return_inverse=True)[1]))
            first = np.ones(len(order), bool)
            first[1:] = (key[order[1:]] != key[order[:-1]]) | (own[order[1:]] != own[order[:-1]])
            order = order[first]  # repeated rows once
            head = np.ones(len(order), bool)
            head[1:] = key[order[1:]] != key[order[:-1]]
            nth = np.arange(len(order)) - np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))
            yield batch.take(pa.array(np.sort(order[nth < ids])))

    few = rows.mapInArrow(collapse, rows.schema).repartition("vector")
    few = few.groupBy("vector", "vec_id").agg(F.count("*").alias("n"))
    nth = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    few = few.withColumn("nth", nth).where(F.col("nth") <= ids)
    return few.groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))


def _visits(index: DataFrame, queries: DataFrame, shards: int) -> DataFrame:
    """Rows of the index and of the queries at every shard, the index first."""
    rows = index.select("shard", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("query"), "ids", "vector", F.lit(0).alias("length"))
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    asked = queries.select(every, F.lit(1).alias("kind"), "query", F.array("query_id").alias("ids"), "vector", "length")
    return rows.unionByName(asked).repartition(shards, "shard").sortWithinPartitions("shard", "kind")


def _search(visits: DataFrame, k: int, ascend: bool, trees: int, bits: int, beside: int) -> DataFrame:
    """``query, query_id, vec_id, score`` of the nearest of every shard."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {"ids": [], "vectors": []}
        at, shard = None, None

        def answer(part: pa.RecordBatch) -> pa.RecordBatch:
            number, own, length = part.column(2).to_pylist(), [x[0] for x in part.column(3).to_pylist()], part.column(5).to_numpy()
            vectors = _vectors(pa.concat_arrays([part.column(4)]))
            asked = units(vectors)
            strings = hash_strings(asked, trees, bits)
            rows = []
            for i in range(0, len(own), BLOCK):
                block = slice(i, i + BLOCK)
                begin, end = shard.slices(strings[block], length[block]) if ascend else shard.beside(strings[block], beside)
                known: dict[tuple, float] = {}
                for q, vec_id, row in shard.nearest(own[block], asked[block], begin, end, k):
                    if (q, row) not in known:
                        known[q, row] = exact_cosine(vectors[i + q], shard.vectors[row])
                    rows.append((number[i + q], own[i + q], vec_id, known[q, row]))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
            columns = [pa.array([r[c] for r in rows], t) for c, t in enumerate(types)]
            return pa.RecordBatch.from_arrays(columns, ["query", "query_id", "vec_id", "score"])

        for batch in batches:
            if not batch.num_rows:
                continue
            places = batch.column(0).to_numpy()
            kinds = batch.column(1).to_numpy()
            cuts = np.flatnonzero((np.diff(places) != 0) | (np.diff(kinds) != 0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(places)]):
                part = batch.slice(a, b - a)
                if places[a] != at:
                    at, shard, held = places[a], None, {"ids": [], "vectors": []}
                if kinds[a] == 0:
                    held["ids"] += part.column(3).to_pylist()
                    held["vectors"].append(_vectors(pa.concat_arrays([part.column(4)])))
                    continue
                if shard is None and held["ids"]:
                    shard = Shard(held["ids"], np.concatenate(held["vectors"]), trees, bits)
                    held = {"ids": [], "vectors": []}
                if shard is not None:
                    yield answer(part)

    return visits.mapInArrow(search, "query long, query_id long, vec_id long, score double")


def _best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest of each query, with ``rank``; an id counts with its best score."""
    found = found.groupBy("query", "query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def nearest_vectors(
    rows: DataFrame,
    vector: str = "embedding",
    k: int = NEAREST,
    every: int = EVERY,
    trees: int = TREES,
    bits: int = BITS,
    sure: float = SURE,
    beside: int = BESIDE,
    shard: int = SHARD,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of every row whose ``vec_id``
    is divisible by ``every``, among all rows with another id.

    Nearness is the cosine in double precision; ties go to the smaller id.  Rows without an
    id, and vectors that are null, empty or zero or hold a null, NaN or infinite component,
    take no part; vectors of different lengths end the query.  A row that is repeated counts
    once; an id with several vectors is a query for each, and a neighbour by the nearest of
    them.  Other columns are ignored, whatever their names; no rows give no rows.
    """
    x = F.col(vector)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = x.isNotNull() & F.coalesce(finite & F.exists(x, lambda v: v != 0), F.lit(False))
    kept = rows.where(usable & F.col("vec_id").isNotNull())
    kept = kept.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("vector"))
    distinct = settle(_collapsed(kept, k + 1))
    n = distinct.count()
    shards = max(-(-n // shard), min(rows.sparkSession.sparkContext.defaultParallelism, -(-n // LEAST)), 1)
    index = distinct.withColumn("shard", F.pmod(F.xxhash64("vector"), F.lit(shards)).cast("int"))
    queries = kept.where(F.col("vec_id") % every == 0).distinct()
    queries = settle(queries.select(F.monotonically_increasing_id().alias("query"), F.col("vec_id").alias("query_id"), "vector"))

    first = _search(_visits(index, queries.withColumn("length", F.lit(0)), shards), k, False, trees, bits, beside)
    first = settle(_best(first, k))
    # without k neighbours yet, everything is compared
    bound = first.where(F.col("rank") == k).select("query", F.col("score").alias("bound"))
    length = prefix_length(F.col("bound"), trees, bits, sure).alias("length")
    climbing = queries.join(bound, "query", "left").select("query", "query_id", "vector", length)
    second = _search(_visits(index, climbing, shards), k, True, trees, bits, beside)
    found = _best(first.drop("rank").unionByName(second), k)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
