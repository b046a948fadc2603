"""Near duplicates by SimHash fingerprints, linked through vantage-point trees.

Fingerprints that differ in few bits are found by a forest of vantage-point trees.

* The 64 bits are cut into ``blocks`` blocks.  Of two fingerprints within ``radius`` bits,
  at least one block differs in ``radius // blocks`` bits or fewer, so there is one tree
  for each block, and it is searched with that smaller radius (1 for 4 bits and 3
  blocks).  In a single tree over all 64 bits no bound would prune: distances from any
  vantage point crowd within 32 +- 4, and a search visits 7 of 8 branches per level.
* A level of a tree has a vantage point on one segment of the block.  Its children are
  rings: fingerprints at equal Hamming distance from the vantage point.  By the triangle
  inequality the ring numbers of two fingerprints differ by no more than their distance
  in that segment, and as the segments are disjoint, the differences along a path add up
  to a lower bound of the distance in the block.  A branch beyond the radius is pruned.
* A leaf is a shard.  Every fingerprint is at home in one shard of each tree, and visits
  the shards that its radius overlaps beyond a boundary.  In a shard, residents meet
  residents and visitors, and a pair counts after all its 64 bits were compared.

Vantage points are fitted on a bounded sample, which decides about speed alone.  Levels
are added as the number of fingerprints grows, so that the rows that meet one fingerprint
stay about as many.  A shard that is too large all the same, such as one around a family
of near copies, is cut into cells of residents and rows that meet in separate tasks.
A cell returns a spanning forest of its links, not all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bandlex.llm.components import connected_components
from bandlex.llm.shared import DIGEST, row_digest, settle, without_rows
from bandlex.operators.lookup import fits_broadcast

SEED = 42
SHINGLE = 4
RADIUS = 4
BLOCKS = 3
SAMPLE = 4096  # fingerprints that vantage points are fitted on
CANDIDATES = 24  # vantage points tried for each segment
MEETINGS = 4096  # rows that should meet one fingerprint, over all trees
CELL_ROWS = 32768  # rows of a shard that are compared in one task
STEP = 1 << 16  # hashes held at a time
SEGMENTS = (8, 6, 5, 4, 3, 2, 1)  # bits of a segment, from shallow trees to deep ones


# fingerprints


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of the text's word shingles, repeats included, as a signed 64-bit integer.

    A bit is 1 if it is 1 in more than half of the XXH64 hashes of the shingles.  ASCII
    letters are lower-cased; a text of fewer words is one shingle, one of none has 0.
    """
    words = (text or "").encode().lower().split()  # bytes: ASCII letters and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(shingle, len(words))
    starts, ends = starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()
    ones = np.zeros(64, np.int64)
    for i in range(0, len(starts), STEP):
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[s:e], SEED) for s, e in zip(starts[i : i + STEP], ends[i : i + STEP])]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    value = np.packbits(ones * 2 > len(starts), bitorder="little").view("<i8")
    return int(value[0])


def with_fingerprint(docs: DataFrame, carry: Column | None = None) -> DataFrame:
    """``doc_id, carried, fingerprint`` (long) of every row; ``carry`` is a string."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array((fingerprint(x.as_py()) for x in batch.column(2)), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), found], ["doc_id", "carried", "fingerprint"])

    carried = F.lit(None).cast("string") if carry is None else carry
    rows = docs.select(F.col("doc_id").cast("long"), carried.alias("carried"), "text")
    return rows.mapInArrow(compute, "doc_id long, carried string, fingerprint long")


# trees


class Level(NamedTuple):
    mask: int  # the bits of its segment
    vantage: int  # the vantage point, within these bits
    rings: int  # one more than the bits of the segment


def _blocks(blocks: int) -> list[list[int]]:
    return [part.tolist() for part in np.array_split(np.arange(64), blocks)]


def _level(bits: list[int], sample: np.ndarray) -> tuple[Level, float, float]:
    """The level with the most even rings among candidate vantage points, and how often
    two fingerprints share a ring or are one ring apart."""
    mask = sum(1 << b for b in bits)
    values = sample & np.uint64(mask)
    best = None
    for vantage in dict.fromkeys([*values[:CANDIDATES].tolist(), 0]):
        sizes = np.bincount(np.bitwise_count(values ^ np.uint64(vantage)), minlength=len(bits) + 1) + 0.5
        p = sizes / sizes.sum()
        same, near = float((p * p).sum()), float(2 * (p[1:] * p[:-1]).sum())
        if best is None or same + near < best[1] + best[2]:
            best = (Level(mask, int(vantage), len(bits) + 1), same, near)
    return best


def plan_forest(
    sample: np.ndarray, n: int, radius: int = RADIUS, blocks: int = BLOCKS, meetings: int = MEETINGS
) -> list[list[Level]]:
    """The levels of each tree: the shallowest trees in which about ``meetings`` of ``n``
    fingerprints meet one.  ``radius // blocks`` must be 0 or 1."""
    if radius // blocks > 1:
        raise ValueError("more blocks are needed: a tree is searched with a radius of 0 or 1")
    sample = sample.view(np.uint64) if len(sample) else np.zeros(1, np.uint64)
    for width in SEGMENTS:
        trees, share = [], 0.0
        for bits in _blocks(blocks):
            found = [_level(bits[i : i + width], sample) for i in range(0, len(bits), width)]
            same = np.array([s for _, s, _ in found])
            near = np.array([m for _, _, m in found])
            share += same.prod() + (radius // blocks) * sum(m * np.delete(same, i).prod() for i, m in enumerate(near))
            trees.append([level for level, _, _ in found])
        if share * n <= meetings:
            break
    return trees


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def shards(fingerprints: DataFrame, trees: list[list[Level]], visit: int) -> DataFrame:
    """``leaf, fingerprint, resident``: the shard of each fingerprint in each tree, and with
    ``visit`` of 1 those one ring further out.

    Going outwards is enough: of two fingerprints in neighbouring shards, the one in the
    inner ring visits the other's.
    """
    places: list[Column] = []
    for tree, levels in enumerate(trees):
        path, base, outer = F.lit(0).cast("long"), 1, []
        for level in levels:
            ring = F.bit_count(F.col("fingerprint").bitwiseXOR(F.lit(_signed(level.vantage))).bitwiseAND(F.lit(_signed(level.mask))))
            path = path + ring.cast("long") * F.lit(base)
            outer.append((ring < level.rings - 1, base))
            base *= level.rings
        path = path * F.lit(len(trees)) + F.lit(tree)
        places.append(F.struct(path.alias("leaf"), F.lit(True).alias("resident")))
        if visit:
            for inside, step in outer:
                place = F.struct((path + F.lit(step * len(trees))).alias("leaf"), F.lit(False).alias("resident"))
                places.append(F.when(inside, place))
    placed = fingerprints.select("fingerprint", F.explode(F.array(*places)).alias("place"))
    return placed.where("place is not null").select("place.leaf", "fingerprint", "place.resident")


def _cells(placed: DataFrame, cell_rows: int) -> DataFrame:
    """The rows with ``row_cell, column_cell``: large shards are cut into cells so that
    every resident meets every row in exactly one of them."""
    sizes = placed.groupBy("leaf").agg(F.count("*").alias("n")).where(F.col("n") > cell_rows)
    sizes = settle(sizes.select("leaf", F.ceil(F.col("n") / cell_rows).cast("int").alias("parts")))
    small = F.broadcast(sizes) if fits_broadcast(sizes, "leaf") else sizes
    parts = F.coalesce("parts", F.lit(1))
    own = F.pmod(F.xxhash64("fingerprint"), parts).cast("int")
    every = F.sequence(F.lit(0), parts - 1)
    rows = placed.join(small, "leaf", "left").withColumns({"own": own, "every": every})
    as_row = F.transform("every", lambda i: F.struct(F.col("own").alias("row_cell"), i.alias("column_cell"), F.lit(True).alias("as_row")))
    as_column = F.transform("every", lambda i: F.struct(i.alias("row_cell"), F.col("own").alias("column_cell"), F.lit(False).alias("as_row")))
    # a row that is both is one row of its own cell
    as_column = F.filter(as_column, lambda c: ~(F.col("resident") & (c["row_cell"] == F.col("own"))))
    cells = F.explode(F.when(F.col("resident"), F.concat(as_row, as_column)).otherwise(as_column)).alias("cell")
    return rows.select("leaf", "fingerprint", "own", cells).select("leaf", "fingerprint", "own", "cell.*")


def _forest(values: np.ndarray, is_row: np.ndarray, is_column: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest over the pairs of a row and a column within ``radius``:
    every linked value with the root of its tree."""
    parent = np.arange(len(values))
    rows, columns = np.flatnonzero(is_row), np.flatnonzero(is_column)
    step = max(1, (1 << 21) // max(1, len(columns)))
    for i in range(0, len(rows), step):
        near = np.bitwise_count(values[rows[i : i + step], None] ^ values[columns]) <= radius
        x, y = np.nonzero(near)
        x, y = rows[x + i], columns[y]
        x, y = x[x != y], y[x != y]
        # hook the larger root to the smaller one, and shorten paths, until all agree
        while len(x):
            a, b = parent[x], parent[y]
            apart = a != b
            if not apart.any():
                break
            x, y, a, b = x[apart], y[apart], a[apart], b[apart]
            np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
            while (parent[parent] != parent).any():
                parent = parent[parent]
    linked = np.flatnonzero(parent != np.arange(len(values)))
    return values[linked], values[parent[linked]]


def _search(radius: int):
    """Links within the cells of a partition sorted by cell."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["leaf", "row_cell", "column_cell", "fingerprint", "own", "as_row"]
        held: list[np.ndarray] | None = None

        def links(columns: list[np.ndarray], cuts: np.ndarray) -> pa.RecordBatch:
            leaf, row_cell, column_cell, value, own, as_row = columns
            found = []
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if hi - lo < 2 or not as_row[lo:hi].any():
                    continue
                # what is a row of its own cell is a column there as well
                is_column = ~as_row[lo:hi] | (column_cell[lo:hi] == own[lo:hi])
                a, b = _forest(value[lo:hi].view(np.uint64), as_row[lo:hi], is_column, radius)
                if len(a):
                    found.append((a.view(np.int64), b.view(np.int64)))
            a, b = (np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.int64),) * 2
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False) for n in names]
            if held is not None:
                columns = [np.concatenate(pair) for pair in zip(held, columns)]
            if not len(columns[0]):
                continue
            new = (np.diff(columns[0]) != 0) | (np.diff(columns[1]) != 0) | (np.diff(columns[2]) != 0)
            cuts = np.concatenate(([0], np.flatnonzero(new) + 1))
            yield links(columns, cuts)
            held = [c[cuts[-1] :] for c in columns]
        if held is not None:
            yield links(held, np.array([0, len(held[0])]))

    return search


def fingerprint_links(
    fingerprints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, meetings: int = MEETINGS, cell_rows: int = CELL_ROWS
) -> DataFrame:
    """``a, b``: links between distinct fingerprints within ``radius`` bits that connect
    exactly what all such pairs connect.  ``fingerprints`` is settled and distinct."""
    sample = fingerprints.orderBy(F.xxhash64("fingerprint")).limit(SAMPLE).toPandas()["fingerprint"].to_numpy(np.int64)
    trees = plan_forest(sample, fingerprints.count(), radius, blocks, meetings)
    cells = _cells(shards(fingerprints, trees, radius // blocks), cell_rows)
    key = ["leaf", "row_cell", "column_cell"]
    return cells.repartition(*key).sortWithinPartitions(*key).mapInArrow(_search(radius), "a long, b long")


# components


def _classified(docs: DataFrame, radius: int, blocks: int, carry: Column | None = None) -> DataFrame:
    """``doc_id, carried, fingerprint, component, least, component_size``: the component as a
    fingerprint, and its row that is preferred."""
    prints = settle(with_fingerprint(docs, carry))
    place = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "carried"))
    distinct = settle(prints.groupBy("fingerprint").agg(place.alias("first"), F.count("*").alias("n")))
    labels = connected_components(fingerprint_links(distinct.select("fingerprint"), radius, blocks))
    labels = labels.withColumnRenamed("node", "fingerprint")
    placed = settle(
        distinct.join(labels, "fingerprint", "left").withColumn("component", F.coalesce("component", "fingerprint"))
    )
    components = placed.groupBy("component").agg(F.min("first").alias("least"), F.sum("n").alias("component_size"))
    classes = placed.join(components, "component").select("fingerprint", "component", "least", "component_size")
    return prints.join(classes, "fingerprint")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """``doc_id, fingerprint, component_id, component_size`` for every row of ``docs``.

    ``fingerprint`` is written as 16 hexadecimal digits.  ``component_id`` is the smallest
    ``doc_id`` that can be reached over fingerprints at most ``radius`` bits apart, and
    null only if all of these are null.  ``component_size`` counts the rows of a component.
    Null and empty texts have fingerprint zero and are linked like any other.  Repeated
    rows are in one component; other columns are ignored; no rows give no rows.
    """
    return _classified(docs, radius, blocks).select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.col("least.doc_id").alias("component_id"),
        "component_size",
    )


def drop_near_duplicates(docs: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """One row of each component of ``docs``, that of the smallest ``doc_id`` (nulls last), with
    all its columns as they are, whatever their names.

    Null and empty texts are linked like any other; of repeated rows at most one stays; no
    rows give no rows.
    """
    docs = docs.withColumn(DIGEST, row_digest("text"))
    rows = settle(_classified(docs, radius, blocks, F.col(DIGEST))).withColumnRenamed("carried", DIGEST)
    stays = F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col(DIGEST) == F.col("least.carried"))
    repeated = rows.where(stays).groupBy("doc_id", DIGEST).agg(F.count("*").alias("n")).where("n > 1")
    return without_rows(docs, rows.where(~stays), repeated)
