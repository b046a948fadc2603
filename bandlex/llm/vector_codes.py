"""Product codes of vectors, fitted exactly over metric trees made by the anchors hierarchy.

A vector is cut into equal parts, and each part is coded by the nearest entry of its
position's codebook.  Fitting takes Lloyd's rounds over all rows, in whole numbers:

1. Rows are held in chunks.  For each part of a chunk a metric tree is built middle-out:
   about the square root of its points become anchors, each new one the point farthest from
   the anchor of the widest ball, which steals the points that are nearer to it.  A point
   that is nearer to its anchor than half the distance of the two anchors is never looked
   at (triangle inequality).  Anchors are merged upwards, always the pair whose common ball
   is smallest, and every anchor's points are divided in the same way further down.  Every
   ball holds the number and the sum of its points.
2. A round starts at the root with all entries.  A ball inherits the entries of the ball
   around it and drops those that are farther than the nearest one from all of its points.
   Once one entry is left, the ball is wholly owned: its cached number and sum are added,
   and nothing below is visited.  Points of a leaf that is still divided are compared one
   by one, in whole numbers, so that results are those of comparing everything.
3. Chunks are settled once in the shared folder.  A round sends the codebooks out and gets
   one sum per part, entry and task; the driver sees ``parts * entries`` rows of it.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandlex.llm.shared import settle
from bandlex.operators.lookup import fits_broadcast

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
CHUNK = 8192  # rows of a chunk, and of its trees
LEAF = 16  # points of a ball that is not divided further
LIMIT = 1 << 26  # of a whole component: squared distances stay exact


# trees


class Tree:
    """A metric tree over the rows of ``points`` (whole numbers).

    ``order`` lists the points so that those of ball ``i`` are ``order[lo[i]:hi[i]]``; its
    children are ``first[i]`` up to ``first[i] + children[i]``.  Ball 0 holds everything.
    """

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points = points
        found = _grow(points.astype(np.float64), np.arange(len(points)), leaf)
        order: list[np.ndarray] = []
        lo, hi, first, children, queue = [0], [len(points)], [0], [0], [found]
        at = 0
        while at < len(queue):
            ball = queue[at].inside
            queue[at] = None
            start = lo[at]
            if isinstance(ball, list):
                first[at], children[at] = len(queue), len(ball)
                for child in ball:
                    lo.append(start)
                    start += child.size
                    hi.append(start)
                    first.append(0)
                    children.append(0)
                    queue.append(child)
            else:
                order.append((start, ball))
            at += 1
        self.order = np.empty(len(points), np.int64)
        for start, held in order:
            self.order[start : start + len(held)] = held
        self.lo, self.hi, self.first, self.children = (np.array(x, np.int64) for x in (lo, hi, first, children))
        sorted_points = points[self.order]
        running = np.concatenate((np.zeros((1, points.shape[1]), np.int64), np.cumsum(sorted_points, axis=0, dtype=np.int64)))
        self.counts = self.hi - self.lo
        self.sums = running[self.hi] - running[self.lo]
        self.pivots = self.sums / np.maximum(self.counts, 1)[:, None]
        self.radii = np.zeros(len(lo))
        for i, (a, b) in enumerate(zip(lo, hi)):
            if b > a:
                self.radii[i] = np.sqrt(((sorted_points[a:b] - self.pivots[i]) ** 2).sum(axis=1).max())
        self.radii = self.radii * (1 + 1e-9) + 1e-6

    def owners(self, codebook: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``balls, ball_entries, points, point_entries``: the wholly owned balls and the
        single points that together are the whole tree, with their nearest entries (of
        equally near ones the first)."""
        entries = codebook.astype(np.float64)
        apart = np.sqrt(((entries[:, None] - entries[None]) ** 2).sum(axis=2))
        # of equal entries only the first can own anything
        usable = np.array([not (codebook[:k] == codebook[k]).all(axis=1).any() for k in range(len(codebook))])
        balls, ball_entries, points, point_entries = [], [], [], []
        open_balls = np.zeros(1, np.int64) if len(self.points) else np.empty(0, np.int64)
        listed = np.tile(usable, (len(open_balls), 1))
        while len(open_balls):
            far = ((self.pivots[open_balls, None] - entries[None]) ** 2).sum(axis=2)
            far[~listed] = np.inf
            best = far.argmin(axis=1)
            least = far[np.arange(len(best)), best][:, None]
            gap = 2 * self.radii[open_balls, None] * apart[best]
            with np.errstate(invalid="ignore"):
                listed &= ~(far - least > gap + 1e-9 * (far + least) + 1e-3)
            owned = listed.sum(axis=1) == 1
            balls.append(open_balls[owned])
            ball_entries.append(best[owned])
            rest, lists = open_balls[~owned], listed[~owned]
            leaves = self.children[rest] == 0
            if leaves.any():
                spans = [np.arange(a, b) for a, b in zip(self.lo[rest[leaves]], self.hi[rest[leaves]])]
                held = self.order[np.concatenate(spans)]
                mine = np.repeat(lists[leaves], [len(s) for s in spans], axis=0)
                squared = ((self.points[held][:, None] - codebook[None]) ** 2).sum(axis=2)
                squared[~mine] = np.iinfo(np.int64).max
                points.append(held)
                point_entries.append(squared.argmin(axis=1))
            rest, lists = rest[~leaves], lists[~leaves]
            n = self.children[rest]
            steps = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            open_balls, listed = np.repeat(self.first[rest], n) + steps, np.repeat(lists, n, axis=0)
        empty = np.empty(0, np.int64)
        return tuple(np.concatenate(x) if x else empty for x in (balls, ball_entries, points, point_entries))

    def totals(self, codebook: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number and the sum of the points of each entry."""
        balls, ball_entries, points, point_entries = self.owners(codebook)
        counts = np.zeros(len(codebook), np.int64)
        sums = np.zeros(codebook.shape, np.int64)
        np.add.at(counts, ball_entries, self.counts[balls])
        np.add.at(counts, point_entries, 1)
        np.add.at(sums, ball_entries, self.sums[balls])
        np.add.at(sums, point_entries, self.points[points])
        return counts, sums

    def labels(self, codebook: np.ndarray) -> np.ndarray:
        """The entry of each point."""
        balls, ball_entries, points, point_entries = self.owners(codebook)
        found = np.empty(len(self.points), np.int64)
        for ball, entry in zip(balls.tolist(), ball_entries.tolist()):
            found[self.order[self.lo[ball] : self.hi[ball]]] = entry
        found[points] = point_entries
        return found


class _Ball(NamedTuple):
    size: int
    inside: list | np.ndarray  # balls, or points


def _anchors(points: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``pivots, owner, distance``: at most ``n`` anchors, and of each point its anchor and
    how far that is."""
    pivots = [0]
    owner = np.zeros(len(points), np.int64)
    distance = np.sqrt(((points - points[0]) ** 2).sum(axis=1))
    while len(pivots) < n:
        new = int(distance.argmax())  # the farthest point of the widest ball
        if distance[new] == 0:
            break
        between = np.sqrt(((points[pivots] - points[new]) ** 2).sum(axis=1))
        # nearer to its anchor than half way to the new one: never stolen
        asked = np.flatnonzero(distance * 2 > between[owner] * (1 - 1e-12))
        d = np.sqrt(((points[asked] - points[new]) ** 2).sum(axis=1))
        stolen = d < distance[asked]
        owner[asked[stolen]], distance[asked[stolen]] = len(pivots), d[stolen]
        pivots.append(new)
    return np.array(pivots), owner, distance


def _merge(balls: list, centres: np.ndarray, radii: np.ndarray) -> _Ball:
    """One ball around all of ``balls``: pairs whose common ball is smallest are merged."""
    centres, radii, balls = centres.copy(), radii.copy(), list(balls)
    counts, everything = np.array([b.size for b in balls], np.float64), sum(b.size for b in balls)

    def common(i: int) -> np.ndarray:
        between = np.sqrt(((centres - centres[i]) ** 2).sum(axis=1))
        return np.maximum((between + radii + radii[i]) / 2, np.maximum(radii, radii[i]))

    cost = np.stack([common(i) for i in range(len(balls))])
    np.fill_diagonal(cost, np.inf)
    for _ in range(len(balls) - 2):
        i, j = divmod(int(cost.argmin()), len(cost))
        total = counts[i] + counts[j]
        centre = (centres[i] * counts[i] + centres[j] * counts[j]) / total
        reach = max(np.sqrt(((centres[k] - centre) ** 2).sum()) + radii[k] for k in (i, j))
        balls[i], balls[j] = _Ball(int(total), [balls[i], balls[j]]), None
        centres[i], radii[i], counts[i] = centre, reach, total
        cost[j] = cost[:, j] = np.inf
        row = common(i)
        row[[k for k, ball in enumerate(balls) if ball is None or k == i]] = np.inf
        cost[i] = cost[:, i] = row
    return _Ball(everything, [ball for ball in balls if ball is not None])


def _grow(points: np.ndarray, held: np.ndarray, leaf: int) -> _Ball:
    """The ball of the points ``held``."""
    if len(held) <= leaf:
        return _Ball(len(held), held)
    own = points[held]
    pivots, owner, distance = _anchors(own, max(2, int(np.sqrt(len(held)))))
    if len(pivots) == 1:  # equal points
        return _Ball(len(held), held)
    groups = np.split(np.argsort(owner, kind="stable"), np.cumsum(np.bincount(owner, minlength=len(pivots)))[:-1])
    radii = np.zeros(len(pivots))
    np.maximum.at(radii, owner, distance)
    balls = [_grow(points, held[g], leaf) for g in groups]
    return _merge(balls, own[pivots], radii)


# chunks


def _valid(vector: str):
    x = F.col(vector)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return x.isNotNull() & F.coalesce(finite, F.lit(False)) & (F.size(x) > 0)


def whole_numbers(vectors: np.ndarray) -> np.ndarray:
    """``floor(SCALE * x)`` of each component."""
    found = np.floor(vectors.astype(np.float64) * SCALE)
    if found.size and not np.abs(found).max() < LIMIT:
        raise ValueError(f"components must be below {LIMIT // SCALE} in size")
    return found.astype(np.int64)


def _matrix(column: pa.Array, parts: int) -> np.ndarray:
    """Whole numbers of a list column, one row per vector."""
    sizes = np.diff(column.offsets.to_numpy())
    if (sizes != sizes[0]).any() or sizes[0] % parts:
        raise ValueError(f"vectors must have one length, which {parts} divides")
    return whole_numbers(column.flatten().to_numpy(zero_copy_only=False)).reshape(len(sizes), -1)


def tree_chunks(rows: DataFrame, parts: int = PARTS, chunk: int = CHUNK) -> DataFrame:
    """``size, rows, trees``: chunks of rows ``vec_id, label, vector`` as pickled arrays."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(held: list[tuple]) -> pa.RecordBatch:
            ids, labels = (pa.concat_arrays([h[i] for h in held]) for i in (0, 1))
            points = np.concatenate([h[2] for h in held])
            trees = [Tree(np.ascontiguousarray(p)) for p in np.split(points, parts, axis=1)]
            columns = [len(points)], [pickle.dumps((ids, labels))], [pickle.dumps(trees)]
            arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.binary(), pa.binary()))]
            return pa.RecordBatch.from_arrays(arrays, ["size", "rows", "trees"])

        held, n = [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, chunk - n)
                vectors = pa.concat_arrays([part.column(2)])
                held.append((part.column(0), part.column(1), _matrix(vectors, parts)))
                at, n = at + part.num_rows, n + part.num_rows
                if n == chunk:
                    yield packed(held)
                    held, n = [], 0
        if n:
            yield packed(held)

    return rows.mapInArrow(build, "size long, rows binary, trees binary")


def _first_entries(rows: DataFrame, entries: int, parts: int) -> np.ndarray:
    """``parts, entries, width``: parts of the vectors of the smallest ids; at most
    ``entries`` rows come to the driver."""
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).collect()
    if not first:
        return np.empty((parts, 0, 0), np.int64)
    if len({len(r.vector) for r in first}) > 1 or len(first[0].vector) % parts:
        raise ValueError(f"vectors must have one length, which {parts} divides")
    return np.stack(np.split(whole_numbers(np.array([r.vector for r in first], np.float64)), parts, axis=1))


def _round(chunks: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(books.shape[:2], np.int64), np.zeros(books.shape, np.int64)
        for batch in batches:
            for blob in batch.column(0):
                for k, tree in enumerate(pickle.loads(blob.as_py())):
                    n, s = tree.totals(books[k])
                    counts[k] += n
                    sums[k] += s
        part, entry, place = np.indices(books.shape).reshape(3, -1)
        columns = [part, entry, place, np.repeat(counts.ravel(), books.shape[2]), sums.ravel()]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["part", "entry", "place", "n", "total"])

    found = chunks.select("trees").mapInArrow(add, "part long, entry long, place long, n long, total long")
    found = found.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    books = books.copy()
    for r in found.where("n > 0").collect():  # one row per number of the codebooks
        books[r.part, r.entry, r.place] = r.total // r.n
    return books


def fit_codebooks(chunks: DataFrame, books: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """``books`` after ``rounds`` of assigning every part to its nearest entry (of equally
    near ones the first) and replacing entries by the floor of their parts' means; an entry
    without parts stays."""
    for _ in range(rounds if books.size else 0):
        books = _round(chunks, books)
    return books


def encode_chunks(chunks: DataFrame, books: np.ndarray, label_type: str) -> DataFrame:
    """``vec_id, label, code, error`` of every row."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["vec_id", "label", "code", "error"]
        for batch in batches:
            for rows, blob in zip(batch.column(0), batch.column(1)):
                ids, labels = pickle.loads(rows.as_py())
                codes, error = [], np.zeros(len(ids), np.int64)
                for k, tree in enumerate(pickle.loads(blob.as_py())):
                    found = tree.labels(books[k])
                    error += ((tree.points - books[k][found]) ** 2).sum(axis=1)
                    codes.append(found)
                text = [bytes(row).hex() for row in np.stack(codes, axis=1).astype(np.uint8).tolist()]
                yield pa.RecordBatch.from_arrays([ids, labels, pa.array(text), pa.array(error)], names)

    return chunks.select("rows", "trees").mapInArrow(encode, f"vec_id long, label {label_type}, code string, error long")


def codebooks_digest(books: np.ndarray) -> str:
    """SHA-256 of all entries' numbers by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def vector_codes(
    rows: DataFrame, vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> DataFrame:
    """``vec_id, label, code, error, label_error, codebooks_sha256`` of every row with a vector.

    Rows whose vector is null or empty, or holds a null, NaN or infinite component, are
    left out.  Components count as ``floor(SCALE * x)``, which must be below ``LIMIT`` in
    size; vectors of different lengths, or of one that ``parts`` does not divide, end the
    query.  Codebooks start with the vectors of the smallest ids (nulls last, ties by the
    vector); with fewer rows than ``entries`` there are as many entries as rows.
    ``label_error`` sums ``error`` over a label, over all null labels together.  Repeated
    rows and ids are coded as often as they occur; other columns are ignored, whatever
    their names; no rows give no rows.
    """
    if entries > 256:
        raise ValueError("a code has two hexadecimal digits: at most 256 entries")
    kept = rows.where(_valid(vector)).select(F.col("vec_id").cast("long"), "label", F.col(vector).alias("vector"))
    label_type = dict(kept.dtypes)["label"]
    chunks = settle(tree_chunks(kept.select("vec_id", "label", "vector"), parts))
    books = fit_codebooks(chunks, _first_entries(kept, entries, parts), rounds)
    coded = settle(encode_chunks(chunks, books, label_type))
    errors = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    named = errors.withColumn("size_key", F.col("of").cast("string"))
    errors = F.broadcast(errors) if fits_broadcast(named, "size_key") else errors
    return coded.join(errors, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "label", "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256")
    )
