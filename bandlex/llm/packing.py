"""Packing documents into token sequences of several lengths.

1. Every document is tokenized and cut into pieces: whole windows, and a rest.  Cuts depend
   on the document alone, so ids are seen once, where they are made.  The rest of one
   document in ``FILLER`` is cut into powers of two, which later fill gaps to the token.
2. What is packed is the histogram of piece lengths, at most one count per length, on the
   driver.  Pieces are routed to tiers, the smallest window that holds them.  Tiers are
   packed from long to short, and the gaps of their windows are filled with the longest
   pieces of shorter tiers that fit, then with filler.  Windows of shorter tiers are used
   only where they come out full; what is left over goes into long windows with padding.
3. The plan is a list of runs: so many pieces of one length go to the same place of as many
   successive sequences.  Pieces are numbered within their length, by counts per slice of
   the table and a number within the slice, and find their run by that number.
4. Sequences of each tier are dealt in turn to step groups, which therefore hold the same
   number of tokens.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bandlex.llm.shared import settle
from bandlex.llm.tokens import encoder

WINDOW = 2048
TIERS = (2048, 1024, 512, 256)
END = 1  # the id after a document
FILLER = 32
STEP_TOKENS = 64 * WINDOW  # of a step group
TEXTS = 64  # encoded at a time

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, filler boolean"


def cut(n: int, filler: bool, window: int = WINDOW) -> list[int]:
    """Lengths of the pieces of ``n`` tokens: whole windows, then the rest, which for
    filler is cut into powers of two."""
    lengths, rest = [window] * (n // window), n % window
    if not filler:
        return lengths + [rest] * (rest > 0)
    return lengths + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]


def token_pieces(docs: DataFrame, path: str, window: int = WINDOW, end: int = END, filler: int = FILLER) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, filler`` of every piece.

    ``doc_tokens`` counts the ids of the text and one ``end``.
    """
    last = int(end).to_bytes(4, "little")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = encoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                rows: list[tuple] = []
                texts = [x or "" for x in part.column(1).to_pylist()]
                for doc, filler_doc, ids in zip(part.column(0).to_pylist(), part.column(2).to_pylist(), tokenizer.encode(texts)):
                    ids += last
                    start, n = 0, len(ids) // 4
                    for length in cut(n, filler_doc, window):
                        crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                        rows.append((doc, start, length, crc, n, filler_doc and length < window))
                        start += length
                columns = [pa.array(c, pa.bool_() if i == 5 else pa.int64()) for i, c in enumerate(zip(*rows))]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "filler"]
                yield pa.RecordBatch.from_arrays(columns, names)

    is_filler = F.pmod(F.xxhash64("doc_id"), F.lit(filler)) == 0
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.coalesce(is_filler, F.lit(False)).alias("filler"))
    return rows.mapInArrow(encode, PIECES)


# the plan


class Run(NamedTuple):
    """``count`` pieces of one length, each at ``offset`` of one of as many sequences."""

    filler: bool
    length: int
    first: int  # number of the first piece within its length
    count: int
    sequence: int  # of the first piece; the others follow
    offset: int
    tier: int
    place: int  # the first sequence's number within its tier


class _Packer:
    def __init__(self, counts: dict[tuple[bool, int], int], window: int):
        self.left = {kind: np.zeros(window + 1, np.int64) for kind in (False, True)}
        for (filler, length), n in counts.items():
            self.left[filler][length] += n
        self.used: dict[tuple[bool, int], int] = {}
        self.runs: list[Run] = []
        self.sequences = 0
        self.in_tier: dict[int, int] = {}

    def longest(self, filler: bool, room: int) -> int:
        """The longest length left that fits, or 0."""
        fits = np.flatnonzero(self.left[filler][: room + 1])
        return int(fits[-1]) if len(fits) and fits[-1] else 0

    def fill(self, windows: int, room: int, content: list[tuple[bool, int]]) -> list[tuple[int, int, list]]:
        """Groups ``windows, room left, content`` of equally filled windows."""
        done, open_ = [], [(windows, room, content)]
        while open_:
            windows, room, content = open_.pop()
            kind, length = False, self.longest(False, room)
            if not length:
                kind, length = True, self.longest(True, room)
            if not length:
                done.append((windows, room, content))
                continue
            n = min(windows, int(self.left[kind][length]))
            self.left[kind][length] -= n
            if n < windows:
                open_.append((windows - n, room, content))
            open_.append((n, room - length, [*content, (kind, length)]))
        return done

    def commit(self, windows: int, content: list[tuple[bool, int]], tier: int) -> None:
        offset, place = 0, self.in_tier.get(tier, 0)
        for kind, length in content:
            first = self.used.get((kind, length), 0)
            self.runs.append(Run(kind, length, first, windows, self.sequences, offset, tier, place))
            self.used[kind, length] = first + windows
            offset += length
        self.sequences += windows
        self.in_tier[tier] = place + windows

    def give_back(self, windows: int, content: list[tuple[bool, int]]) -> None:
        for kind, length in content:
            self.left[kind][length] += windows

    def pack(self, tier: int, lengths: range, also_open: bool) -> None:
        """Windows of the tier that begin with these lengths, longest first."""
        for length in lengths:
            n = int(self.left[False][length])
            if not n:
                continue
            windows = -(-n // (tier // length))
            self.left[False][length] -= windows
            returned = []
            for k, room, content in self.fill(windows, tier - length, [(False, length)]):
                if room == 0 or also_open:
                    self.commit(k, content, tier)
                else:
                    returned.append((k, content))
            for k, content in returned:
                self.give_back(k, content)


def plan_runs(counts: dict[tuple[bool, int], int], window: int = WINDOW, tiers: tuple[int, ...] = TIERS) -> tuple[list[Run], int]:
    """The runs for a histogram of ``(filler, length)``, and the number of sequences."""
    if window & (window - 1):
        raise ValueError(f"the window must be a power of two, not {window}")
    packer = _Packer(counts, window)
    tiers = tuple(t for t in sorted(tiers, reverse=True) if t <= window)
    for tier, shorter in zip(tiers, (*tiers[1:], 0)):
        packer.pack(tier, range(tier, shorter, -1), also_open=tier == window)
    packer.pack(window, range(window, 0, -1), also_open=True)
    # filler alone: powers of two, taken from the longest on, fill windows of these sizes exactly
    total = int((packer.left[True] * np.arange(window + 1)).sum())
    for size in (window >> b for b in range(window.bit_length())):
        if total >= size:
            for k, _, content in packer.fill(total // size, size, []):
                packer.commit(k, content, size)
            total %= size
    return packer.runs, packer.sequences


# placing the pieces


def _numbered(pieces: DataFrame) -> DataFrame:
    """The pieces with ``number``, from 0, among those of their kind and length.

    ``piece`` is a number that the checkpoint has fixed; its upper bits are a slice of the
    table, so that no window holds all the pieces of a length.
    """
    keys = ["filler", "length", "slice"]
    pieces = pieces.withColumn("slice", F.expr("shiftright(piece, 33)"))
    sizes = pieces.groupBy(*keys).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("filler", "length").orderBy("slice")) - F.col("n")
    sizes = sizes.select(*keys, before.alias("before"))
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy("piece")) - 1
    numbered = pieces.withColumn("inside", inside)
    return numbered.join(sizes, keys).withColumn("number", F.col("before") + F.col("inside"))


def pack_pieces(pieces: DataFrame, window: int = WINDOW, tiers: tuple[int, ...] = TIERS, step_tokens: int = STEP_TOKENS) -> DataFrame:
    """``pieces`` with ``sequence_id, offset, tier, step_group``."""
    kept = pieces.columns
    pieces = settle(pieces.withColumn("piece", F.monotonically_increasing_id()))
    histogram = pieces.groupBy("filler", "length").agg(F.count("*").alias("n")).collect()  # 2 * window rows at most
    runs, _ = plan_runs({(r.filler, r.length): r.n for r in histogram}, window, tiers)
    total = sum(r.length * r.n for r in histogram)
    groups = max(1, round(total / step_tokens))
    runs.sort()
    table = np.array(runs, np.int64).reshape(-1, len(Run._fields))
    # kind and length in the upper bits, the number of the run's first piece below
    firsts = ((table[:, 0] << 12 | table[:, 1]) << 48) + table[:, 2]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            kind, length, number = (columns[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("filler", "length", "number"))
            run = np.searchsorted(firsts, ((kind << 12 | length) << 48) + number, "right") - 1
            on = number - table[run, 2]
            added = [table[run, 4] + on, table[run, 5], table[run, 6], (table[run, 7] + on) % groups]
            yield pa.RecordBatch.from_arrays(
                [*(columns[c] for c in kept), *(pa.array(x) for x in added)], [*kept, "sequence_id", "offset", "tier", "step_group"]
            )

    rows = _numbered(pieces).select(*kept, "number")
    schema = ", ".join(f"{name} {kind}" for name, kind in pieces.select(*kept).dtypes)
    return rows.mapInArrow(place, f"{schema}, sequence_id long, offset long, tier long, step_group long")


def pack_documents(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier,
    step_group``, one row per piece.

    A sequence of exactly ``tier`` tokens needs no padding; others are padded to the
    longest window.  A null or empty text is its end alone.  Repeated rows are packed as
    often as they occur; a null ``doc_id`` is carried along; other columns are ignored, and
    no rows give no rows.
    """
    packed = pack_pieces(token_pieces(docs.select("doc_id", "text"), path))
    return packed.drop("filler")
