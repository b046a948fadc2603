"""Exact quantiles of a column of any size."""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACCURACY = 10_000
MARGIN = 0.0005  # more than the error of 1 / ACCURACY on either side
CELLS = 4096  # that a bracket is cut into


class Summary(NamedTuple):
    n: int
    least: float
    most: float
    sd: float
    quantiles: tuple[float, ...]


class _Bracket(NamedTuple):
    """Values between which the one at ``rank`` (from 0, in ascending order) lies."""

    rank: int
    lo: float
    hi: float


def _cell(bracket: _Bracket) -> Column:
    """The number of a value's cell: -1 below the bracket, null above.

    Cells are of equal width, so the first and the last hold the ends of the bracket.
    Halves keep the width of a bracket finite.
    """
    scale = bracket.hi / 2 - bracket.lo / 2
    place = (F.col("v") / 2 - bracket.lo / 2) / scale * CELLS if scale > 0 else F.lit(0.0)
    inside = F.least(F.floor(place).cast("int"), F.lit(CELLS - 1))
    return F.when(F.col("v") < bracket.lo, -1).when(F.col("v") <= bracket.hi, inside)


def _order_statistics(data: DataFrame, brackets: list[_Bracket], least: float, most: float) -> dict[int, float]:
    """The values at the ranks of the brackets.

    Every step counts the values in each cell of each bracket, which are combined before
    the shuffle to at most ``CELLS`` rows per bracket, and goes on with the least and
    greatest value of the cell that holds the rank, until they are one.  A bracket that
    turns out not to hold its rank is widened to all values.
    """
    found: dict[int, float] = {}
    while brackets:
        marks = F.array(*(F.struct(F.lit(i).alias("i"), _cell(b).alias("cell")) for i, b in enumerate(brackets)))
        cells = data.select("v", F.explode(marks).alias("m")).where("m.cell is not null").groupBy("m.i", "m.cell")
        cells = cells.agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        rows = sorted(cells.collect(), key=lambda r: (r.i, r.cell))
        narrower = []
        for i, bracket in enumerate(brackets):
            so_far, holds = 0, None
            for r in (r for r in rows if r.i == i):
                so_far += r.n
                if so_far > bracket.rank:
                    holds = r
                    break
            if holds is None or holds.cell < 0:
                narrower.append(_Bracket(bracket.rank, least, most))
            elif holds.lo == holds.hi:
                found[bracket.rank] = holds.lo
            elif (holds.lo, holds.hi) == (bracket.lo, bracket.hi):
                # neighbours too close for cells: one of the two ends
                at_lo = data.where(F.col("v") <= bracket.lo).count()
                found[bracket.rank] = bracket.lo if at_lo > bracket.rank else bracket.hi
            else:
                narrower.append(_Bracket(bracket.rank, holds.lo, holds.hi))
        brackets = narrower
    return found


def summarize(values: DataFrame, column: str, probs: Sequence[float]) -> Summary | None:
    """Size, range, sample deviation and exact quantiles; None without any value.

    Quantiles interpolate linearly between the two nearest order statistics.  Approximate
    quantiles on either side bracket each wanted one; brackets are then narrowed by
    counting in cells, usually once or twice.  No task sorts or ranks the column.
    """
    data = values.select(F.col(column).alias("v"))

    def at(shift: float) -> list[float]:
        return [min(1.0, max(0.0, p + shift)) for p in probs]

    first = data.agg(
        F.count("*").alias("n"),
        F.min("v").alias("least"),
        F.max("v").alias("most"),
        F.stddev_samp("v").alias("sd"),
        F.percentile_approx("v", at(-MARGIN), ACCURACY).alias("below"),
        F.percentile_approx("v", at(MARGIN), ACCURACY).alias("above"),
    ).first()
    if not first.n:
        return None
    places = [(first.n - 1) * p for p in probs]
    brackets = {}
    for place, lo, hi in zip(places, first.below, first.above):
        for rank in (math.floor(place), math.ceil(place)):
            brackets[rank] = _Bracket(rank, lo, hi)
    found = _order_statistics(data, list(brackets.values()), first.least, first.most)
    quantiles = []
    for place in places:
        lower, upper = found[math.floor(place)], found[math.ceil(place)]
        quantiles.append(lower + (place - math.floor(place)) * (upper - lower))
    return Summary(first.n, first.least, first.most, first.sd or 0.0, tuple(quantiles))
