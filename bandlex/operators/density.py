"""Gaussian kernel density of a score column, and the cut points at its thirds.

The estimate follows the usual practice: the rule-of-thumb bandwidth
``0.9 * min(sd, IQR / 1.34) * n ** -0.2``, 512 points reaching three bandwidths beyond
the data, and values spread linearly over a regular grid before the kernel is applied.
The binning is what makes it scale: what grows with the data are a few plain aggregates,
the largest a grouped sum of at most 512 bins.  The curve itself has 512 rows.
"""

from __future__ import annotations

import math
import sys
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bandlex.operators.quantiles import summarize

POINTS = 512
CUT = 3  # bandwidths between the data and the ends of the curve
MARGIN = 4  # further bandwidths up to the ends of the bins
THIRD = 1.0 / 3.0


class _Grid(NamedTuple):
    n: int
    bw: float
    x0: float  # start and step of the curve
    dx: float
    lo: float  # start and step of the bins
    delta: float


def _grid(values: DataFrame) -> _Grid | None:
    known = summarize(values, "v", (0.25, 0.75))
    if known is None:
        return None
    low, high = known.quantiles
    # a width of zero falls back to the next best measure
    width = min(known.sd, (high - low) / 1.34) or known.sd or abs(known.least) or 1.0
    bw = 0.9 * width * known.n**-0.2
    span, reach = known.most - known.least, (CUT + MARGIN) * bw
    return _Grid(
        known.n,
        bw,
        known.least - CUT * bw,
        (span + 2 * CUT * bw) / (POINTS - 1),
        known.least - reach,
        (span + 2 * reach) / (POINTS - 1),
    )


def _bins(values: DataFrame, grid: _Grid) -> Column:
    """Scalar array of ``(bin, w)``, at most 512 entries: every value gives its weight of
    1 to the two ends of its bin, by nearness."""
    placed = values.select(((F.col("v") - grid.lo) / grid.delta).alias("place"))
    binned = placed.select(F.floor("place").alias("bin"), (F.col("place") - F.floor("place")).alias("part"))
    sums = binned.groupBy("bin").agg(F.count("*").alias("n"), F.sum("part").alias("part"))
    ends = F.array(
        F.struct(F.col("bin"), (F.col("n") - F.col("part")).alias("w")),
        F.struct((F.col("bin") + 1).alias("bin"), F.col("part").alias("w")),
    )
    weights = sums.select(F.explode(ends).alias("end")).groupBy("end.bin").agg(F.sum("end.w").alias("w"))
    return weights.agg(F.array_sort(F.collect_list(F.struct("bin", "w")))).scalar()


def score_density(scores: DataFrame, column: str = "score") -> DataFrame:
    """The curve as rows ``x, density, cdf``, the last one the area up to ``x``.

    It is estimated from the finite values alone, whose mass it describes: a null, NaN or
    infinite one has no place on it.  The bandwidth and the grid are computed when this is
    called, the curve is lazy.
    """
    values = scores.select(F.col(column).cast("double").alias("v")).where(f"abs(v) <= {sys.float_info.max!r}D")
    grid = _grid(values)
    if grid is None:
        return scores.sparkSession.createDataFrame([], "x double, density double, cdf double")
    points = scores.sparkSession.range(POINTS).select(
        (grid.x0 + F.col("id") * grid.dx).alias("x"), _bins(values, grid).alias("bins")
    )
    points = points.withColumn("place", (F.col("x") - grid.lo) / grid.delta)

    def smoothed(place: Column) -> Column:
        """Kernel sum at a point of the bin grid."""

        def add(total: Column, entry: Column) -> Column:
            z = (place - entry["bin"]) * (grid.delta / grid.bw)
            return total + entry["w"] * F.exp(z * z * -0.5)

        return F.aggregate("bins", F.lit(0.0), add) / (grid.n * grid.bw * math.sqrt(2 * math.pi))

    points = points.withColumn("left", smoothed(F.floor("place"))).withColumn("right", smoothed(F.floor("place") + 1))
    density = F.col("left") + (F.col("place") - F.floor("place")) * (F.col("right") - F.col("left"))
    curve = points.select("x", density.alias("density"))
    # one window over the whole curve, which is 512 rows whatever the data
    in_order = Window.orderBy("x")
    area = (F.col("density") + F.lag("density", 1).over(in_order)) / 2 * grid.dx
    curve = curve.withColumn("area", F.coalesce(area, F.lit(0.0)))
    running = F.sum("area").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    return curve.select("x", "density", running.alias("cdf"))


def _stepped(curve: DataFrame, lo: float, hi: float, step: float) -> DataFrame:
    """Area up to each of ``lo, lo + step, ...`` as rows ``x, cdf``.

    Every stretch of the curve yields the steps that fall on it.  The curve is linear
    between its points and constant beyond its ends.
    """
    steps = math.floor((hi - lo) / step + 1e-7)
    in_order = Window.orderBy("x")
    stretch = curve.withColumns(
        {"next_x": F.lead("x").over(in_order), "next_density": F.lead("density").over(in_order), "nth": F.row_number().over(in_order)}
    )
    first = F.when(F.col("nth") == 1, 0).otherwise(F.greatest(F.ceil((F.col("x") - lo) / step), F.lit(0)))
    after = F.coalesce(F.least(F.ceil((F.col("next_x") - lo) / step), F.lit(steps + 1)), F.lit(steps + 1))
    stretch = stretch.withColumns({"first": first, "after": after}).where("after > first")
    rows = stretch.withColumn("k", F.explode(F.sequence(F.col("first"), F.col("after") - 1)))
    x = F.lit(float(lo)) + F.col("k") * float(step)
    run = x - F.col("x")
    slope = F.coalesce((F.col("next_density") - F.col("density")) / (F.col("next_x") - F.col("x")), F.lit(0.0))
    rise = F.when(run > 0, run * slope / 2).otherwise(0.0)
    return rows.select(x.alias("at"), (F.col("cdf") + run * (F.col("density") + rise)).alias("cdf")).withColumnRenamed("at", "x")


def density_thirds(
    scores: DataFrame,
    column: str = "score",
    lo: float | None = None,
    hi: float | None = None,
    step: float | None = None,
) -> DataFrame:
    """One row ``lower, upper``: the first candidate with more than a third of the
    density between ``lo`` and itself, then the first with more than a third between
    ``lower`` and itself.  Null when none is reached.

    Candidates are ``lo, lo + step, ...`` up to ``hi``; without these three, the points
    of the curve.  Thirds are of the finite values.
    """
    candidates = score_density(scores, column)
    if lo is not None and hi is not None and step is not None:
        candidates = _stepped(candidates, lo, hi, step)
    elif not (lo is None and hi is None and step is None):
        raise ValueError("lo, hi and step go together")
    # the area grows with x, so the least area beyond a bound belongs to the first x
    everything = Window.partitionBy()
    span = candidates.withColumn("span", F.col("cdf") - F.min("cdf").over(everything))
    at_lower = F.min(F.when(F.col("span") > THIRD, F.col("span"))).over(everything)
    span = span.withColumn("beyond", F.col("span") - at_lower)
    return span.agg(
        F.min(F.when(F.col("span") > THIRD, F.col("x"))).alias("lower"),
        F.min(F.when(F.col("beyond") > THIRD, F.col("x"))).alias("upper"),
    )
