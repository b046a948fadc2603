"""How far the cut points of a score density can be trusted: a Poisson bootstrap.

A bootstrap replicate counts every score as often as a Poisson number of mean 1 says.  The
density only sees the scores of a cell of its grid together, and the sum of their weights is
a Poisson number of mean ``n``, the number of scores in the cell.  So one weight is drawn per
replicate and cell, at most 512 of them, whatever the number of scores: they are read once.

Weights come from hashes of seed, replicate and cell, so that a run can be repeated
anywhere.  The bandwidth and the grid are those of the data themselves.
"""

from __future__ import annotations

import math
import sys

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bandlex.operators.density import POINTS, THIRD, _grid
from bandlex.plans.settle import settle

REPLICATES = 200
SEED = 42
EXACT = 64  # mean up to which Poisson numbers are drawn by inversion, and beyond by the normal distribution
LONGEST = 200  # of an inverted number; beyond it lies a chance below 1e-38
DIGITS = 13  # hexadecimal digits of a uniform number
LEVEL = 0.95


def uniform(seed: int, *parts: Column | str) -> Column:
    """A number in (0, 1) that depends on the seed and the parts alone."""
    text = F.concat_ws(" ", F.lit(str(seed)), *(p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts))
    whole = F.conv(F.left(F.md5(text.cast("binary")), F.lit(DIGITS)), 16, 10).cast("double")
    return (whole + 0.5) / float(16**DIGITS)


def poisson(mean: Column, first: Column, second: Column) -> Column:
    """A Poisson number of a whole ``mean`` from two uniform numbers."""
    mean = mean.cast("double")
    state = F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("cdf"), F.lit(0.0).alias("k"))

    def step(s: Column, i: Column) -> Column:
        p = s["p"] * mean / i
        return F.struct(p.alias("p"), (s["cdf"] + p).alias("cdf"), (s["k"] + F.when(s["cdf"] < first, 1.0).otherwise(0.0)).alias("k"))

    inverted = F.aggregate(F.sequence(F.lit(1), F.lit(LONGEST)), state, step, lambda s: s["k"])
    z = F.sqrt(-2.0 * F.log(first)) * F.cos(2 * math.pi * second)
    return F.when(mean <= EXACT, inverted).otherwise(F.greatest(F.floor(mean + F.sqrt(mean) * z + 0.5), F.lit(0)).cast("double"))


def _replicate_bins(values: DataFrame, grid, replicates: int, seed: int) -> DataFrame:
    """``replicate, bin, w``; replicate 0 has the data's own weights."""
    place = (F.col("v") - grid.lo) / grid.delta
    cells = values.select(F.floor(place).alias("cell"), (place - F.floor(place)).alias("part"))
    cells = settle(cells.groupBy("cell").agg(F.count("*").alias("n"), F.sum("part").alias("part")))
    drawn = cells.select("*", F.explode(F.sequence(F.lit(0), F.lit(replicates))).alias("replicate"))
    # a number of partitions that stays: there are few rows here, but each becomes many
    drawn = drawn.repartition(int(values.sparkSession.conf.get("spark.sql.shuffle.partitions")), "replicate")
    named = (F.col("replicate"), F.col("cell"))
    # generators of one row: a lambda would make what is below them at each of its steps
    uniforms = F.struct(uniform(seed, "a", *named).alias("a"), uniform(seed, "b", *named).alias("b"))
    drawn = drawn.select("*", F.explode(F.array(uniforms)).alias("u"))
    weight = F.when(F.col("replicate") == 0, F.col("n").cast("double")).otherwise(poisson(F.col("n"), F.col("u.a"), F.col("u.b")))
    drawn = drawn.select("*", F.explode(F.array(weight / F.col("n"))).alias("times"))
    ends = F.array(
        F.struct(F.col("cell").alias("bin"), ((F.col("n") - F.col("part")) * F.col("times")).alias("w")),
        F.struct((F.col("cell") + 1).alias("bin"), (F.col("part") * F.col("times")).alias("w")),
    )
    ends = drawn.select("replicate", F.explode(ends).alias("end"))
    return ends.groupBy("replicate", "end.bin").agg(F.sum("end.w").alias("w"))


def replicate_cuts(scores: DataFrame, column: str = "score", replicates: int = REPLICATES, seed: int = SEED) -> DataFrame:
    """``replicate, lower, upper``: the thirds of the density of every replicate, and of the
    data themselves as replicate 0.  A cut is null where it is not reached."""
    values = scores.select(F.col(column).cast("double").alias("v")).where(f"abs(v) <= {sys.float_info.max!r}D")
    grid = _grid(values)
    if grid is None:
        return scores.sparkSession.createDataFrame([], "replicate int, lower double, upper double")
    bins = _replicate_bins(values, grid, replicates, seed)
    whole = bins.groupBy("replicate").agg(F.sum("w").alias("whole"))
    x = F.col("i") * grid.dx + grid.x0
    place = (x - grid.lo) / grid.delta

    def kernel(at: Column) -> Column:
        z = (at - F.col("bin")) * (grid.delta / grid.bw)
        return F.exp(z * z * -0.5)

    # replicates by bins by points: 512 points whatever the data
    each = bins.where("w > 0").select("replicate", "bin", "w", F.explode(F.sequence(F.lit(0), F.lit(POINTS - 1))).alias("i"))
    part = place - F.floor(place)
    height = F.col("w") * ((1 - part) * kernel(F.floor(place)) + part * kernel(F.floor(place) + 1))
    curve = each.groupBy("replicate", "i").agg(F.sum(height).alias("height")).join(F.broadcast(whole), "replicate")
    curve = curve.withColumn("density", F.col("height") / (F.col("whole") * (grid.bw * math.sqrt(2 * math.pi))))
    in_order = Window.partitionBy("replicate").orderBy("i")
    area = (F.col("density") + F.lag("density", 1).over(in_order)) / 2 * grid.dx
    curve = curve.withColumn("area", F.coalesce(area, F.lit(0.0)))
    curve = curve.withColumn("cdf", F.sum("area").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    everything = Window.partitionBy("replicate")
    at_lower = F.min(F.when(F.col("cdf") > THIRD, F.col("cdf"))).over(everything)
    curve = curve.withColumns({"x": x, "beyond": F.col("cdf") - at_lower})
    return curve.groupBy("replicate").agg(
        F.min(F.when(F.col("cdf") > THIRD, F.col("x"))).alias("lower"),
        F.min(F.when(F.col("beyond") > THIRD, F.col("x"))).alias("upper"),
    )


def cut_stability(
    scores: DataFrame, column: str = "score", replicates: int = REPLICATES, seed: int = SEED, level: float = LEVEL
) -> DataFrame:
    """``cut, value, low, high, mean, sd, undefined``: for the lower and the upper cut point its
    value, the interval that ``level`` of the replicates fall in, their mean and standard
    deviation, and the number of replicates that have no such cut.

    Scores that are null, NaN or infinite have no place on the density; without others there
    are no rows.  A cut as wide as its interval is no sharper than that.
    """
    cuts = settle(replicate_cuts(scores, column, replicates, seed))
    both = F.explode(F.array(*(F.struct(F.lit(c).alias("cut"), F.col(c).alias("at")) for c in ("lower", "upper")))).alias("c")
    rows = cuts.select("replicate", both).select("replicate", "c.*")
    drawn = F.when(F.col("replicate") > 0, F.col("at"))
    edge = (1 - level) / 2
    return rows.groupBy("cut").agg(
        F.max(F.when(F.col("replicate") == 0, F.col("at"))).alias("value"),
        F.percentile(drawn, edge).alias("low"),
        F.percentile(drawn, 1 - edge).alias("high"),
        F.avg(drawn).alias("mean"),
        F.stddev_samp(drawn).alias("sd"),
        F.count(F.when((F.col("replicate") > 0) & F.col("at").isNull(), 1)).alias("undefined"),
    )
