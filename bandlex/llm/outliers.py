"""Quality rules: counts of a text, and robust multivariate outliers among them.

The counts of every text become a vector of five transformed statistics.  For every
language and source, the minimum-covariance-determinant (MCD) estimate of the vectors'
mean and covariance describes what is usual there, and a document far from it by its
Mahalanobis distance is rejected.

All of it is aggregation.  A concentration step of the MCD takes the ``share`` of a group
with the smallest distances and estimates anew from these.  Here the distances are counted
in narrow bins, with the sums for a mean and a covariance kept for each bin; the bins up to
the one that completes the share are added up.  Rows are combined before the shuffle to a
few hundred bins per group, so a group with a third of all rows is as good as any other,
and no distances are sorted.  Vectors are whole multiples of ``1 / UNIT`` and their sums
whole numbers: results do not depend on the order of rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bandlex.llm.shared import DIGEST, SPACE, one_row, row_digest, settle, without_rows, words
from bandlex.operators.lookup import join_lookup

MIN_WORDS = 50
MAX_REPEATED = 0.5
WINDOW = 3  # words of a repeated window

UNIT = 512  # vectors are whole multiples of 1 / UNIT
#: Standard deviation that is added to each statistic's own: what differs by less is not odd.
SLACK = (0.08, 0.4, 0.35, 0.35, 0.6)
N_STATISTICS = len(SLACK)
SHARE = 0.75  # of a group's rows that the determinant is minimised over
MIN_ROWS = 50  # of a group that has its own estimate
TRIAL_STEPS = 2  # concentration steps from every start
MORE_STEPS = 3  # further ones from the best
WEIGHT_LEVEL = 0.975  # quantile up to which rows are used for the final estimate
ALPHA = 3e-4  # chance at which a row of a normal group would be rejected
BINS_PER_OCTAVE = 16
MAX_OCTAVE = 12

# Fixed value: the characters that count as symbols, as a regular expression's set.
SYMBOLS = r"#*$%&|<>"
MARKS = r"!\"'()+,\-./:;=?@\[\\\]\^_`{}~"
GROUP = "g"


# counts


def _count(text: Column, kind: str) -> Column:
    """Characters of a class, as a regular expression's set."""
    return F.length(F.regexp_replace(text, f"[^{kind}]+", "")).cast("long")


def _repeat_words(ordered: Column) -> Column:
    """Words covered by the windows whose key occurs more than once.  ``ordered`` holds a
    ``key`` and ``place`` for each window, in ascending order; equal keys are neighbours."""

    def repeated(x: Column, i: Column) -> Column:
        before, after = F.get(ordered, i - 1), F.get(ordered, i + 1)
        return F.coalesce(before["key"] == x["key"], F.lit(False)) | F.coalesce(after["key"] == x["key"], F.lit(False))

    places = F.transform(F.filter(ordered, repeated), lambda x: x["place"])
    state = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        F.sort_array(places),
        state,
        lambda s, at: F.struct(at.alias("last"), (s["n"] + F.least(F.lit(WINDOW), at - s["last"])).alias("n")),
        lambda s: s["n"],
    )


def text_counts(docs: DataFrame) -> DataFrame:
    """``docs`` without its text, with ``n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words`` and, for the statistics, ``n_capitals, n_marks``; all long.

    Words are separated by ASCII white space.  ``n_dup_lines`` counts lines with a word
    that equal an earlier line, ``n_repeat_words`` the words in windows of three words
    that occur twice or more.  A null text counts as empty.  Windows are compared by
    64-bit hashes, which for a text of five million different words errs in one text of a
    million.
    """
    others = [c for c in docs.columns if c != "text"]
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(*others, one_row(text=text, words=words("text"), lines=F.split(text, "\n")))
    n = F.size("words")
    key = F.xxhash64
    windows = F.transform(
        F.sequence(F.lit(0), F.greatest(n - WINDOW, F.lit(0))),
        lambda i: F.struct(key(*(F.get("words", i + j) for j in range(WINDOW))).alias("key"), i.alias("place")),
    )
    rows = rows.select(
        *others,
        "words",
        one_row(
            n_words=n.cast("long"),
            word_chars=F.length(F.regexp_replace("text", SPACE, "")).cast("long"),
            n_symbols=_count(F.col("text"), SYMBOLS),
            n_capitals=_count(F.col("text"), r"\p{Lu}"),
            n_marks=_count(F.col("text"), MARKS),
            lines=F.filter("lines", lambda line: line.rlike(r"[^\x20\x09-\x0D]")),
            windows=F.when(n >= WINDOW, windows).otherwise(F.array().cast("array<struct<key: bigint, place: int>>")),
        ),
    ).drop("words")
    counts = [c for c in rows.columns if c not in (*others, "lines", "windows")]
    rows = rows.select(
        *others,
        *counts,
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        one_row(ordered=F.sort_array("windows")),
    )
    return rows.select(*others, *counts, "n_dup_lines", _repeat_words(F.col("ordered")).alias("n_repeat_words"))


def base_failed() -> Column:
    """Too short, or mostly repetition."""
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * int(100 * MAX_REPEATED))


def statistics() -> list[Column]:
    """The vector: logarithms of the word length and of the rates of symbols, capitals,
    punctuation and repetition.  A rate is one of a text somewhat longer than it is, and
    starts from a small constant, so that neither short texts nor zeros stand out."""
    chars, n_words = F.col("word_chars") + 100, F.col("n_words") + 20

    def rate(n: str, of: Column, least: float) -> Column:
        return F.log(F.col(n) / of + least)

    values = [
        F.log((F.col("word_chars") + 1) / (F.col("n_words") + 1)),
        rate("n_symbols", chars, 0.003),
        rate("n_capitals", chars, 0.01),
        rate("n_marks", chars, 0.01),
        rate("n_repeat_words", n_words, 0.05),
    ]
    return [F.round(v * UNIT).cast("long").alias(f"x{i}") for i, v in enumerate(values)]


# the chi-square distribution


def chi2_cdf(x: float, k: float) -> float:
    """By the series of the incomplete gamma function."""
    a, x = k / 2, x / 2
    term = total = 1 / a
    n = 0
    while term > total * 1e-16:
        n += 1
        term *= x / (a + n)
        total += term
    return total * math.exp(a * math.log(x) - x - math.lgamma(a)) if x > 0 else 0.0


def chi2_quantile(p: float, k: float) -> float:
    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(mid, k) < p else (lo, mid)
    return hi


def consistency(share: float, k: int) -> float:
    """What the covariance of the nearest ``share`` of a normal group is short by."""
    return share / chi2_cdf(chi2_quantile(share, k), k + 2)


# estimates

D = N_STATISTICS
X = [f"x{i}" for i in range(D)]
MEANS = [f"m{i}" for i in range(D)]
PAIRS = [(i, j) for i in range(D) for j in range(i + 1)]
COVARIANCES = [f"c{i}{j}" for i, j in PAIRS]
WEIGHTS = [f"w{i}{j}" for i, j in PAIRS]  # the inverse of the covariance's Cholesky factor
SUMS = ["n", *(f"s_{x}" for x in X), *(f"s_{c}" for c in COVARIANCES)]


def _sums() -> list[Column]:
    values = [F.lit(1), *X, *(F.col(X[i]) * F.col(X[j]) for i, j in PAIRS)]
    return [F.sum(v).alias(name) for v, name in zip(values, SUMS)]


def _with_moments(sums: DataFrame, factor: float) -> DataFrame:
    """Means, and covariances times ``factor``, from the sums."""
    n = F.col("n").cast("double")
    means = {m: F.col(f"s_{x}") / n for m, x in zip(MEANS, X)}
    products = {c: F.col(f"s_{c}") / n for c in COVARIANCES}
    sums = sums.withColumns(means).withColumns(products)
    return sums.withColumns(
        {c: (F.col(c) - F.col(MEANS[i]) * F.col(MEANS[j])) * factor for c, (i, j) in zip(COVARIANCES, PAIRS)}
    )


def _with_weights(estimates: DataFrame) -> DataFrame:
    """The columns that turn a vector into its distance, and ``log_det``.

    The slack is added to the variances, so that a statistic that is constant in most of
    a group does not make every other value infinitely far.
    """
    rows = estimates.withColumns(
        {f"c{i}{i}": F.greatest(F.col(f"c{i}{i}"), F.lit(0.0)) + (s * UNIT) ** 2 for i, s in enumerate(SLACK)}
    )
    for j in range(D):
        pivot = F.col(f"c{j}{j}")
        for k in range(j):
            pivot = pivot - F.col(f"l{j}{k}") * F.col(f"l{j}{k}")
        rows = rows.withColumn(f"l{j}{j}", F.sqrt(F.greatest(pivot, F.lit(1e-6))))
        below = {}
        for i in range(j + 1, D):
            value = F.col(f"c{i}{j}")
            for k in range(j):
                value = value - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            below[f"l{i}{j}"] = value / F.col(f"l{j}{j}")
        rows = rows.withColumns(below) if below else rows
    for i in range(D):
        row = {f"w{i}{i}": 1 / F.col(f"l{i}{i}")}
        for j in range(i):
            value = sum((F.col(f"l{i}{k}") * F.col(f"w{k}{j}") for k in range(j, i)), F.lit(0.0))
            row[f"w{i}{j}"] = -value / F.col(f"l{i}{i}")
        rows = rows.withColumns(row)
    log_det = sum((F.log(f"l{i}{i}") for i in range(D)), F.lit(0.0)) * 2
    keep = [c for c in estimates.columns if c in (GROUP, "start")]
    return rows.select(*keep, *MEANS, *WEIGHTS, log_det.alias("log_det"))


def _distance() -> Column:
    """Squared Mahalanobis distance of the vector."""
    total = F.lit(0.0)
    for i in range(D):
        y = sum((F.col(f"w{i}{j}") * (F.col(X[j]) - F.col(MEANS[j])) for j in range(i + 1)), F.lit(0.0))
        total = total + y * y
    return total


def _quartiles(vectors: DataFrame) -> DataFrame:
    """``g`` with ``q10, q20, q30, ...`` for every statistic, the quartiles within 1/64."""
    coarse = UNIT // 64
    cells = F.array(*(F.struct(F.lit(i).alias("i"), F.floor(F.col(x) / coarse).alias("bin")) for i, x in enumerate(X)))
    counts = vectors.select(GROUP, F.explode(cells).alias("c")).groupBy(GROUP, "c.i", "c.bin").agg(F.count("*").alias("n"))
    by_bin = Window.partitionBy(GROUP, "i").orderBy("bin")
    counts = counts.withColumns(
        {"upto": F.sum("n").over(by_bin), "total": F.sum("n").over(Window.partitionBy(GROUP, "i"))}
    )
    found = []
    for i in range(D):
        for q in (1, 2, 3):
            inside = (F.col("i") == i) & (F.col("upto") * 4 >= F.col("total") * q)
            found.append((F.min(F.when(inside, F.col("bin"))) * coarse + coarse // 2).alias(f"q{q}{i}"))
    return counts.groupBy(GROUP).agg(*found)


def _starts(vectors: DataFrame) -> DataFrame:
    """Three starting estimates for each group, all around its medians: the statistics
    apart, the covariance of their hyperbolic tangents, and that of their directions."""
    quartiles = settle(_quartiles(vectors))
    rows = join_lookup(vectors, quartiles, GROUP, "inner")
    scale = [F.greatest((F.col(f"q3{i}") - F.col(f"q1{i}")) / 1.349, F.lit(SLACK[i] * UNIT)) for i in range(D)]
    rows = rows.withColumns({f"z{i}": (F.col(X[i]) - F.col(f"q2{i}")) / scale[i] for i in range(D)})
    length = sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(D)), F.lit(1e-9))
    rows = rows.withColumns({f"t{i}": F.tanh(f"z{i}") for i in range(D)} | {"length": length})
    fixed = 1 << 20  # whole numbers again, for sums that do not depend on the order
    sums = [F.count("*").alias("n")]
    for i, j in PAIRS:
        sums.append(F.sum(F.round(F.col(f"t{i}") * F.col(f"t{j}") * fixed).cast("long")).alias(f"t_{i}{j}"))
        sums.append(F.sum(F.round(F.col(f"z{i}") * F.col(f"z{j}") / F.col("length") * fixed).cast("long")).alias(f"d_{i}{j}"))
    sums = join_lookup(rows.groupBy(GROUP).agg(*sums), quartiles, GROUP, "inner")

    def entry(kind: str, i: int, j: int) -> Column:
        if kind == "apart":
            part = F.lit(1.0 if i == j else 0.0)
        else:
            part = F.col(f"{kind}_{i}{j}") / F.sqrt(F.col(f"{kind}_{i}{i}").cast("double") * F.col(f"{kind}_{j}{j}") + 1.0)
        return (part * scale[i] * scale[j]).alias(f"c{i}{j}")

    means = [F.col(f"q2{i}").cast("double").alias(MEANS[i]) for i in range(D)]
    options = [
        F.struct(F.lit(start).alias("start"), *means, *(entry(kind, i, j) for i, j in PAIRS))
        for start, kind in enumerate(("apart", "t", "d"))
    ]
    starts = sums.select(GROUP, F.explode(F.array(*options)).alias("e")).select(GROUP, "e.*")
    return _with_weights(starts)


def _with_distances(vectors: DataFrame, estimates: DataFrame) -> DataFrame:
    return join_lookup(vectors, estimates, GROUP, "inner").withColumn("d2", _distance())


def _concentrate(vectors: DataFrame, estimates: DataFrame, share: float) -> DataFrame:
    """One concentration step for every group and start."""
    keys = [GROUP, "start"]
    octave = F.log2(F.least(F.greatest(F.col("d2"), F.lit(0.25)), F.lit(2.0**MAX_OCTAVE)))
    rows = _with_distances(vectors, estimates).withColumn("bin", F.floor(octave * BINS_PER_OCTAVE))
    bins = rows.groupBy(*keys, "bin").agg(*_sums())
    whole = Window.partitionBy(*keys)
    before = F.sum("n").over(whole.orderBy("bin")) - F.col("n")
    inside = bins.withColumns({"before": before, "total": F.sum("n").over(whole)}).where(F.col("before") < F.col("total") * share)
    sums = inside.groupBy(*keys).agg(*(F.sum(s).alias(s) for s in SUMS))
    return settle(_with_weights(_with_moments(sums, 1.0)))


def mcd_estimates(vectors: DataFrame, share: float = SHARE) -> DataFrame:
    """Mean and covariance (as weights) of each group of ``vectors`` (``g, x0, ...``),
    reweighted once.  ``vectors`` is read about ten times: pass a settled table."""
    estimates = settle(_starts(vectors))
    for step in range(TRIAL_STEPS + MORE_STEPS):
        estimates = _concentrate(vectors, estimates, share)
        if step == TRIAL_STEPS - 1:
            rest = [c for c in estimates.columns if c != GROUP]
            best = estimates.groupBy(GROUP).agg(F.min(F.struct("log_det", *(c for c in rest if c != "log_det"))).alias("e"))
            estimates = settle(best.select(GROUP, *(F.col(f"e.{c}").alias(c) for c in rest)))
    bound = chi2_quantile(WEIGHT_LEVEL, D) * consistency(share, D)
    near = _with_distances(vectors, estimates).where(F.col("d2") <= bound)
    sums = near.groupBy(GROUP).agg(*_sums())
    return settle(_with_weights(_with_moments(sums, consistency(WEIGHT_LEVEL, D))))


def _group_keys(counts: DataFrame, min_rows: int) -> DataFrame:
    """``own, g``: every language and source has its own estimate, or that of the language's
    small sources together, or that of all that is still small; ``g`` is null where even
    these are too few."""
    small = F.col("n") < min_rows
    pools = settle(counts.where(small).groupBy("lang").agg(F.sum("n").alias("pool")))
    rest = pools.where(F.col("pool") < min_rows).agg(F.coalesce(F.sum("pool"), F.lit(0)).alias("rest"))
    pool = F.when(F.col("pool") >= min_rows, F.concat("lang", F.lit("\x1f*\x1f"))).when(
        rest.scalar() >= min_rows, F.lit("\x1f*\x1f")
    )
    return counts.join(pools, "lang", "left").select("own", F.when(~small, F.col("own")).otherwise(pool).alias(GROUP))


def quality_verdicts(
    docs: DataFrame, alpha: float = ALPHA, share: float = SHARE, min_rows: int = MIN_ROWS, carry: tuple[str, ...] = ()
) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept, distance``, ``lang, source`` and the columns to ``carry``; one row per row of
    ``docs``.

    A row that fails the base rules is not kept.  Of the others, a row is rejected when
    its squared distance from its group's estimate exceeds the chi-square quantile at
    ``1 - alpha``.  Groups are languages and sources, a null counting as an empty string;
    sources of fewer than ``min_rows`` rows share the estimate of their language's small
    ones, languages with few of these one more, and where even these are too few,
    ``distance`` is null and the row kept.  Null and
    empty texts have no words and fail.  Repeated rows are judged alike; other columns are
    ignored, and no rows give no rows.
    """
    lang, source = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("lang", "source"))
    rows = text_counts(docs.select("doc_id", lang.alias("lang"), source.alias("source"), "text", *carry))
    rows = rows.withColumns({"own": F.concat_ws("\x1f", "lang", "source"), "base_failed": base_failed()})
    rows = settle(rows.select("*", *statistics()))
    judged = rows.where(~F.col("base_failed"))
    keys = settle(_group_keys(judged.groupBy("own", "lang").agg(F.count("*").alias("n")), min_rows))
    vectors = settle(join_lookup(judged.select("own", *X), keys.where("g is not null"), "own", "inner").drop("own"))
    estimates = join_lookup(keys, mcd_estimates(vectors, share), GROUP, "inner")
    found = join_lookup(rows, settle(estimates.drop(GROUP)), "own", "left")
    distance = F.when(~F.col("base_failed"), _distance())
    bound = chi2_quantile(1 - alpha, D)
    return found.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & F.coalesce(distance <= bound, F.lit(True))).alias("kept"),
        F.round(F.sqrt(distance), 4).alias("distance"),
        "lang",
        "source",
        *carry,
    )


def drop_rejected(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns as they are, whatever their
    names.  Null and empty texts go; repeated rows stay or go together; no rows give none."""
    docs = docs.withColumn(DIGEST, row_digest("text", "lang", "source"))
    verdicts = settle(quality_verdicts(docs, carry=(DIGEST,), **options))
    return without_rows(docs, verdicts.where(~F.col("kept")), verdicts.limit(0))
