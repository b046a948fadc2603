"""Mixing documents to target shares of domains they belong to in part.

A naive Bayes classifier, fitted on the table of labels, gives every document a posterior
over the domains.  Each document gets a rate, the number of times it should be taken, such
that the expected tokens of every domain match its target:

    minimise  sum_k (sum_i w_i p_ik r_i - t_k)^2 / c_k  +  ridge * sum_i w_i (r_i - 1)^2
    over      0 <= r_i <= max_rate

where ``w`` are shares of all tokens and ``c`` evens out small and large domains; there is
no upper bound unless one is given.  A domain of less than a quarter of its target has its
own share as ``c``, so that the ridge does not hold it back and few steps reach it.  The
ridge draws rates to 1, among the many that match.  Targets that are missed are reported.  This is solved by accelerated projected
gradient steps.  A step of document i depends on its own posterior and on one residual per
domain, which are sums over all documents.  So the driver keeps the residuals of the steps
so far, a few numbers, and a rate is their function: no state is stored for documents.
Posteriors are whole thousandths, and documents of one posterior are summed up beforehand.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bandlex.llm.shared import PRIVATE, bring_back, one_row, set_aside, settle, words

#: Domains as conditions on the labels.
DOMAINS = {"good": "quality = 1 AND toxic = 0", "toxic": "toxic = 1", "poor": "quality = 0 AND toxic = 0"}
WEIGHTS = {"good": 0.9, "toxic": 0.04, "poor": 0.06}
FIT_ROWS = 20_000  # labelled rows the classifier is fitted on, by a hash of their id
VOCABULARY = 400  # words it looks at
MIN_DOCS = 3  # labelled documents of a word
MIN_CHI2 = 20.0  # of a word's table with a domain
ABSENCE = 0.2  # weight of the words that are missing, which depend on each other
MAX_RATE = math.inf
RARE = 0.25  # a domain below this part of its target
MISSED = 0.02  # part of a target by which totals may miss it unreported
RIDGE = 1e-3
MAX_STEPS = 60
TOLERANCE = 1e-6
SCALE = 1000  # posteriors are whole multiples of 1 / SCALE
WORDS, PRESENT, SCORE, ODDS, COPY = (f"{name}_{PRIVATE}" for name in ("words", "present", "score", "odds", "copy"))


class Classifier(NamedTuple):
    domains: tuple[str, ...]
    base: tuple[float, ...]  # log odds of a document with none of the words
    weights: dict[str, tuple[float, ...]]  # what a word adds


def labelled(labels: DataFrame, domains: Mapping[str, str] = DOMAINS, rows: int = FIT_ROWS) -> DataFrame:
    """``doc_id, domain`` of at most ``rows`` labelled documents, the same ones each time.

    Of several labels of a document the larger count, label by label; incomplete labels
    and combinations without a domain are left out.
    """
    named = F.lit(None).cast("string")
    for name, condition in domains.items():
        named = F.when(F.expr(condition), F.lit(name)).otherwise(named)
    whole = labels.where("doc_id is not null and quality is not null and toxic is not null")
    one = whole.groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    return one.select("doc_id", named.alias("domain")).dropna().orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def features(words: Column) -> Column:
    """The distinct words, and one that tells which tenth of the words is distinct."""
    distinct = F.array_distinct(words)
    tenth = F.floor(F.size(distinct) * 10 / F.greatest(F.size(words), F.lit(1))).cast("string")
    return F.array_append(distinct, F.concat(F.lit("distinct tenths "), tenth))


def fit_classifier(
    docs: DataFrame,
    labels: DataFrame,
    domains: Mapping[str, str] = DOMAINS,
    fit_rows: int = FIT_ROWS,
    vocabulary: int = VOCABULARY,
) -> Classifier:
    """Naive Bayes over the presence of words, of the ``vocabulary`` words that tell one domain
    from the rest best (by chi-square).  Without labels every domain is as likely."""
    names = tuple(domains)
    sample = F.broadcast(labelled(labels, domains, fit_rows))  # of fit_rows rows at most
    found = docs.select("doc_id", "text").join(sample, "doc_id")
    found = found.select("domain", one_row(**{WORDS: words(F.lower("text"))}))
    found = found.select("domain", features(F.col(WORDS)).alias("words"))
    sizes = {r.domain: r.n for r in found.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    n = [sizes.get(name, 0) for name in names]
    total = sum(n)
    counts = found.select("domain", F.explode("words").alias("word")).groupBy("word")
    counts = counts.agg(*(F.count(F.when(F.col("domain") == name, 1)).alias(f"n_{k}") for k, name in enumerate(names)))
    df = sum((F.col(f"n_{k}") for k in range(len(names))), F.lit(0))
    score = F.lit(0.0)
    for k in range(len(names)):
        # of the 2 x 2 table of the word and the domain, where the word speaks for the domain
        gain = F.col(f"n_{k}") * float(total) - F.col("df") * float(n[k])
        spread = F.col("df") * (total - F.col("df")) * float(n[k] * (total - n[k]))
        chi2 = F.when((gain > 0) & (spread > 0), gain * gain * float(total) / spread).otherwise(0.0)
        score = F.greatest(score, chi2)
    best = counts.withColumn("df", df).where(F.col("df") >= MIN_DOCS).withColumn("score", score)
    rows = best.where(F.col("score") > MIN_CHI2).orderBy(F.desc("score"), "word").limit(vocabulary).collect()
    base = [math.log((x + 1) / (total + len(names))) for x in n]
    weights = {}
    for r in rows:
        in_all = (r.df + 0.5) / (total + 1)
        shares = [(r[f"n_{k}"] + 0.5) / (x + 1) for k, x in enumerate(n)]
        weights[r.word] = tuple(math.log(share / in_all) for share in shares)
        base = [b + ABSENCE * math.log((1 - share) / (1 - in_all)) for b, share in zip(base, shares)]
    return Classifier(names, tuple(base), weights)


def with_posteriors(docs: DataFrame, model: Classifier) -> DataFrame:
    """``docs`` with ``n_tokens`` (its words) and ``p``, an array of one whole number for
    each domain that add up to ``SCALE``.  A null text counts as empty."""
    count = len(model.domains)
    table = [F.struct(F.lit(w).alias("key"), F.array(*map(F.lit, x)).alias("value")) for w, x in model.weights.items()]
    vocabulary = F.array(*map(F.lit, model.weights)) if table else F.array().cast("array<string>")
    base = F.array(*map(F.lit, model.base))
    rows = docs.select("*", one_row(**{WORDS: words(F.lower("text"))}))
    rows = rows.select(
        *docs.columns,
        one_row(**{"n_tokens": F.size(WORDS).cast("long"), PRESENT: F.array_intersect(features(F.col(WORDS)), vocabulary)}),
    )
    score = base
    if table:
        lookup = F.map_from_entries(F.array(*table))
        score = F.aggregate(PRESENT, base, lambda s, w: F.zip_with(s, F.element_at(lookup, w), lambda a, b: a + b))
    rows = rows.select(*docs.columns, "n_tokens", one_row(**{SCORE: score}))
    odds = F.transform(SCORE, lambda s: F.exp(s - F.array_max(SCORE)))
    rows = rows.select(*docs.columns, "n_tokens", one_row(**{ODDS: odds}))
    sums = [sum((F.get(ODDS, k) for k in range(upto)), F.lit(0.0)) for upto in range(count + 1)]
    # whole parts that add up exactly: differences of rounded sums
    upto = [F.round(s / sums[-1] * SCALE).cast("int") for s in sums]
    return rows.select(*docs.columns, "n_tokens", F.array(*(upto[k + 1] - upto[k] for k in range(count))).alias("p"))


class Rates(NamedTuple):
    """What turns a posterior into a rate: the steps' residuals and momentum."""

    steps: list[tuple[float, ...]]
    ridge: float
    max_rate: float
    totals: tuple[float, ...] = ()  # expected tokens of every domain, as shares of all tokens there are
    targets: tuple[float, ...] = ()
    converged: bool = True

    def _state(self) -> Column:
        """Rate and extrapolated rate after the steps so far, of the column ``p``."""
        state = F.struct(F.lit(1.0).alias("r"), F.lit(1.0).alias("y"))
        if not self.steps:
            return state
        steps = F.expr("array(%s)" % ", ".join("array(%s)" % ", ".join(f"{x!r}D" for x in step) for step in self.steps))

        def step(s: Column, of: Column) -> Column:
            parts = (F.get(of, k + 1) * F.get("p", k) / SCALE for k in range(len(self.steps[0]) - 1))
            slope = sum(parts, self.ridge * (s["y"] - 1))
            moved = F.least(F.greatest(s["y"] - slope / (1 + self.ridge), F.lit(0.0)), F.lit(self.max_rate))
            return F.struct(moved.alias("r"), (moved + F.get(of, 0) * (moved - s["r"])).alias("y"))

        return F.aggregate(steps, state, step)

    def rate(self) -> Column:
        return F.round(self._state()["r"], 6)


def _sums(cells: DataFrame, count: int, *factors: Column) -> list[list[float]]:
    """Tokens of every domain, once for each factor."""
    columns = [F.sum(F.col("tokens") * F.get("p", k) / SCALE * f).alias(f"s{k}_{i}") for i, f in enumerate(factors) for k in range(count)]
    row = [float(x or 0.0) for x in cells.agg(*columns).first()]
    return [row[i : i + count] for i in range(0, len(row), count)]


def fit_rates(
    rows: DataFrame,
    domains: Sequence[str],
    weights: Mapping[str, float] = WEIGHTS,
    keep_whole: str | None = None,
    max_rate: float = MAX_RATE,
    ridge: float = RIDGE,
    max_steps: int = MAX_STEPS,
) -> Rates:
    """Rates for ``rows`` with ``p`` and ``n_tokens``.

    Targets are ``weights``, which are made to add up to 1, of the present number of
    tokens; with ``keep_whole``, of the number for which that domain keeps the tokens it
    has.  Without any tokens all rates are 1.  A warning names the domains whose expected
    totals miss their targets, and says if the steps ended before the rates settled.
    """
    cells = settle(rows.groupBy("p").agg(F.sum("n_tokens").alias("tokens")).where("tokens > 0"))
    [now] = _sums(cells, len(domains), F.lit(1.0))
    total, given = sum(now), sum(weights.values())
    found = Rates([], ridge, float(max_rate))
    if not total or not given:
        return found
    mass = [x / total for x in now]
    targets = [weights.get(name, 0.0) / given for name in domains]
    if keep_whole is not None:
        k = list(domains).index(keep_whole)
        targets = [t * mass[k] / targets[k] for t in targets]
    evening = [(m if 0 < m < RARE * t else max(m, t)) or 1.0 for m, t in zip(mass, targets)]
    before, lowest, momentum = None, math.inf, 1.0
    converged = False
    for left in range(max_steps, -1, -1):
        state = cells.withColumn("s", found._state()).withColumn("off", (F.col("s.r") - 1) * (F.col("s.r") - 1))
        at_y, at_r, off = _sums(state, len(domains), F.col("s.y"), F.col("s.r"), F.col("off"))
        value = sum((s / total - t) ** 2 / c for s, t, c in zip(at_r, targets, evening)) + ridge * sum(off) / total
        if value > lowest:  # too much momentum: go on from the rates themselves
            found.steps[-1] = (0.0, *found.steps[-1][1:])
            at_y, momentum = at_r, 1.0
        lowest = value
        residuals = [round((s / total - t) / c, 12) for s, t, c in zip(at_y, targets, evening)]
        converged = before is not None and max(abs(a - b) for a, b in zip(residuals, before)) < TOLERANCE
        if converged or not left:
            break
        before, last = residuals, momentum
        momentum = (1 + math.sqrt(1 + 4 * last * last)) / 2
        found.steps.append(((last - 1) / momentum, *residuals))
    found = found._replace(totals=tuple(x / total for x in at_r), targets=tuple(targets), converged=converged)
    missed = [f"{name}: {x:.4g} of {t:.4g}" for name, x, t in zip(domains, found.totals, targets) if abs(x - t) > MISSED * t]
    if missed:
        warnings.warn(f"expected totals miss targets (shares of all tokens): {', '.join(missed)}", stacklevel=2)
    if not converged:
        warnings.warn(f"rates did not settle in {max_steps} steps", stacklevel=2)
    return found


def with_rates(
    docs: DataFrame,
    labels: DataFrame,
    weights: Mapping[str, float] = WEIGHTS,
    keep_whole: str | None = None,
    max_rate: float = MAX_RATE,
    fit_rows: int = FIT_ROWS,
    vocabulary: int = VOCABULARY,
    slim: bool = False,
) -> DataFrame:
    """``docs`` with ``n_tokens``, the posterior ``p`` (in thousandths, by the order of
    ``DOMAINS``), ``rate`` and ``copies``.

    ``copies`` is a whole number whose expectation is ``rate``, drawn by a hash of
    ``doc_id``.  ``slim`` returns ``doc_id`` in place of all columns and reads the texts
    once less.  Null and empty texts have no tokens and the rate of their posterior;
    repeated rows have equal rates; no rows give no rows.  Columns of ``docs`` that have the
    name of a new one are replaced by it.
    """
    model = fit_classifier(docs, labels, fit_rows=fit_rows, vocabulary=vocabulary)
    clash = [c for c in ("n_tokens", "p", "rate", "copies") if c in docs.columns]
    docs = docs.drop(*clash)
    rows = with_posteriors(docs, model)
    small = settle(rows.select("doc_id", "n_tokens", "p"))
    rates = fit_rates(small, model.domains, weights, keep_whole, max_rate)
    rows = small if slim else rows
    chance = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / float(1 << 20)
    # computed once, whatever filters on it
    rows = rows.select("*", one_row(rate=rates.rate()))
    return rows.select("*", one_row(copies=F.floor(F.col("rate") + chance).cast("int")))


def mix(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as many times as ``with_rates`` says, with all their columns as
    they are, whatever their names.  Null and empty texts, repeated rows and no rows are
    treated as there."""
    rows = with_rates(set_aside(docs, "doc_id", "text"), labels, **options)
    times = F.explode(F.sequence(F.lit(1), F.col("copies")))
    return bring_back(rows.where("copies > 0").select("*", times.alias(COPY)), docs, "doc_id", "text")
