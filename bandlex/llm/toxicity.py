"""Toxicity by a chain of linear classifiers.

Categories are predicted one after the other.  Each is a logistic model over the words
(and beginnings of words) that a text contains, some rates of its characters, and the
probabilities of the categories before it in the chain.  What a later model is trained on
are out-of-fold predictions: those of a model that has not seen the row, so that it learns
how far an earlier category can be trusted.

Models are fitted on a bounded sample of the labelled rows.  Its features come from the
executors as the indices of chosen words, and the fit is a small dense problem.  Every
document is then scored in one pass.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandlex.llm.shared import settle

#: Categories in the order of the chain, as conditions on the labels.
CATEGORIES = {"low_quality": "quality = 0", "toxic": "toxic = 1"}
FIT_ROWS = 12_000  # labelled rows the models are fitted on, by a hash of their id
VOCABULARY = 400  # words and beginnings they look at, for each category
MIN_DOCS = 3
MIN_CHI2 = 20.0
FOLDS = 4
RIDGE = 1.0
THRESHOLD = 0.5
PREFIXES = (4, 5, 6)
WORD = re.compile(r"[^\W\d_]+")
N_RATES = 4


def text_features(text: str) -> tuple[set[str], list[float]]:
    """The distinct words in lower case with their beginnings (marked by ``*``), and rates
    of symbols, capitals and repetition."""
    words = WORD.findall(text.lower())
    distinct = set(words)
    found = set(distinct)
    for n in PREFIXES:
        found.update(w[:n] + "*" for w in distinct if len(w) > n)
    chars = len(text) + 20
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    rates = [
        np.log1p(100 * symbols / chars),
        np.log1p(100 * text.count("!") / chars),
        np.log1p(100 * sum(map(str.isupper, text)) / chars),
        len(distinct) / (len(words) + 5),
    ]
    return found, [float(x) for x in rates]


class Link(NamedTuple):
    """A category's model: standardisation, weights and intercept over words, rates and the
    probabilities of the categories before."""

    category: str
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    intercept: float

    def predict(self, features: np.ndarray) -> np.ndarray:
        score = ((features - self.mean) / self.scale) @ self.weights + self.intercept
        return (1 / (1 + np.exp(-np.clip(score, -35, 35)))).astype(np.float32)


class Chain(NamedTuple):
    vocabulary: dict[str, int]
    links: list[Link]

    def predict(self, features: np.ndarray) -> np.ndarray:
        """One column of probabilities for each category."""
        for link in self.links:
            features = np.column_stack([features, link.predict(features)])
        return features[:, features.shape[1] - len(self.links) :]


def fit_link(category: str, features: np.ndarray, target: np.ndarray, ridge: float = RIDGE) -> Link:
    """Logistic regression with a ridge penalty, by Newton's method."""
    n, d = features.shape
    mean = (features.mean(axis=0, dtype=np.float64) if n else np.zeros(d)).astype(np.float32)
    scale = np.maximum(features.std(axis=0, dtype=np.float64) if n else np.ones(d), 0.02).astype(np.float32)
    x = np.empty((n, d + 1), np.float32)
    x[:, :d] = (features - mean) / scale
    x[:, d] = 1
    penalty = np.full(d + 1, ridge)
    penalty[-1] = 1e-3
    beta = np.zeros(d + 1)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -35, 35)))
        slope = x.T @ (p - target) + penalty * beta
        curve = (x * (p * (1 - p)).astype(np.float32)[:, None]).T @ x + np.diag(penalty)
        move = np.linalg.solve(curve, slope)
        beta -= move
        if np.abs(move).max() < 1e-4:
            break
    return Link(category, mean, scale, beta[:-1], float(beta[-1]))


def fit_chain(features: np.ndarray, targets: Mapping[str, np.ndarray], folds: np.ndarray, vocabulary: dict[str, int]) -> Chain:
    """The links in order; each adds its out-of-fold predictions to what the next sees."""
    links = []
    for category, target in targets.items():
        link = fit_link(category, features, target)
        held_out = link.predict(features)
        for fold in np.unique(folds):
            inside = folds == fold
            if not inside.all():
                held_out[inside] = fit_link(category, features[~inside], target[~inside]).predict(features[inside])
        links.append(link)
        features = np.column_stack([features, held_out])
    return Chain(vocabulary, links)


def labelled(labels: DataFrame, categories: Mapping[str, str] = CATEGORIES, rows: int = FIT_ROWS) -> DataFrame:
    """``doc_id, fold`` and a 0 or 1 for each category, of at most ``rows`` documents, the
    same ones each time.  Of several labels of a document the larger counts, label by
    label; incomplete labels are left out."""
    values = [c for c in labels.columns if c != "doc_id"]
    one = labels.where("doc_id is not null").groupBy("doc_id").agg(*(F.max(c).alias(c) for c in values))
    marks = [F.expr(condition).cast("int").alias(f"is_{k}") for k, condition in enumerate(categories.values())]
    marked = one.select("doc_id", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(FOLDS)).cast("int").alias("fold"), *marks)
    return marked.dropna().orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def _choose_vocabulary(found: DataFrame, n_categories: int, size: int) -> dict[str, int]:
    """For each category, the ``size`` words that tell it best, by chi-square: a frequent
    category leaves the places of a rarer one alone."""
    marks = [f"is_{k}" for k in range(n_categories)]
    totals = found.agg(F.count("*").alias("n"), *(F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in marks)).first()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # one row for each word and combination of categories, of this batch
            counts: dict[tuple, int] = {}
            for text, *is_ in zip(*(column.to_pylist() for column in batch.columns)):
                key = tuple(is_)
                for word in text_features(text)[0]:
                    counts[word, key] = counts.get((word, key), 0) + 1
            columns = [[word for word, _ in counts], list(counts.values()), *zip(*(key for _, key in counts))]
            columns += [[] for _ in range(2 + n_categories - len(columns))]
            types = [pa.string(), *[pa.int64()] * (1 + n_categories)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["word", "df", *marks])

    schema = ", ".join(["word string", "df long", *(f"{m} long" for m in marks)])
    counts = found.select("text", *(F.col(m).cast("long") for m in marks)).mapInArrow(count, schema).groupBy("word")
    counts = counts.agg(F.sum("df").alias("df"), *(F.sum(F.col("df") * F.col(m)).alias(m) for m in marks))
    counts, n = settle(counts.where(F.col("df") >= MIN_DOCS)), float(totals.n)
    chosen: dict[str, int] = {}
    for m in marks:
        gain = F.col(m) * n - F.col("df") * float(totals[m])
        spread = F.col("df") * (n - F.col("df")) * float(totals[m] * (totals.n - totals[m]))
        scored = counts.select("word", F.when(spread > 0, gain * gain * n / spread).otherwise(0.0).alias("score"))
        for r in scored.where(F.col("score") > MIN_CHI2).orderBy(F.desc("score"), "word").limit(size).collect():
            chosen.setdefault(r.word, len(chosen))
    return chosen


def _indexed(texts: Sequence[str | None], vocabulary: dict[str, int]) -> tuple[list[list[int]], list[list[float]]]:
    present, rates = [], []
    for text in texts:
        found, values = text_features(text or "")
        present.append([vocabulary[w] for w in found if w in vocabulary])
        rates.append(values)
    return present, rates


def _matrix(present: Sequence[Sequence[int]], rates: Sequence[Sequence[float]], size: int) -> np.ndarray:
    features = np.zeros((len(present), size + N_RATES), np.float32)
    for row, indices in zip(features, present):
        row[list(indices)] = 1
    if len(present):
        features[:, size:] = rates
    return features


def train(
    docs: DataFrame,
    labels: DataFrame,
    categories: Mapping[str, str] = CATEGORIES,
    fit_rows: int = FIT_ROWS,
    vocabulary: int = VOCABULARY,
) -> Chain:
    """A chain fitted on at most ``fit_rows`` labelled documents.

    The driver gets ``vocabulary`` words for each category, and for each of these documents the words it has
    of them.  Without labelled documents every probability is one half.
    """
    sample = F.broadcast(labelled(labels, categories, fit_rows))  # of fit_rows rows at most
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(sample, "doc_id")
    chosen = _choose_vocabulary(found, len(categories), vocabulary)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            present, rates = _indexed(batch.column(0).to_pylist(), chosen)
            arrays = [pa.array(present, pa.list_(pa.int32())), pa.array(rates, pa.list_(pa.float64())), *batch.columns[1:]]
            yield pa.RecordBatch.from_arrays(arrays, ["present", "rates", *batch.schema.names[1:]])

    marks = [f"is_{k}" for k in range(len(categories))]
    schema = ", ".join(["present array<int>", "rates array<double>", "doc_id long", "fold int", *(f"{m} int" for m in marks)])
    columns = ["text", F.col("doc_id").cast("long"), "fold", *marks]
    rows = sorted(found.select(*columns).mapInArrow(index, schema).collect(), key=lambda r: (r.doc_id, r.rates, r.present))
    features = _matrix([r.present for r in rows], [r.rates for r in rows], len(chosen))
    targets = {name: np.array([r[f"is_{k}"] for r in rows], float) for k, name in enumerate(categories)}
    return fit_chain(features, targets, np.array([r.fold for r in rows]), chosen)


def score(docs: DataFrame, chain: Chain, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, the probability ``p_...`` of each category, and a boolean for each."""
    names = [link.category for link in chain.links]
    shared = docs.sparkSession.sparkContext.broadcast(chain)  # of VOCABULARY words a category

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = shared.value
        for batch in batches:
            found = chain.predict(_matrix(*_indexed(batch.column(1).to_pylist(), chain.vocabulary), len(chain.vocabulary)))
            found = np.round(found.T.astype(np.float64), 6)
            probabilities, verdicts = [pa.array(p) for p in found], [pa.array(p >= threshold) for p in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *probabilities, *verdicts], ["doc_id", *(f"p_{n}" for n in names), *names]
            )

    schema = ", ".join(["doc_id long", *(f"p_{n} double" for n in names), *(f"{n} boolean" for n in names)])
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(predict, schema)


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    categories: Mapping[str, str] = CATEGORIES,
    fit_rows: int = FIT_ROWS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``doc_id, p_low_quality, p_toxic, low_quality, toxic``, one row per row of ``docs``.

    Null and empty texts contain no words and are judged by that; repeated rows alike;
    other columns are ignored; no rows give no rows.
    """
    return score(docs, train(docs, labels, categories, fit_rows), threshold)
