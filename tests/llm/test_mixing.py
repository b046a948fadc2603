"""Rates against a solver in numpy, and the classifier on documents it has not seen."""

import numpy as np
import pytest

from bandlex.llm import mixing
from bandlex.llm.queries import op3_mixing


def brute_rates(p, tokens, weights, max_rate, ridge, whole=None):
    """The same problem by many plain projected steps."""
    w = tokens / tokens.sum()
    mass = p.T @ w
    target = np.array(weights) / sum(weights)
    if whole is not None:
        target = target * mass[whole] / target[whole]
    even = np.maximum(mass, target)
    even[even == 0] = 1
    r = np.ones(len(p))
    for _ in range(5000):
        slope = p @ ((p.T @ (w * r) - target) / even) + ridge * (r - 1)
        r = np.clip(r - slope / (1 + ridge), 0, max_rate)
    return r


@pytest.mark.parametrize("options", [{}, {"max_rate": 1.0, "keep_whole": "good"}])
def test_rates_against_numpy(spark, options):
    rng = np.random.default_rng(3)
    p = np.round(rng.dirichlet([0.3, 0.2, 0.1], 300) * 1000).astype(int)
    p[:, 2] = 1000 - p[:, :2].sum(axis=1)
    p = p[(p >= 0).all(axis=1)]
    tokens = rng.integers(1, 1000, len(p))
    frame = spark.createDataFrame([(x, int(n)) for x, n in zip(p.tolist(), tokens)], "p array<int>, n_tokens long")
    rates = mixing.fit_rates(frame, list(mixing.DOMAINS), ridge=0.01, **options)
    found = [r.rate for r in frame.select(rates.rate().alias("rate")).collect()]
    whole = 0 if options else None
    expected = brute_rates(p / 1000, tokens, list(mixing.WEIGHTS.values()), options.get("max_rate", 4.0), 0.01, whole)
    assert np.abs(np.array(found) - expected).max() < 0.02


def test_rare_domains_match_their_targets(spark):
    rows = [([1000, 0, 0], 150_000), ([0, 1000, 0], 1_000), ([0, 0, 1000], 849_000)]
    frame = spark.createDataFrame(rows, "p array<int>, n_tokens long")
    rates = mixing.fit_rates(frame, list(mixing.DOMAINS))
    found = frame.select("p", "n_tokens", rates.rate().alias("rate")).collect()
    for k, weight in enumerate(mixing.WEIGHTS.values()):
        total = sum(r.rate * r.n_tokens * r.p[k] for r in found) / 1000 / 1_000_000
        assert abs(total - weight) < mixing.MISSED * weight
    assert rates.converged and max(r.rate for r in found) > 39


def test_missed_targets_are_reported(spark):
    rows = [([1000, 0, 0], 150_000), ([0, 1000, 0], 1_000), ([0, 0, 1000], 849_000)]
    frame = spark.createDataFrame(rows, "p array<int>, n_tokens long")
    with pytest.warns(UserWarning, match="toxic: 0.004 of 0.04"):
        mixing.fit_rates(frame, list(mixing.DOMAINS), max_rate=4.0)
    soft = spark.createDataFrame([([600, 300, 100], 10)], "p array<int>, n_tokens long")
    with pytest.warns(UserWarning, match="miss targets"):
        mixing.fit_rates(soft, list(mixing.DOMAINS))
    with pytest.warns(UserWarning, match="did not settle in 1 steps"):
        assert not mixing.fit_rates(frame, list(mixing.DOMAINS), max_steps=1).converged


def test_query(spark, sf):
    frame = op3_mixing(spark, sf)
    assert "Python" not in frame._jdf.queryExecution().executedPlan().toString()
    rows = frame.collect()
    docs = {d.doc_id: d for d in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    assert all(r.n_tokens == len(docs[r.doc_id].text.split()) for r in rows[:200])
    p = np.array([[r[f"p_{name}"] for name in mixing.DOMAINS] for r in rows])
    tokens = np.array([r.n_tokens for r in rows])
    expected = brute_rates(p, tokens, list(mixing.WEIGHTS.values()), mixing.MAX_RATE, mixing.RIDGE)
    assert np.abs(np.array([r.rate for r in rows]) - expected).max() < 0.02
    assert all(r.rate >= 0 and r.copies in (int(r.rate), int(r.rate) + 1) for r in rows)
    assert all(abs(sum(r[f"p_{name}"] for name in mixing.DOMAINS) - 1) < 1e-9 for r in rows)


def test_expected_totals_match_the_targets(spark):
    rows = op3_mixing(spark, "/root/testdata/sf0.1").collect()
    total = sum(r.n_tokens for r in rows)
    for name, weight in mixing.WEIGHTS.items():
        assert abs(sum(r.rate * r.n_tokens * r[f"p_{name}"] for r in rows) / total - weight) < 0.005


def test_classifier_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    model = mixing.fit_classifier(docs, labels.where("doc_id % 2 = 0"))
    held = docs.join(labels.where("doc_id % 2 = 1"), "doc_id")
    names = list(mixing.DOMAINS)
    right = n = 0
    for r in mixing.with_posteriors(held, model).select("p", "quality", "toxic").collect():
        domain = "toxic" if r.toxic else "good" if r.quality else "poor"
        right += names[int(np.argmax(r.p))] == domain
        n += 1
    assert right / n > 0.9


def test_odd_rows(spark, odd_docs):
    rows = [(1, 1, 0), (1, 1, 0), (2, 0, 1), (3, None, 1), (None, 1, 1), (5, 1, 0), (6, 0, 0), (99, 1, 1), (7, 5, 5)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    for table in (labels, labels.limit(0)):
        found = mixing.with_rates(odd_docs, table).collect()
        assert len(found) == odd_docs.count()
        assert all(sum(r.p) == mixing.SCALE and r.rate >= 0 for r in found)
    mixed = mixing.mix(odd_docs, labels, max_rate=1.0, keep_whole="good")
    assert mixed.columns == odd_docs.columns
    assert mixed.count() <= odd_docs.count()
    assert mixing.with_rates(odd_docs.limit(0), labels).collect() == []
    nothing = odd_docs.where("text is null")
    assert {r.rate for r in mixing.with_rates(nothing, labels).collect()} == {1.0}
