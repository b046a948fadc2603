"""The chain on held-out labels and against its parts."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from bandlex.llm import toxicity
from bandlex.llm.queries import op10_toxicity


def brute_features(text):
    words = re.findall(r"[^\W\d_]+", text.lower())
    distinct = set(words)
    chars = len(text) + 20
    rates = [
        np.log1p(100 * len(re.findall(r"[#*$%&|<>]", text)) / chars),
        np.log1p(100 * text.count("!") / chars),
        np.log1p(100 * sum(c.isupper() for c in text) / chars),
        len(distinct) / (len(words) + 5),
    ]
    return distinct | {w[:k] + "*" for w in distinct for k in (4, 5, 6) if len(w) > k}, rates


def brute_link(x, y, x_all):
    """Predictions for ``x_all`` of a penalised logistic regression, in double precision."""
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 0.02)
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    penalty = np.array([1.0] * x.shape[1] + [1e-3])
    beta = np.zeros(len(penalty))
    for _ in range(40):
        p = 1 / (1 + np.exp(-(z @ beta)))
        slope = z.T @ (p - y) + penalty * beta
        beta -= np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + np.diag(penalty), slope)
    assert np.abs(slope).max() < 1e-6
    return 1 / (1 + np.exp(-(((x_all - mean) / scale) @ beta[:-1] + beta[-1])))


def test_query_against_brute_force(spark, sf):
    """Every probability of the query, by a chain that is fitted in numpy."""
    docs = {d.doc_id: brute_features(d.text or "") for d in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    fold = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(4)).alias("fold")
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality", "toxic", fold).dropna().collect()
    labels = sorted((r for r in labels if r.doc_id in docs), key=lambda r: r.doc_id)
    assert 300 < len(labels) < 12_000 and len({r.doc_id for r in labels}) == len(labels)
    targets = [np.array([r.quality == 0 for r in labels], float), np.array([r.toxic == 1 for r in labels], float)]
    n, df = len(labels), Counter(w for r in labels for w in docs[r.doc_id][0])
    chosen = []
    for y in targets:
        both = Counter(w for r, mark in zip(labels, y) if mark for w in docs[r.doc_id][0])
        total = int(y.sum())
        chi2 = {
            w: (both[w] * n - df[w] * total) ** 2 * n / (df[w] * (n - df[w]) * total * (n - total))
            for w in df
            if 3 <= df[w] < n
        }
        best = sorted((-score, w) for w, score in chi2.items() if score > 20)[:400]
        chosen += [w for _, w in best if w not in chosen]
    ids = sorted(docs)
    x_all = np.array([[w in docs[i][0] for w in chosen] + docs[i][1] for i in ids], float)
    at = {i: k for k, i in enumerate(ids)}
    x = x_all[[at[r.doc_id] for r in labels]]
    folds = np.array([r.fold for r in labels])
    first = brute_link(x, targets[0], x_all)
    held_out = np.empty(n)
    for k in range(4):
        held_out[folds == k] = brute_link(x[folds != k], targets[0][folds != k], x[folds == k])
    second = brute_link(np.column_stack([x, held_out]), targets[1], np.column_stack([x_all, first]))
    rows = op10_toxicity(spark, sf).collect()
    assert len(rows) == len(ids)
    for r in rows:
        p = first[at[r.doc_id]], second[at[r.doc_id]]
        assert abs(r.p_low_quality - p[0]) < 2e-3 and abs(r.p_toxic - p[1]) < 2e-3
        assert abs(p[1] - 0.5) < 2e-3 or r.toxic == (p[1] >= 0.5)


def test_query(spark, sf):
    rows = op10_toxicity(spark, sf).collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    assert all(0 <= r.p_toxic <= 1 and r.toxic == (r.p_toxic >= 0.5) for r in rows)


def test_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    chain = toxicity.train(docs, labels.where("doc_id % 2 = 0"))
    held = labels.where("doc_id % 2 = 1")
    rows = toxicity.score(docs.join(held, "doc_id", "left_semi"), chain).join(held.selectExpr("doc_id", "quality", "toxic AS t"), "doc_id").collect()
    toxic = [r for r in rows if r.t]
    # a few of these labels say toxic of texts without any sign of it
    assert sum(r.toxic for r in toxic) > 0.85 * len(toxic)
    assert sum(r.toxic for r in rows if not r.t) < 0.005 * (len(rows) - len(toxic))
    assert sum(r.low_quality == (r.quality == 0) for r in rows) > 0.97 * len(rows)


def test_later_links_see_out_of_fold_predictions(monkeypatch):
    rng = np.random.default_rng(1)
    features = (rng.random((400, 6)) < 0.5).astype(float)
    first = (rng.random(400) < 0.5).astype(float)  # noise: nothing predicts it
    second = features[:, 0]
    seen = []
    real = toxicity.fit_link
    monkeypatch.setattr(toxicity, "fit_link", lambda name, x, y, *a: seen.append((name, x.copy())) or real(name, x, y, *a))
    folds = np.arange(400) % 4
    chain = toxicity.fit_chain(features, {"first": first, "second": second}, folds, {})
    whole = [x for name, x in seen if name == "second"][0]
    assert whole.shape == (400, 7)
    for fold in range(4):
        inside = folds == fold
        expected = real("first", features[~inside], first[~inside]).predict(features[inside])
        assert np.allclose(whole[inside, 6], expected, atol=1e-4)
    found = chain.predict(features)
    assert found.shape == (400, 2) and ((found[:, 1] > 0.5) == (second == 1)).all()


def test_logistic_fit_is_at_the_optimum():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 3))
    y = (rng.random(300) < 1 / (1 + np.exp(-x @ [1.5, -1, 0]))).astype(float)
    link = toxicity.fit_link("c", x, y)
    z = (x - link.mean) / link.scale
    slope = z.T @ (link.predict(x) - y) + toxicity.RIDGE * link.weights
    assert np.abs(slope).max() < 1e-2


@pytest.mark.parametrize("some", [True, False])
def test_odd_rows(spark, odd_docs, some):
    rows = [(1, 1, 0), (1, 1, 0), (2, 0, 1), (3, None, 1), (None, 1, 1), (5, 1, 0), (6, 0, 0), (99, 1, 1)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    found = toxicity.toxicity(odd_docs, labels if some else labels.limit(0)).collect()
    assert len(found) == odd_docs.count() and all(0 <= r.p_toxic <= 1 for r in found)
    assert len({r.p_toxic for r in found if r.doc_id in (3, 4)}) == 1
    assert toxicity.toxicity(odd_docs.limit(0), labels).collect() == []
