"""The whole way from documents and scores to the terms that set bands apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from bandlex.operators.bands import LABELS, banded_corpus, banded_scores
from bandlex.operators.contrast import distinctive_terms, topk_terms
from bandlex.operators.index import count_documents, idf_by_band
from bandlex.operators.tokens import Stopwords
from bandlex.plans.settle import settle

TOP_K = 200


def build_corpus(
    docs: DataFrame,
    scores: DataFrame,
    cuts: tuple[float, float] | None = None,
    labels: tuple[str, str, str] = LABELS,
    on_missing: str = "error",
) -> DataFrame:
    """Documents with the band of their author.

    Scores are one row per author but may come from a scan of the whole collection, and
    the cut points, the size check and the join each need them: they are settled first.
    """
    return banded_corpus(docs, banded_scores(settle(scores), cuts, labels), on_missing)


def run(
    docs: DataFrame,
    scores: DataFrame,
    stopwords: Stopwords = None,
    cuts: tuple[float, float] | None = None,
    k: int = TOP_K,
    n_docs: Column | int | None = None,
    labels: tuple[str, str, str] = LABELS,
    on_missing: str = "error",
    **switches,
) -> DataFrame:
    """``band, term, df, idf, forms, rk`` of the terms in one band's top ``k`` only.

    ``docs`` has ``doc_id, author, text``; ``scores`` has ``author, score``.  Further
    arguments are those of `idf_by_band`: ``variant``, ``forms``, ``drop_last_term``,
    ``colocated`` and ``normalize``.
    """
    corpus = build_corpus(docs, scores, cuts, labels, on_missing)
    if n_docs is None:
        # without the join when it keeps every document
        n_docs = count_documents(docs if on_missing == "error" else corpus)
    return distinctive_terms(topk_terms(idf_by_band(corpus, n_docs, stopwords, **switches), k))
