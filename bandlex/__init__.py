"""Corpus contrast on Spark: the words that set groups of documents apart."""

from bandlex.plans.contrast_run import build_corpus, run

__all__ = ["build_corpus", "run"]
