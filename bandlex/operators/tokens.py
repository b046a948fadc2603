"""From documents to words: tokens, stop words, stems."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandlex.functions.analysis import STEMS, Analyser
from bandlex.operators.lookup import join_lookup

Stopwords = DataFrame | Iterable[str] | None


def _explode_words(docs: DataFrame, text: str, distinct: bool, analyser: Analyser) -> DataFrame:
    kept = [name for name in docs.columns if name != text]
    pieces = analyser.pieces(F.col(text))
    pieces = docs.select(*kept, (F.array_distinct(pieces) if distinct else pieces).alias("pieces"))
    # the outer form: for the inner one the optimizer adds a test for empty arrays below
    # the projection, which would build every array twice
    words = pieces.select(*kept, F.posexplode_outer("pieces").alias("pos", "token"))
    return words.where(analyser.keeps(F.col("token")))


def tokenize(docs: DataFrame, text: str = "text", analyser: Analyser = STEMS) -> DataFrame:
    """Replace ``text`` by one row per word: ``pos`` (number of the piece) and ``token``."""
    return _explode_words(docs, text, False, analyser)


def document_words(docs: DataFrame, text: str = "text", analyser: Analyser = STEMS) -> DataFrame:
    """One row per distinct word of a document.  Words are made distinct inside the row,
    before they become rows; ``pos`` orders them by first occurrence."""
    return _explode_words(docs, text, True, analyser)


def listed_stopwords(stopwords: Iterable[str], normalize: bool = False, analyser: Analyser = STEMS) -> list[str]:
    """A Python list as it is compared with words."""
    words = {word.lower() for word in stopwords}
    if normalize:
        words = {"".join(filter(analyser.stays, word)) for word in words}
    return sorted(words)


def remove_stopwords(
    tokens: DataFrame, stopwords: Stopwords, normalize: bool = False, analyser: Analyser = STEMS
) -> DataFrame:
    """Drop tokens that are stop words.

    Tokens carry no punctuation while stop words may, so ``don't`` in the list removes
    nothing; ``normalize=True`` strips the list in the same way.  A Python list becomes a
    set test in the filter, a DataFrame with a ``token`` column an anti join.
    """
    if stopwords is None:
        return tokens
    if isinstance(stopwords, DataFrame):
        listed = stopwords.select(F.lower("token").alias("token"))
        if normalize:
            listed = listed.select(F.regexp_replace("token", analyser.stripped, "").alias("token"))
        # distinct: an anti join needs each word once
        return join_lookup(tokens, listed.distinct(), "token", "left_anti").select(*tokens.columns)
    words = listed_stopwords(stopwords, normalize, analyser)
    return tokens.where(~F.col("token").isin(words)) if words else tokens


def stem_tokens(tokens: DataFrame, analyser: Analyser = STEMS) -> DataFrame:
    """Append ``term``, the stem of ``token``."""
    return analyser.add_term(tokens, "token", "term")


def stem_vocabulary(
    docs: DataFrame, stopwords: Stopwords = None, normalize: bool = False, analyser: Analyser = STEMS
) -> DataFrame:
    """Every distinct word of the collection with its stem; each is stemmed once."""
    words = remove_stopwords(document_words(docs, analyser=analyser), stopwords, normalize, analyser)
    return stem_tokens(words.select("token").distinct(), analyser)
