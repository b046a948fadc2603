"""How a text becomes words and terms: a contract that every operator accepts.

An analyser gives, as plain column expressions,

* ``pieces``: the text's pieces in order, an array of strings.  A word's place in it is its
  position; empty pieces may keep places free;
* ``keeps``: whether a piece is a word;
* ``add_term``: a table with a column of words, with the term of each beside it.

Everything downstream (stop words, frequencies, forms, bands, phrases) works on words, terms
and positions alone.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bandlex.functions.stem import add_stem
from bandlex.functions.text import word_pieces

MIN_LENGTH = 3


class Analyser(NamedTuple):
    name: str
    pieces: Callable[[Column], Column]
    keeps: Callable[[Column], Column]
    add_term: Callable[[DataFrame, str, str], DataFrame]
    #: What a stop word must be stripped of to be found among the words, as a pattern and as
    #: a test of the characters that stay.
    stripped: str
    stays: Callable[[str], bool]
    #: Whether every word is its own term.
    own_terms: bool = False


def _same(table: DataFrame, token: str, term: str) -> DataFrame:
    kept = [name for name in table.columns if name != term]
    return table.select(*kept, F.col(token).alias(term))


def letter_pieces(text: Column) -> Column:
    """Runs of letters of any script, in lower case."""
    return F.split(F.lower(text), r"\P{L}+")


#: Words of ``a`` to ``z`` between white space and hyphens, three letters at least, and stems.
STEMS = Analyser("stems", word_pieces, lambda token: F.length(token) >= MIN_LENGTH, add_stem, "[^a-z]", lambda c: "a" <= c <= "z")
#: Runs of letters of any script, two at least, each its own term.
LETTERS = Analyser("letters", letter_pieces, lambda token: F.length(token) >= 2, _same, r"[^\p{L}]", str.isalpha, True)

ANALYSERS = {a.name: a for a in (STEMS, LETTERS)}
