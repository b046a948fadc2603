"""Column expressions for documents, names and score lines.

Control characters are written out in the patterns because "white space" differs
between engines: here it is the six ASCII characters of ``WHITESPACE``, and trimming
removes every character up to U+0020.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITESPACE = r"\t\n\x0B\f\r "
# one such character ends a word; a form feed or a no-break space does not
SEPARATORS = "\t\r\n-"
# a decimal number, optionally with exponent and type letter, NaN or Infinity
NUMBER = r"^[+-]?(NaN|Infinity|(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?[fFdD]?)$"
WHOLE_NUMBER = r"^[+-]?\d+$"


def trim(text: Column) -> Column:
    return F.regexp_replace(text, r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def normalize_text(text: Column) -> Column:
    """One line per document: white space collapsed, every line trimmed, lines joined
    by one space.  An empty line in the middle leaves two spaces."""
    one_break = F.regexp_replace(text, r"\r\n?", "\n")
    collapsed = F.regexp_replace(one_break, r"[ \t\x0B\f]+", " ")
    lines = F.regexp_replace(collapsed, r"[\x00-\x09\x0B-\x20]*\n[\x00-\x09\x0B-\x20]*", "\n")
    return trim(F.translate(lines, "\n", " "))


def word_pieces(text: Column) -> Column:
    """The text split at each separator, every piece in lower case and without anything
    but ``a`` to ``z``.  Pieces may be empty; their places in the array are kept.

    Cleaning the whole text before the split gives the same pieces as cleaning each one
    and needs no lambda, which would leave generated code.
    """
    letters = F.regexp_replace(F.lower(text), rf"[^a-z {SEPARATORS}]+", "")
    # translate would look every letter up as a string of its own
    for separator in SEPARATORS:
        letters = F.replace(letters, F.lit(separator), F.lit(" "))
    return F.split(letters, " ")


def author_from_file_name(file_name: Column, key: str = "last_name") -> Column:
    """Author key from ``First-Last_rest``, null when there is no last name.

    ``key="full_name"`` keeps the first name, for collections where last names repeat.
    """
    parts = F.split(trim(F.substring_index(file_name, "_", 1)), "-")
    last = F.upper(trim(F.get(parts, F.lit(1))))
    if key == "last_name":
        return last
    if key == "full_name":
        return F.concat(F.upper(trim(F.get(parts, F.lit(0)))), F.lit("-"), last)
    raise ValueError(f"key must be 'last_name' or 'full_name', not {key!r}")


def idf(n_docs: Column | int, df: Column, variant: str = "collection") -> Column:
    """``log10((N - d + 0.5) / (N + 0.5))``; NaN when d > N.

    The value is negative, and lower for a term in more documents.  ``variant="bm25"``
    divides by ``d + 0.5`` instead.
    """
    n_docs = n_docs if isinstance(n_docs, Column) else F.lit(n_docs)
    if variant == "collection":
        below = n_docs + 0.5
    elif variant == "bm25":
        below = df + 0.5
    else:
        raise ValueError(f"variant must be 'collection' or 'bm25', not {variant!r}")
    rest = n_docs - df + 0.5
    return F.when(rest > 0, F.log10(rest / below)).otherwise(F.lit(float("nan")))
