"""Author scores and the bands they put documents into."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bandlex.functions.text import NUMBER, WHOLE_NUMBER, trim
from bandlex.operators.density import density_thirds
from bandlex.operators.lookup import MAX_BROADCAST_BYTES, fits_broadcast, join_lookup

LABELS = ("LOW", "MID", "HIGH")


def score_author(field: Column) -> Column:
    """The author in the first field of a score line: up to its first space, without the
    opening quote."""
    return F.substring(F.substring_index(field, " ", 1), 2, 1 << 30)


def parse_score_lines(
    lines: DataFrame, line: str = "value", author: Callable[[Column], Column] = score_author
) -> DataFrame:
    """Replace a column of ``"NAME (...)",score,more...`` lines by ``author`` and ``score``.

    A line counts when it has at least three fields and a number in the second; others,
    such as a header, are skipped.  ``author`` reads the author from the first field; for
    documents with ``key="full_name"`` it has to give ``FIRST-LAST``, as the default does
    for fields such as ``"ANN-DOE (X YY)"``.
    """
    kept = [name for name in lines.columns if name != line]
    fields = lines.select(*kept, F.split(F.col(line), ",", -1).alias("fields"))
    first, second = (trim(F.get("fields", F.lit(i))) for i in (0, 1))
    name = F.substring_index(first, " ", 1)
    read = fields.where((F.size("fields") > 2) & second.rlike(NUMBER) & (F.length(name) > 0))
    scores = read.select(*kept, author(first).alias("author"), second.try_cast("double").alias("score"))
    return scores.where(F.col("score").isNotNull())


def score_last_wins(scores: DataFrame, order: str = "line_no", unique_scores: str = "allow") -> DataFrame:
    """One score per author, the last one by ``order``.

    ``unique_scores="error"`` makes the query fail when two authors share a score.
    """
    latest = scores.groupBy("author").agg(F.max_by("score", order).alias("score"))
    if unique_scores == "allow":
        return latest
    if unique_scores != "error":
        raise ValueError(f"unique_scores must be 'allow' or 'error', not {unique_scores!r}")
    shared = latest.groupBy("score").agg(F.count("*").alias("n"), F.min("author").alias("author"))
    message = F.concat(F.lit("score shared by several authors, among them "), F.col("author"))
    return shared.select(F.when(F.col("n") > 1, F.raise_error(message)).otherwise(F.col("author")).alias("author"), "score")


def score_band(score: Column, lower: float, upper: float, labels: tuple[str, str, str] = LABELS) -> Column:
    """Band of a score; a cut point belongs to the band above it, NaN to the highest.

    A null score, which every comparison would let through to the last band, stays null.
    """
    if not lower <= upper:
        raise ValueError(f"the lower cut must not be above the upper one, and neither NaN: {lower}, {upper}")
    low, mid, high = labels
    return F.when(score.isNull(), None).when(score < lower, low).when(score < upper, mid).otherwise(high)


def banded_scores(
    scores: DataFrame, cuts: tuple[float, float] | None = None, labels: tuple[str, str, str] = LABELS
) -> DataFrame:
    """Append ``band``; without ``cuts`` the line is cut at thirds of the score density,
    two numbers that are computed when this is called.  They are thirds of the finite
    scores; of the others, minus infinity is in the lowest band, infinity and NaN in the
    highest."""
    if cuts is None:
        cuts = density_thirds(scores, "score").first()
        if None in cuts:
            raise ValueError("the score density has no thirds to cut at; give the cuts")
    return scores.withColumn("band", score_band(F.col("score"), *cuts, labels))


def banded_corpus(
    docs: DataFrame, banded: DataFrame, on_missing: str = "error", max_broadcast_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """Append ``score`` and ``band`` of a document's ``author``.

    A document whose author has no score makes the query fail, unless
    ``on_missing="quarantine"``: then it is left out, and `unscored_documents` has it.

    With more authors than can be broadcast, only ids and authors are shuffled by author,
    which one author may dominate; the text is shuffled by id, evenly, and stays where
    the grouping by document needs it.
    """
    if on_missing not in ("error", "quarantine"):
        raise ValueError(f"on_missing must be 'error' or 'quarantine', not {on_missing!r}")
    how = "left" if on_missing == "error" else "inner"
    banded = banded.select("author", "score", "band")
    if fits_broadcast(banded, "author", max_broadcast_bytes):
        joined = docs.join(F.broadcast(banded), "author", how)
    else:
        bands = docs.select("doc_id", "author").join(banded, "author", how).drop("author")
        joined = docs.join(bands, "doc_id", how)
    if on_missing == "error":
        message = F.concat(F.lit("no score for author "), F.coalesce("author", F.lit("(none)")))
        checked = F.when(F.col("band").isNull(), F.raise_error(message)).otherwise(F.col("band"))
        joined = joined.withColumn("band", checked)
    return joined.select(*docs.columns, "score", "band")


def unscored_documents(docs: DataFrame, scores: DataFrame) -> DataFrame:
    """Documents whose author has no score."""
    return join_lookup(docs, scores.select("author"), "author", "left_anti").select(*docs.columns)


def band_sizes(corpus: DataFrame) -> DataFrame:
    return corpus.groupBy("band").agg(F.count("*").alias("n"))


def parse_corpus_lines(lines: DataFrame, line: str = "value", on_bad: str = "error") -> DataFrame:
    """Replace a column of ``id <tab> text`` lines by ``doc_id`` and ``text``.

    The first tab splits.  A line without one, or whose id is no whole number, is bad: the
    end of the query, unless ``on_bad`` asks for it to be kept with a null ``doc_id`` and
    the raw line as text (``"quarantine"``) or to be left out (``"drop"``).
    """
    kept = [name for name in lines.columns if name != line]
    raw = F.col(line)
    head = F.substring_index(raw, "\t", 1)
    doc_id = F.when(F.contains(raw, F.lit("\t")) & head.rlike(WHOLE_NUMBER), head.try_cast("bigint"))
    body = trim(F.substr(raw, F.instr(raw, "\t") + 1))
    if on_bad == "error":
        doc_id = F.coalesce(doc_id, F.raise_error(F.concat(F.lit("bad corpus line: "), F.left(raw, F.lit(80)))).cast("bigint"))
    elif on_bad not in ("drop", "quarantine"):
        raise ValueError(f"on_bad must be 'drop', 'quarantine' or 'error', not {on_bad!r}")
    parsed = lines.select(*kept, raw.alias("raw"), doc_id.alias("doc_id"), body.alias("body"))
    text = F.when(F.col("doc_id").isNull(), F.col("raw")).otherwise(F.col("body")).alias("text")
    parsed = parsed.select(*kept, "doc_id", text)
    return parsed.where(F.col("doc_id").isNotNull()) if on_bad == "drop" else parsed
