"""Document frequency, surface forms and IDF per term.

``docs`` needs ``doc_id`` (one row per id), ``text`` and the columns named in ``by``,
such as the band; everything is computed per combination of those.  ``analyser`` says what
the words and terms of a text are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bandlex.functions.analysis import STEMS, Analyser
from bandlex.functions.text import idf
from bandlex.operators.tokens import Stopwords, document_words, remove_stopwords, stem_tokens
from bandlex.plans.settle import settle

TEXT_PER_TASK = 16 << 20  # bytes of text whose words are grouped at a time
MOST_TASKS = 1 << 16  # beyond a terabyte of text, tasks have more of it

def doc_term_forms(
    docs: DataFrame,
    by: Sequence[str] = (),
    stopwords: Stopwords = None,
    normalize: bool = False,
    analyser: Analyser = STEMS,
) -> DataFrame:
    """Distinct ``(doc_id, term, token)`` with ``pos``, the order within the document.

    ``normalize`` cleans the stop words as words are cleaned, here and below."""
    words = document_words(docs.select("doc_id", *by, "text"), analyser=analyser)
    return stem_tokens(remove_stopwords(words, stopwords, normalize, analyser), analyser)


def _colocate(docs: DataFrame, by: Sequence[str], colocated: bool, per_task: int = TEXT_PER_TASK) -> DataFrame:
    """Bring whole documents to the partition of their id.

    Grouping by ``(doc_id, term)`` further up then needs no exchange.  The text of a
    document is several times smaller than its rows of words, so this is the cheap point
    for the shuffle.  Ids are unique, hence the partitions are even.  Their number follows
    the measured size of the texts, so that the words a task groups do not grow with it.
    """
    slim = docs.select("doc_id", *by, "text")
    if colocated:
        return slim
    size = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
    least = docs.sparkSession.sparkContext.defaultParallelism
    return slim.repartition(min(max(-(-size // per_task), least), MOST_TASKS), "doc_id")


def _counted_words(
    docs: DataFrame, by: Sequence[str], stopwords: Stopwords, colocated: bool, normalize: bool, analyser: Analyser
) -> DataFrame:
    """Words with ``counts``: 1 for the first form of a term within a document, else 0,
    so that a sum over any number of forms counts documents."""
    words = doc_term_forms(_colocate(docs, by, colocated), by, stopwords, normalize, analyser)
    in_document = Window.partitionBy("doc_id", *by, "term").orderBy("pos")
    return words.withColumn("counts", F.when(F.row_number().over(in_document) == 1, 1).otherwise(0))


def document_frequency(
    docs: DataFrame,
    by: Sequence[str] = (),
    stopwords: Stopwords = None,
    colocated: bool = False,
    normalize: bool = False,
    analyser: Analyser = STEMS,
) -> DataFrame:
    """``df``: number of documents that hold a term.

    ``colocated=True`` says that ``docs`` is partitioned by ``doc_id`` already, for
    example a table bucketed by it, and saves the shuffle of the text.
    """
    words = doc_term_forms(_colocate(docs, by, colocated), by, stopwords, normalize, analyser)
    # a document's words are in one partition: distinct needs neither exchange nor sort
    terms = words.select("doc_id", *by, "term").distinct()
    return terms.groupBy(*by, "term").agg(F.count("*").alias("df"))


def _ordered_forms(occurrences: DataFrame, by: Sequence[str], *more: Column) -> DataFrame:
    """Forms of each term in order of first occurrence.

    A term has at most as many forms as there are combinations of suffixes, so the
    collected list is small whatever the size of the collection.
    """
    forms = F.array_sort(F.collect_list(F.struct("first_doc", "first_pos", "token")))
    return occurrences.groupBy(*by, "term").agg(*more, F.transform(forms, lambda form: form["token"]).alias("forms"))


def _first_occurrence() -> list[Column]:
    # two fixed-width buffers; the minimum of a struct would need a sort-based aggregate
    return [F.min("doc_id").alias("first_doc"), F.min_by("pos", "doc_id").alias("first_pos")]


def term_statistics(
    docs: DataFrame,
    by: Sequence[str] = (),
    stopwords: Stopwords = None,
    colocated: bool = False,
    normalize: bool = False,
    analyser: Analyser = STEMS,
) -> DataFrame:
    """``df`` and ``forms`` per term in one pass over the text.

    Sums are combined before each shuffle; what is shuffled beyond the text is the
    vocabulary, not the occurrences.
    """
    return merged_statistics(partial_statistics(docs, by, stopwords, colocated, normalize, analyser), by)


def partial_statistics(
    docs: DataFrame,
    by: Sequence[str] = (),
    stopwords: Stopwords = None,
    colocated: bool = False,
    normalize: bool = False,
    analyser: Analyser = STEMS,
) -> DataFrame:
    """``by..., term, token, df, first_doc, first_pos``: what a batch of documents adds to the
    statistics of its terms.  Rows of several batches of different documents, in any order,
    are `merged_statistics` of all of them."""
    words = _counted_words(docs, by, stopwords, colocated, normalize, analyser)
    return words.groupBy(*by, "term", "token").agg(F.sum("counts").alias("df"), *_first_occurrence())


def merged_statistics(partial: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``by..., term, df, forms`` from partial statistics."""
    return _ordered_forms(partial, by, F.sum("df").alias("df"))


def term_forms(
    docs: DataFrame,
    by: Sequence[str] = (),
    stopwords: Stopwords = None,
    forms: str = "all",
    normalize: bool = False,
    analyser: Analyser = STEMS,
) -> DataFrame:
    """Distinct surface forms per term, ordered by document and place in it.

    ``forms="skip_first_doc"`` leaves out what the first document of a term holds, so
    that a term of one document has none.
    """
    words = document_words(docs.select("doc_id", *by, "text"), analyser=analyser)
    words = remove_stopwords(words, stopwords, normalize, analyser)
    if forms == "all":
        # grouped by the word itself, so that each distinct word is stemmed once
        return _ordered_forms(stem_tokens(words.groupBy(*by, "token").agg(*_first_occurrence()), analyser), by)
    if forms != "skip_first_doc":
        raise ValueError(f"forms must be 'all' or 'skip_first_doc', not {forms!r}")
    # the first two documents of a word suffice: one of them is not the term's first
    of_word = Window.partitionBy(*by, "token").orderBy("doc_id")
    of_term = Window.partitionBy(*by, "term")
    early = words.withColumn("nth", F.row_number().over(of_word)).where("nth <= 2")
    later = stem_tokens(early.drop("nth"), analyser).withColumn("term_doc", F.min("doc_id").over(of_term))
    kept = later.groupBy(*by, "term", "token").agg(
        F.min(F.when(F.col("doc_id") > F.col("term_doc"), F.col("doc_id"))).alias("first_doc"),
        F.min_by(
            "pos", F.when(F.col("doc_id") > F.col("term_doc"), F.col("doc_id"))
        ).alias("first_pos"),
    )
    listed = F.array_sort(
        F.collect_list(F.when(F.col("first_doc").isNotNull(), F.struct("first_doc", "first_pos", "token")))
    )
    return kept.groupBy(*by, "term").agg(F.transform(listed, lambda form: form["token"]).alias("forms"))


def count_documents(docs: DataFrame) -> Column:
    """The number of documents as a scalar subquery, for use in another query."""
    return docs.agg(F.count("*")).scalar()


def with_idf(table: DataFrame, n_docs: Column | int, variant: str = "collection") -> DataFrame:
    return table.withColumn("idf", idf(n_docs, F.col("df"), variant))


def idf_by_band(
    corpus: DataFrame,
    n_docs: Column | int | None = None,
    stopwords: Stopwords = None,
    by: Sequence[str] = ("band",),
    variant: str = "collection",
    forms: str = "all",
    drop_last_term: bool = False,
    colocated: bool = False,
    normalize: bool = False,
    analyser: Analyser = STEMS,
) -> DataFrame:
    """``by..., term, df, idf, forms``.

    ``df`` is counted within the band but ``n_docs`` is the size of the whole collection,
    by default all of ``corpus``.  ``forms="skip_first_doc"`` and ``drop_last_term=True``
    (leave out the greatest term of each band) reproduce known gaps of earlier results.
    With either, too, the text is read and shuffled once: forms and frequencies share its
    exchange, and the greatest term is looked up in the table of terms, which is settled
    when this is called.
    """
    docs = _colocate(corpus, by, colocated)
    table = term_statistics(docs, by, stopwords, True, normalize, analyser)
    if forms != "all":
        table = table.drop("forms").join(term_forms(docs, by, stopwords, forms, normalize, analyser), [*by, "term"])
    if drop_last_term:
        table = settle(table)
        last = table.groupBy(*by).agg(F.max("term").alias("term"))
        table = table.join(last, [*by, "term"], "left_anti")
    table = with_idf(table, count_documents(corpus) if n_docs is None else n_docs, variant)
    return table.select(*by, "term", "df", "idf", "forms")
