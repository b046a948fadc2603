"""A dictionary of words and terms with dense ids, and documents as arrays of term ids.

The dictionary only grows: a word keeps its id, new words get the numbers after the last
one.  Each append is a part of a stored table of its own, so old ids are never written anew.

With ids, a document's terms are a sorted array of distinct numbers that is made inside its
row.  Counting documents per term then moves partial counts only: neither the text nor rows
of document and term are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bandlex.functions.analysis import STEMS, Analyser
from bandlex.operators.lookup import MAX_BROADCAST_BYTES, fits_broadcast
from bandlex.operators.row_lookup import key_bytes, row_lookup
from bandlex.operators.tokens import Stopwords, document_words, listed_stopwords, remove_stopwords, stem_tokens
from bandlex.plans.settle import settle
from bandlex.sources.readers import dense_ids
from bandlex.sources.versions import part_names, publish, read_versions

SCHEMA = "term string, term_id bigint, token string, token_id bigint, n bigint"


def _numbered(new: DataFrame, key: str, name: str, start: int) -> DataFrame:
    """``key`` with ``name``: start, start + 1, ... in order of ``key``."""
    return dense_ids(new.select(key), key).select(key, (F.col("doc_id") + start).alias(name))


def _next_id(dictionary: DataFrame, name: str) -> int:
    return dictionary.agg(F.coalesce(F.max(name) + 1, F.lit(0))).first()[0]


def _new_keys(keys: DataFrame, known: DataFrame, key: str) -> DataFrame:
    known = known.select(key).distinct()
    return keys.join(F.broadcast(known) if fits_broadcast(known, key) else known, key, "left_anti")


def new_words(
    docs: DataFrame, dictionary: DataFrame | None = None, stopwords: Stopwords = None, normalize: bool = False, analyser: Analyser = STEMS
) -> DataFrame:
    """Rows to append to ``dictionary`` for the words of ``docs`` it lacks.

    ``token`` and ``term`` have an id each, dense and in order of the string among those
    that are new; a new word of a known term has that term's id.  ``n`` is the number of
    documents of ``docs`` that hold the word.  The result is settled.
    """
    spark = docs.sparkSession
    dictionary = spark.createDataFrame([], SCHEMA) if dictionary is None else dictionary
    words = remove_stopwords(document_words(docs.select("text"), analyser=analyser), stopwords, normalize, analyser)
    counted = words.groupBy("token").agg(F.count("*").alias("n"))
    fresh = settle(stem_tokens(_new_keys(counted, dictionary, "token"), analyser))
    tokens = _numbered(fresh, "token", "token_id", _next_id(dictionary, "token_id"))
    terms = settle(fresh.select("term").distinct())
    known = dictionary.select("term", "term_id").distinct()
    old = terms.join(known, "term")
    numbered = _numbered(_new_keys(terms, dictionary, "term"), "term", "term_id", _next_id(dictionary, "term_id"))
    rows = fresh.join(tokens, "token").join(old.unionByName(numbered), "term")
    return settle(rows.select("term", "term_id", "token", "token_id", "n"))


def append_dictionary(docs: DataFrame, path: str, **options) -> DataFrame:
    """Add the words of ``docs`` to the dictionary at ``path``, which is made if there is none, and
    return all of it.  Options are those of `new_words`.  A failed append leaves it as it was."""
    spark = docs.sparkSession
    names = part_names(spark, path)
    known = read_dictionary(spark, path) if names else None
    publish(new_words(docs, known, **options), path, f"{len(names):06}")
    return read_dictionary(spark, path)


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """``term, term_id, token, token_id, n`` of all appends."""
    return read_versions(spark, path)


def _frequent(dictionary: DataFrame, max_bytes: int) -> DataFrame:
    """``key, id``: words and term ids of the most frequent terms that fit the bound, with all
    forms of a term or none.  Terms are taken by powers of two of their frequency, whose sizes
    are at most 64 rows, so nothing is sorted."""
    per_term = dictionary.groupBy("term_id").agg(F.sum("n").alias("of_term"), F.sum(key_bytes("token")).alias("bytes"))
    octave = F.floor(F.log2("of_term")).cast("int")
    sizes = per_term.groupBy(octave.alias("octave")).agg(F.sum("bytes").alias("bytes")).collect()
    least, total = 64, 0
    for row in sorted(sizes, key=lambda r: -r.octave):
        if total + row.bytes > max_bytes:
            break
        least, total = row.octave, total + row.bytes
    if len(sizes) and total == sum(r.bytes for r in sizes):
        return dictionary.select(F.col("token").alias("key"), F.col("term_id").alias("id"))
    kept = per_term.where(octave >= least).select("term_id")
    return dictionary.join(kept, "term_id", "left_semi").select(F.col("token").alias("key"), F.col("term_id").alias("id"))


def encode_documents(
    docs: DataFrame,
    dictionary: DataFrame,
    by: Sequence[str] = (),
    stopwords: Stopwords = None,
    normalize: bool = False,
    analyser: Analyser = STEMS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """``doc_id, by..., ids, rest``: each document's distinct term ids, ascending, and its distinct
    words that are not in the lookup table, in order.

    The table holds the most frequent terms of ``dictionary`` that fit ``max_bytes``, each with
    all its forms, so that no term is both in ``ids`` and behind ``rest``.  ``dictionary`` has
    to have the words of ``docs``; it is one from `new_words` with the same analyser.
    """
    table = settle(_frequent(dictionary, max_bytes))
    pieces = F.array_distinct(analyser.pieces(F.col("text")))

    def is_word(token: Column) -> Column:
        kept = analyser.keeps(token)
        if isinstance(stopwords, DataFrame) or stopwords is None:
            return kept
        return kept & ~token.isin(listed_stopwords(stopwords, normalize, analyser))

    # a generator of one row is a barrier: what is below it is not copied into what is above
    rows = docs.select("doc_id", *by, F.explode(F.array(F.filter(pieces, is_word))).alias("pieces"))
    rows = row_lookup(rows, "pieces", "found", table, max_bytes)
    rows = rows.select("doc_id", *by, F.explode(F.array("found")).alias("found"))
    ids = F.array_sort(F.array_distinct(F.filter(F.transform("found", lambda x: x["id"]), lambda i: i.isNotNull())))
    rest = F.transform(F.filter("found", lambda x: x["id"].isNull()), lambda x: x["token"])
    return rows.select("doc_id", *by, ids.alias("ids"), rest.alias("rest"))


def _frequency_with_rest(encoded: DataFrame, dictionary: DataFrame, by: Sequence[str]) -> DataFrame:
    """``by..., term_id, df`` where documents have words beyond the lookup table.  Ids and such words
    leave a document in one list, so that the texts are encoded once for both."""
    id_type = dictionary.schema["term_id"].dataType
    none, no_id = F.lit(None).cast("string"), F.lit(None).cast(id_type)
    found = F.concat(
        F.transform("ids", lambda i: F.struct(i.cast(id_type).alias("term_id"), none.alias("token"))),
        F.transform("rest", lambda t: F.struct(no_id.alias("term_id"), t.alias("token"))),
    )
    rows = encoded.select("doc_id", *by, F.explode(found).alias("found"))
    # an id needs no document any more: partial counts of it move, and rows of document and rare word
    document = F.when(F.col("found.token").isNotNull(), F.col("doc_id")).alias("doc_id")
    rows = rows.select(document, *by, "found.term_id", "found.token")
    rows = settle(rows.groupBy("doc_id", *by, "term_id", "token").agg(F.count("*").alias("n")))
    rare = rows.where("token is not null").drop("term_id").join(dictionary.select("token", "term_id"), "token")
    rare = rare.select("doc_id", *by, "term_id").distinct().select(*by, "term_id", F.lit(1).cast("long").alias("n"))
    counted = rows.where("token is null").select(*by, "term_id", "n").unionByName(rare)
    return counted.groupBy(*by, "term_id").agg(F.sum("n").alias("df"))


def frequency_by_ids(
    docs: DataFrame,
    dictionary: DataFrame,
    by: Sequence[str] = (),
    stopwords: Stopwords = None,
    normalize: bool = False,
    analyser: Analyser = STEMS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """``by..., term, df``, the same as `document_frequency`, without a shuffle of the text.

    Ids are counted where the documents are, and partial counts move.  Where the dictionary
    is larger than a lookup table may be, rows of document and term move for its rare terms.
    A stop word table, unlike a list, is taken out of the dictionary.
    """
    dictionary = dictionary.select("term", "term_id", "token", "n")
    if isinstance(stopwords, DataFrame):
        dictionary = remove_stopwords(dictionary, stopwords, normalize, analyser)
    dictionary = settle(dictionary)
    encoded = encode_documents(docs, dictionary, by, stopwords, normalize, analyser, max_bytes)
    size = dictionary.agg(F.sum(key_bytes("token"))).first()[0] or 0
    if size <= max_bytes:
        counted = encoded.select(*by, F.explode_outer("ids").alias("term_id")).where("term_id is not null")
        counted = counted.groupBy(*by, "term_id").agg(F.count("*").alias("df"))
    else:
        counted = _frequency_with_rest(encoded, dictionary, by)
    terms = dictionary.select("term", "term_id").distinct()
    terms = F.broadcast(terms) if fits_broadcast(terms, "term", max_bytes) else terms
    return counted.join(terms, "term_id").select(*by, "term", "df")
