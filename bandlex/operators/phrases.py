"""Pairs of words that belong together, and documents with these pairs kept whole.

Neighbours are counted inside each document's row: no positions are shuffled, and a hot pair
leaves a task as one row.  A pair's score is the log-likelihood ratio of its two-by-two table
against words that follow each other independently.  Words are stemmed after they were
counted, once per pair of different words.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bandlex.functions.analysis import STEMS, Analyser
from bandlex.operators.lookup import MAX_BROADCAST_BYTES, fits_broadcast
from bandlex.operators.row_lookup import key_bytes, row_lookup
from bandlex.operators.row_members import Members, alike, among
from bandlex.operators.tokens import Stopwords, listed_stopwords, remove_stopwords
from bandlex.plans.settle import settle, settle_large

MIN_COUNT = 5
MIN_SCORE = 10.828  # chi-square with one degree of freedom, at 0.001
JOINED = " "  # between the two words of a key


def _word_test(stopwords: Stopwords, normalize: bool, analyser: Analyser) -> Callable[[Column], Column]:
    """Whether a piece is a word, and no stop word of a list."""
    listed = [] if stopwords is None or isinstance(stopwords, DataFrame) else listed_stopwords(stopwords, normalize, analyser)

    def is_word(token: Column) -> Column:
        word = token.isNotNull() & analyser.keeps(token)
        return word & ~token.isin(listed) if listed else word

    return is_word


def _after(words: str) -> Column:
    return F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0)))


def _neighbours(docs: DataFrame, text: str, stopwords: Stopwords, normalize: bool, analyser: Analyser) -> DataFrame:
    """``docs`` without its text, with ``pairs``: for each place, the word there and the next
    piece joined, null where one of the two is no word or a stop word of a list."""
    kept = [name for name in docs.columns if name != text]
    is_word = _word_test(stopwords, normalize, analyser)
    # generators of one row: what they make is not copied into the lambdas above them
    rows = docs.select(*kept, F.explode(F.array(analyser.pieces(F.col(text)))).alias("pieces"))
    words = F.transform("pieces", lambda token: F.when(is_word(token), token))
    rows = rows.select(*kept, F.explode(F.array(words)).alias("words"))
    pairs = F.zip_with("words", _after("words"), lambda a, b: F.concat(a, F.lit(JOINED), b))
    return rows.select(*kept, pairs.alias("pairs"))


def _following(docs: DataFrame, text: str, stopwords: Stopwords, normalize: bool, analyser: Analyser) -> DataFrame:
    """``docs`` without its text, with ``pos, word, next``: one row for each place where a word
    is followed by another.  The same pairs as `_neighbours`, in generated code throughout."""
    kept = [name for name in docs.columns if name != text]
    listed = [] if stopwords is None or isinstance(stopwords, DataFrame) else listed_stopwords(stopwords, normalize, analyser)
    rows = docs.select(*kept, F.explode(F.array(analyser.pieces(F.col(text)))).alias("pieces"))
    # the outer form, as for words: the inner one would build the array twice
    rows = rows.select(*kept, "pieces", F.posexplode_outer("pieces").alias("pos", "word"))
    rows = rows.select(*kept, "pos", "word", F.get("pieces", F.col("pos") + 1).alias("next"))
    for name in ("word", "next"):
        rows = rows.where(analyser.keeps(F.col(name)))
        rows = rows.where(~F.col(name).isin(listed)) if listed else rows
    return rows


def _pair() -> Column:
    return F.concat("word", F.lit(JOINED), "next")


def log_likelihood(both: Column, first: Column, second: Column, total: Column) -> Column:
    """The log-likelihood ratio of a pair that occurs ``both`` times, among ``total`` pairs of
    which ``first`` begin with its first term and ``second`` end with its second."""
    score = F.lit(0.0)
    for n, row, column in (
        (both, first, second),
        (first - both, first, total - second),
        (second - both, total - first, second),
        (total - first - second + both, total - first, total - second),
    ):
        n, row, column = (c.cast("double") for c in (n, row, column))
        score = score + F.when(n > 0, n * F.log(n / row * (total / column))).otherwise(0.0)
    return score * 2.0


def _counted(docs: DataFrame, text: str, stopwords: Stopwords, normalize: bool, analyser: Analyser) -> DataFrame:
    """``pair, n, first, second`` of every pair of words."""
    pairs = _following(docs.select(text), text, stopwords, normalize, analyser).select(_pair().alias("pair"))
    counted = pairs.groupBy("pair").agg(F.count("*").alias("n"))
    for place, term in ((1, "first"), (-1, "second")):
        counted = counted.withColumn("token", F.substring_index("pair", JOINED, place))
        if isinstance(stopwords, DataFrame):
            counted = remove_stopwords(counted, stopwords, normalize, analyser)
        counted = analyser.add_term(counted, "token", term)
    return counted.select("pair", "n", "first", "second")


def _settled_counts(docs: DataFrame, text: str, stopwords: Stopwords, normalize: bool, analyser: Analyser) -> DataFrame:
    """`_counted`, computed once.  Terms that are the words of the pair are not stored."""
    counted = _counted(docs, text, stopwords, normalize, analyser)
    if not analyser.own_terms:
        return settle_large(counted)
    stored = settle_large(counted.select("pair", "n"))
    return stored.select("pair", "n", *(F.substring_index("pair", JOINED, at).alias(term) for at, term in ((1, "first"), (-1, "second"))))


def find_phrases(
    docs: DataFrame,
    text: str = "text",
    stopwords: Stopwords = None,
    normalize: bool = False,
    analyser: Analyser = STEMS,
    min_count: int = MIN_COUNT,
    min_score: float = MIN_SCORE,
) -> DataFrame:
    """``first, second, n, score, words``: terms that follow each other at least ``min_count``
    times and more often than by chance, with a log-likelihood ratio of ``min_score`` or more.

    ``words`` are the pairs of words that have these terms.  Two words follow each other if
    nothing is between them, no stop word either.  The result is settled.
    """
    counted = _settled_counts(docs, text, stopwords, normalize, analyser)
    return _scored(counted, analyser, min_count, min_score)


def _scored(counted: DataFrame, analyser: Analyser, min_count: int = MIN_COUNT, min_score: float = MIN_SCORE) -> DataFrame:
    """`find_phrases` from the settled counts of pairs."""
    if analyser.own_terms:
        # a pair of terms is one pair of words, and has been counted whole
        often = counted.where(F.col("n") >= min_count).select("first", "second", "n", F.array("pair").alias("words"))
    else:
        # one exchange by term: most pairs are rare, and only those of frequent terms are listed
        of_terms = counted.withColumn("both", F.sum("n").over(Window.partitionBy("first", "second"))).where(F.col("both") >= min_count)
        often = of_terms.groupBy("first", "second").agg(F.first("both").alias("n"), F.array_sort(F.collect_list("pair")).alias("words"))
    # how often a term is a first and a second one, in one pass over the pairs
    sides = counted.select("n", F.posexplode(F.array("first", "second")).alias("side", "term"))
    of_side = (F.sum(F.when(F.col("side") == i, F.col("n")).otherwise(0)).alias(f"n_{name}") for i, name in enumerate(("first", "second")))
    terms = sides.groupBy("term").agg(*of_side)
    terms = settle_large(terms)
    total = terms.agg(F.sum("n_first")).scalar()
    rows = often
    for term in ("first", "second"):
        # no sort: a task holds its share of the terms
        rows = rows.join(terms.select(F.col("term").alias(term), f"n_{term}").hint("shuffle_hash"), term)
    rows = rows.withColumn("total", total)
    score = log_likelihood(F.col("n"), F.col("n_first"), F.col("n_second"), F.col("total"))
    rows = rows.withColumn("score", score)
    kept = (F.col("score") >= min_score) & (F.col("n") * F.col("total") > F.col("n_first") * F.col("n_second"))
    return settle_large(rows.where(kept).select("first", "second", "n", "score", "words"))


def _taken(places: Column) -> Column:
    """Of ascending places, from the left, those that do not touch the one taken before."""
    state = F.struct(F.lit(-2).alias("last"), F.array().cast("array<int>").alias("taken"))
    return F.aggregate(
        places,
        state,
        lambda s, at: F.when(
            at > s["last"] + 1, F.struct(at.alias("last"), F.array_append(s["taken"], at).alias("taken"))
        ).otherwise(s),
        lambda s: s["taken"],
    )


def _places(
    docs: DataFrame, phrases: DataFrame, text: str, stopwords: Stopwords, normalize: bool, analyser: Analyser, max_bytes: int
) -> tuple[DataFrame, DataFrame]:
    """``kept..., pos, id`` of the places of phrases, and ``key, first, second, id`` of their pairs of words."""
    kept = [name for name in docs.columns if name != text]
    keys = settle(phrases.select(F.explode("words").alias("key"), "first", "second"))
    keys = settle(keys.withColumn("id", F.monotonically_increasing_id()))
    if (keys.agg(F.sum(key_bytes("key"))).first()[0] or 0) <= max_bytes:
        rows = _neighbours(docs, text, stopwords, normalize, analyser)
        found = row_lookup(rows, "pairs", "found", keys.select("key", "id"), max_bytes)
        found = found.select(*kept, F.explode(F.array(F.transform("found", lambda x: x["id"]))).alias("ids"))
        places = F.filter(F.sequence(F.lit(0), F.size("ids") - 1), lambda i: F.get("ids", i).isNotNull())
        places = F.when(F.size("ids") > 0, places).otherwise(F.array().cast("array<int>"))
        found = found.select(*kept, "ids", F.explode(F.array(_taken(places))).alias("taken"))
        taken = found.select(*kept, "ids", F.explode("taken").alias("pos")).select(*kept, "pos", F.get("ids", "pos").alias("id"))
    else:
        # texts are numbered and settled before they become rows of pairs, which are several times larger
        numbered = settle(docs.select(*kept, text, F.monotonically_increasing_id().alias("row")))
        each = _following(numbered, text, stopwords, normalize, analyser).select(*kept, "row", "pos", _pair().alias("key"))
        # the places are not sorted by their pairs: a task holds its share of the phrases
        each = each.join(keys.select("key", "id").hint("shuffle_hash"), "key")
        in_row = Window.partitionBy("row").orderBy("pos")
        # a run of places side by side: every second one is taken, from its first
        begins = F.when(F.col("pos") == F.lag("pos").over(in_row) + 1, None).otherwise(F.col("pos"))
        begun = F.max("begins").over(in_row.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        runs = each.withColumn("begins", begins).withColumn("begun", begun)
        taken = runs.where((F.col("pos") - F.col("begun")) % 2 == 0).select(*kept, "pos", "id")
    return taken, keys


def phrase_places(
    docs: DataFrame,
    phrases: DataFrame,
    text: str = "text",
    stopwords: Stopwords = None,
    normalize: bool = False,
    analyser: Analyser = STEMS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """The columns of ``docs`` but its text, and ``pos, first, second``: where its phrases are.

    Phrases do not overlap: from the left, each that does not begin within the one before.
    This is done inside the row where the words of ``phrases`` fit the bound, and otherwise
    with a join, and a window per document over the places of phrases alone.
    """
    kept = [name for name in docs.columns if name != text]
    taken, keys = _places(docs, phrases, text, stopwords, normalize, analyser, max_bytes)
    names = keys.select("id", "first", "second")
    names = F.broadcast(names) if fits_broadcast(keys, "key", max_bytes) else names
    return taken.join(names, "id").select(*kept, "pos", "first", "second")


def _hash_of_key(key: Column) -> Column:
    return F.xxhash64(F.substring_index(key, JOINED, 1), F.substring_index(key, JOINED, -1))


def _phrase_members(counted: DataFrame, keys: DataFrame, max_bytes: int) -> tuple[Members, Members] | None:
    """Of the hashes of all pairs in ``counted``: those that may be of ``keys`` (``key, h``), and
    of these those that are not.

    None where hashes do not tell, as two phrases, or a phrase and another pair, share one, and
    where a table is above the bound.
    """
    n, most = keys.groupBy("h").count().agg(F.coalesce(F.sum("count"), F.lit(0)), F.max("count")).first()
    near = alike(keys.select("h"), n, max_bytes)
    if near is None or (most or 0) > 1:
        return None
    pairs = counted.select(F.col("pair").alias("key"), _hash_of_key(F.col("pair")).alias("h"))
    others = settle(pairs.where(near.has(near.whole, F.col("h"))).join(keys.select("key").hint("shuffle_hash"), "key", "left_anti").select("h").distinct())
    far = among(others, others.count(), max_bytes)
    if far is None or others.join(keys.select("h"), "h", "left_semi").limit(1).count():
        return None
    return near, far


def _taken_hashes(
    docs: DataFrame, text: str, stopwords: Stopwords, normalize: bool, analyser: Analyser, near: Members, far: Members
) -> DataFrame:
    """``h, taken``: how often the pair of a hash is taken, as `_taken` does, within the rows.
    Phrases are the hashes that ``near`` has and ``far`` has not."""
    is_word = _word_test(stopwords, normalize, analyser)
    rows = docs.select(F.explode(F.array(analyser.pieces(F.col(text)))).alias("pieces"))
    rows = rows.select(F.explode(F.array(F.transform("pieces", lambda token: F.when(is_word(token), token)))).alias("words"))
    both = F.zip_with("words", _after("words"), lambda a, b: F.when(a.isNotNull() & b.isNotNull(), F.xxhash64(a, b)))
    rows = rows.select(F.explode(F.array(both)).alias("hashes"))
    rows = rows.select("hashes", near.whole.alias("near"), far.whole.alias("far"))
    marks = F.transform("hashes", lambda h: F.when(near.has(F.col("near"), h) & ~far.has(F.col("far"), h), "1").otherwise("0"))
    # from the left: of each two places side by side, the first
    marks = F.split(F.replace(F.array_join(marks, ""), F.lit("11"), F.lit("10")), "")
    rows = rows.select("hashes", marks.alias("marks"))
    # the outer form: the inner one would make the marks twice
    rows = rows.select("hashes", F.posexplode_outer("marks").alias("pos", "mark")).where("mark = '1'")
    return rows.groupBy(F.get("hashes", "pos").alias("h")).agg(F.count("*").alias("taken"))


def phrases_in(docs: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES, **options) -> DataFrame:
    """``first, second, n, score, taken``: the phrases of ``docs``, and how often each is kept
    whole when its documents are divided.  Options are those of `find_phrases`.

    No place is shuffled while a table of the phrases' fingerprints is within ``max_bytes``.
    """
    shared = [options.get(k, v) for k, v in (("stopwords", None), ("normalize", False), ("analyser", STEMS))]
    text = options.get("text", "text")
    limits = {k: v for k, v in options.items() if k in ("min_count", "min_score")}
    counted = _settled_counts(docs, text, *shared)
    found = _scored(counted, shared[-1], **limits)
    keys = found.select(F.explode("words").alias("key"), "first", "second").withColumn("h", _hash_of_key(F.col("key")))
    # words of a table of stop words stand in the rows, but not among the pairs that were counted
    members = None if isinstance(shared[0], DataFrame) else _phrase_members(counted, keys.select("key", "h"), max_bytes)
    if members is not None:
        per_pair = _taken_hashes(docs, text, *shared, *members).join(keys, "h")
    else:
        places, keys = _places(docs.select(text), found, text, *shared, max_bytes)
        # counted by pair of words before the terms are joined
        per_pair = places.groupBy("id").agg(F.count("*").alias("taken")).join(keys, "id")
    taken = per_pair.groupBy("first", "second").agg(F.sum("taken").alias("taken"))
    rows = found.join(taken, ["first", "second"], "left")
    return rows.select("first", "second", "n", "score", F.coalesce("taken", F.lit(0)).alias("taken"))
