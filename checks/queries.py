"""One query per operator, each over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bandlex.functions.analysis import LETTERS
from bandlex.functions.text import author_from_file_name, normalize_text
from bandlex.operators import bands, contrast, density, incremental, index, phrases, samples, stability, term_ids, tokens
from bandlex.plans.contrast_run import build_corpus, run
from bandlex.plans.settle import settle
from bandlex.session import scratch_folder
from bandlex.sources.readers import read_table

# Fixed value: the stop words both sides of a comparison use.
STOPWORDS = (
    "the", "and", "for", "that", "this", "with", "are", "was", "not", "but", "from",
    "have", "has", "they", "you", "which", "their", "all", "one", "can",
)
TOP_BAND = "HIGH"
TOP_N = 15
#: Tasks that the documents are dealt to when read; the benchmark sets it, whose table is one
#: row group, which no scan can split.
SPREAD: int | None = None
#: The size that a collection is said to have, for terms in more documents than that.
N_DOCS_SAID = 25
STRANGERS = 1 << 40
STEPS = {"lo": -3000.0, "hi": 12000.0, "step": 10.0}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, author, text``: the source of a document stands for its author."""
    table = _table(spark, sf_dir, "documents")
    table = table if SPREAD is None else table.repartition(SPREAD, "doc_id")
    return table.select("doc_id", F.col("source").alias("author"), "text")


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _table(spark, sf_dir, "documents")
    return table.groupBy(F.col("source").alias("author")).agg(F.avg("n_chars").alias("score"))


def _corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_corpus(_documents(spark, sf_dir), _scores(spark, sf_dir))


def _idf_table(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    n_docs = index.count_documents(_table(spark, sf_dir, "documents"))
    return index.idf_by_band(_corpus(spark, sf_dir), n_docs, STOPWORDS, **options)


def _distinctive(spark: SparkSession, sf_dir: str) -> DataFrame:
    n_docs = index.count_documents(_table(spark, sf_dir, "documents"))
    return run(_documents(spark, sf_dir), _scores(spark, sf_dir), STOPWORDS, n_docs=n_docs)


def _shown(table: DataFrame, *columns: str) -> DataFrame:
    """The named columns, IDF rounded and forms as one string."""
    rounded = {"idf": F.round("idf", 9).alias("idf"), "forms": F.concat_ws(" ", "forms").alias("forms")}
    return table.select(*(rounded.get(name, F.col(name)) for name in columns))


def q_normalize_text(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    return docs.select("doc_id", normalize_text(F.col("text")).alias("text_norm"))


def _corpus_lines(spark, sf_dir):
    """Lines in German lack the tab and those in French have no number as id."""
    docs = _table(spark, sf_dir, "documents")
    head = F.when(F.col("lang") == "fr", F.concat(F.lit("x"), "doc_id")).otherwise(F.col("doc_id").cast("string"))
    line = F.concat(head, F.when(F.col("lang") == "de", " ").otherwise("\t"), "text")
    return docs.select(line.alias("value"))


def q_corpus_line_parse(spark, sf_dir):
    return bands.parse_corpus_lines(_corpus_lines(spark, sf_dir), on_bad="quarantine")


def q_name_key_extract(spark, sf_dir):
    part = _table(spark, sf_dir, "part")
    name = F.concat(F.translate("p_name", " ", "-"), F.lit("_"), F.col("p_partkey").cast("string"), F.lit(".txt"))
    return part.select("p_partkey", author_from_file_name(name).alias("name_key"))


def _score_lines(spark, sf_dir, name):
    """Two of 25 nations give bad lines: too few fields, or no number."""
    number = F.col("c_acctbal").cast("decimal(12,2)").cast("string")
    second = F.when(F.col("c_nationkey") == 3, F.lit("unknown")).otherwise(F.concat(F.lit("  "), number, F.lit(" ")))
    third = F.when(F.col("c_nationkey") == 7, F.lit("")).otherwise(F.lit(",0.1"))
    line = F.concat(F.lit('"'), name, F.lit(' (X YY)",'), second, third)
    return _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("line_no"), line.alias("value"))


def q_score_parse(spark, sf_dir):
    lines = _score_lines(spark, sf_dir, F.col("c_name"))
    return bands.parse_score_lines(lines).select("author", "score")


def q_score_last_wins(spark, sf_dir):
    name = F.concat("c_mktsegment", F.col("c_nationkey").cast("string"))
    return bands.score_last_wins(bands.parse_score_lines(_score_lines(spark, sf_dir, name)))


def q_tokenize(spark, sf_dir):
    return tokens.tokenize(_documents(spark, sf_dir).drop("author"))


def q_stopword_filter(spark, sf_dir):
    return tokens.remove_stopwords(q_tokenize(spark, sf_dir), STOPWORDS)


def q_stopword_anti_join(spark, sf_dir):
    """The same with the list as a table."""
    listed = spark.createDataFrame([(word,) for word in STOPWORDS], "token string")
    return tokens.remove_stopwords(q_tokenize(spark, sf_dir), listed)


def q_stem_vocabulary(spark, sf_dir):
    return tokens.stem_vocabulary(_documents(spark, sf_dir))


def q_doc_term_forms(spark, sf_dir):
    forms = index.doc_term_forms(_documents(spark, sf_dir), stopwords=STOPWORDS)
    return forms.select("doc_id", "term", "token")


def q_document_frequency(spark, sf_dir):
    return index.document_frequency(_documents(spark, sf_dir), stopwords=STOPWORDS)


def q_term_forms(spark, sf_dir):
    return _shown(index.term_forms(_documents(spark, sf_dir), stopwords=STOPWORDS), "term", "forms")


def q_term_forms_skip_first_doc(spark, sf_dir):
    forms = index.term_forms(_documents(spark, sf_dir), stopwords=STOPWORDS, forms="skip_first_doc")
    return _shown(forms, "term", "forms")


def q_idf(spark, sf_dir, variant="collection"):
    table = index.document_frequency(_documents(spark, sf_dir), stopwords=STOPWORDS)
    n_docs = index.count_documents(_table(spark, sf_dir, "documents"))
    return _shown(index.with_idf(table, n_docs, variant), "term", "df", "idf")


def q_idf_bm25(spark, sf_dir):
    return q_idf(spark, sf_dir, "bm25")


def q_score_density(spark, sf_dir):
    curve = density.score_density(_table(spark, sf_dir, "supplier"), "s_acctbal")
    return curve.select(F.round("x", 6).alias("x"), F.round("density", 12).alias("density"), F.round("cdf", 9).alias("cdf"))


def q_density_thirds(spark, sf_dir, **steps):
    thirds = density.density_thirds(_table(spark, sf_dir, "supplier"), "s_acctbal", **steps)
    return thirds.select(F.round("lower", 6).alias("lower"), F.round("upper", 6).alias("upper"))


def q_density_thirds_stepped(spark, sf_dir):
    return q_density_thirds(spark, sf_dir, **STEPS)


def q_score_band(spark, sf_dir):
    scored = bands.banded_scores(settle(_scores(spark, sf_dir)))
    return scored.select(F.col("author").alias("source"), F.round("score", 6).alias("score"), "band")


def q_band_sizes(spark, sf_dir):
    return bands.band_sizes(_corpus(spark, sf_dir))


def q_banded_corpus(spark, sf_dir):
    return _corpus(spark, sf_dir).select("doc_id", "band")


def q_idf_by_band(spark, sf_dir):
    return _shown(_idf_table(spark, sf_dir), "band", "term", "df", "idf", "forms")


def q_idf_by_band_drop_last_term(spark, sf_dir):
    return _shown(_idf_table(spark, sf_dir, drop_last_term=True), "band", "term", "df", "idf")


def q_idf_by_band_skip_first_doc(spark, sf_dir):
    return _shown(_idf_table(spark, sf_dir, forms="skip_first_doc"), "band", "term", "df", "idf", "forms")


def q_idf_report(spark, sf_dir):
    return contrast.idf_report(_idf_table(spark, sf_dir), digits=9).select("band", "line")


def q_topk_terms(spark, sf_dir):
    return _shown(contrast.topk_terms(_idf_table(spark, sf_dir)), "band", "rk", "term", "idf")


def q_distinctive_terms(spark, sf_dir):
    return _shown(_distinctive(spark, sf_dir), "band", "term", "idf", "forms")


def q_top_words(spark, sf_dir):
    return _shown(contrast.top_words(_distinctive(spark, sf_dir), TOP_BAND, TOP_N), "word", "idf")


def q_phrases(spark, sf_dir):
    """Pairs of stems that belong together, and how often documents keep them whole."""
    found = phrases.phrases_in(_documents(spark, sf_dir), stopwords=STOPWORDS)
    return found.select("first", "second", "n", F.round("score", 4).alias("score"), "taken")


def q_term_ids(spark, sf_dir):
    """A dictionary of half of the documents, grown by the other half: old ids stay."""
    docs = _documents(spark, sf_dir)
    half = term_ids.new_words(docs.where("doc_id % 2 = 0"), None, STOPWORDS)
    rest = term_ids.new_words(docs.where("doc_id % 2 = 1"), half, STOPWORDS)
    return half.unionByName(rest).select("term", "term_id", "token", "token_id")


def q_document_frequency_by_ids(spark, sf_dir):
    """Frequencies per band from documents as arrays of term ids: no text is shuffled."""
    corpus = _corpus(spark, sf_dir)
    dictionary = term_ids.new_words(corpus, None, STOPWORDS)
    return term_ids.frequency_by_ids(corpus, dictionary, ("band",), STOPWORDS)


def q_suspect_sample(spark, sf_dir):
    """Documents of sources that have no score, corpus lines that cannot be read, and terms in
    more documents than the collection is said to have."""
    docs = _documents(spark, sf_dir)
    few = _scores(spark, sf_dir).where("author NOT LIKE '%1%'")
    lines = _corpus_lines(spark, sf_dir)
    table = index.idf_by_band(_corpus(spark, sf_dir), N_DOCS_SAID, STOPWORDS)
    return samples.suspect_sample(
        {
            "unscored": samples.unscored(docs, few),
            "bad line": samples.bad_lines(lines),
            "undefined idf": samples.undefined_idf(table),
        }
    )


def q_cut_stability(spark, sf_dir):
    found = stability.cut_stability(_table(spark, sf_dir, "supplier"), "s_acctbal")
    return found.select("cut", *(F.round(c, 6).alias(c) for c in ("value", "low", "high", "mean", "sd")), "undefined")


def q_idf_letters(spark, sf_dir):
    """The IDF table with another analyser: words of letters of any script, without stems."""
    return _shown(_idf_table(spark, sf_dir, analyser=LETTERS), "band", "term", "df", "idf", "forms")


def q_phrases_letters(spark, sf_dir):
    found = phrases.phrases_in(_documents(spark, sf_dir), stopwords=STOPWORDS, analyser=LETTERS)
    return found.select("first", "second", "n", F.round("score", 4).alias("score"), "taken")


def q_idf_incremental(spark, sf_dir):
    """Merged from three batches, of which one was written with documents that do not belong
    there, and then again without them."""
    corpus = _corpus(spark, sf_dir)
    path = f"{scratch_folder(spark)}/idf-{uuid.uuid4().hex}"
    for k in range(3):
        batch = corpus.where(F.pmod("doc_id", F.lit(3)) == k)
        if k == 1:
            strangers = batch.withColumn("doc_id", F.col("doc_id") + STRANGERS)
            both = batch.unionByName(strangers)
            incremental.put_batch(both, path, "1", stopwords=STOPWORDS)
            batch = incremental.without_documents(both, strangers)
        incremental.put_batch(batch, path, str(k), stopwords=STOPWORDS)
    return _shown(incremental.stored_idf(spark, path), "band", "term", "df", "idf", "forms")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name.removeprefix("q_"): query for name, query in globals().items() if name.startswith("q_")}
