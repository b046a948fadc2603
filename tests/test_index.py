import math
import random
from collections import defaultdict

import pytest

from bandlex.functions.text import idf
from bandlex.operators.contrast import distinctive_terms, idf_report, top_words, topk_terms
from bandlex.operators.index import document_frequency, doc_term_forms, idf_by_band, term_forms, term_statistics
from fixed_words import STOP
from porter import stem
from pyspark.sql import functions as F

# term, df, forms, forms without the first document
THREE_DOCS = """boat 2|boats|boats
dawn 1|dawn|
harbour 2|harbour harbours|harbours
lamp 2|lamps lamp|lamps
nobodi 2|nobody|nobody
old 1|old|
paint 2|paints painting painted|painting painted
pier 1|pier|
said 1|said|
sleep 2|sleeps sleeping|sleeping"""
EXPECTED = {}
for line in THREE_DOCS.splitlines():
    head, everything, later = line.split("|")
    term, df = head.split()
    EXPECTED[term] = int(df), everything.split(), later.split()


def test_three_documents(spark, three_docs):
    stats = {r.term: (r.df, r.forms) for r in term_statistics(three_docs, stopwords=STOP).collect()}
    assert stats == {t: (df, forms) for t, (df, forms, _) in EXPECTED.items()}
    dfs = {r.term: r.df for r in document_frequency(three_docs, stopwords=STOP).collect()}
    assert dfs == {t: df for t, (df, _, _) in EXPECTED.items()}
    forms = {r.term: r.forms for r in term_forms(three_docs, stopwords=STOP).collect()}
    assert forms == {t: f for t, (_, f, _) in EXPECTED.items()}
    later = {r.term: r.forms for r in term_forms(three_docs, stopwords=STOP, forms="skip_first_doc").collect()}
    assert later == {t: f for t, (_, _, f) in EXPECTED.items()}


def test_forms_of_a_term_in_one_document_are_distinct(spark, three_docs):
    rows = doc_term_forms(three_docs, stopwords=STOP).where("doc_id = 1 and term = 'lamp'").collect()
    assert sorted(r.token for r in rows) == ["lamp", "lamps"]


def test_idf_table_and_switches(spark, three_docs):
    corpus = three_docs.withColumn("band", F.lit("MID"))
    rows = {r.term: r for r in idf_by_band(corpus, stopwords=STOP).collect()}
    assert math.isclose(rows["lamp"].idf, math.log10(1.5 / 3.5)) and round(rows["lamp"].idf, 9) == -0.367976785
    assert round(rows["dawn"].idf, 9) == -0.146128036
    changed = idf_by_band(corpus, 10, STOP, forms="skip_first_doc", drop_last_term=True)
    found = {r.term: r for r in changed.collect()}
    assert set(found) == set(EXPECTED) - {"sleep"}
    assert {t: r.forms for t, r in found.items()} == {t: EXPECTED[t][2] for t in found}
    assert math.isclose(found["lamp"].idf, math.log10(8.5 / 10.5))


def test_idf_values(spark):
    df = spark.createDataFrame([(1,), (10,), (11,)], "df bigint")
    low, full, beyond = (r.x for r in df.orderBy("df").select(idf(10, F.col("df")).alias("x")).collect())
    assert math.isclose(low, math.log10(9.5 / 10.5)) and math.isclose(full, math.log10(0.5 / 10.5))
    assert math.isnan(beyond)
    bm25 = df.orderBy("df").select(idf(10, F.col("df"), "bm25").alias("x")).first().x
    assert math.isclose(bm25, math.log10(9.5 / 1.5))


@pytest.fixture(scope="module")
def random_corpus(spark):
    rng = random.Random(1)
    vocabulary = [b + e for b in ("walk", "relat", "hop", "nation", "cat") for e in ("", "s", "ed", "ing", "ional")]
    rows = []
    for i in range(300):
        # one band holds most documents, one word most of the text
        band = "A" if rng.random() < 0.8 else rng.choice("BC")
        words = ["cats"] * rng.randint(0, 5) + rng.choices(vocabulary, k=rng.randint(0, 12))
        rng.shuffle(words)
        rows.append((i * 7 % 307, band, " ".join(words)))
    return rows, spark.createDataFrame(rows, "doc_id bigint, band string, text string").cache()


def brute_force(rows):
    docs, seen = defaultdict(set), defaultdict(dict)
    for doc_id, band, text in sorted(rows):
        for pos, token in enumerate(text.split()):
            term = stem(token)
            docs[band, term].add(doc_id)
            seen[band, term].setdefault(token, (doc_id, pos))
    return {
        key: (len(ids), [token for token, _ in sorted(seen[key].items(), key=lambda item: item[1])])
        for key, ids in docs.items()
    }


def test_bands_against_brute_force(random_corpus):
    rows, corpus = random_corpus
    expected = brute_force(rows)
    table = idf_by_band(corpus).collect()
    assert {(r.band, r.term): (r.df, r.forms) for r in table} == expected
    assert all(math.isclose(r.idf, math.log10((300 - r.df + 0.5) / 300.5)) for r in table)
    split = document_frequency(corpus, ["band"], colocated=True).collect()
    assert {(r.band, r.term): r.df for r in split} == {key: df for key, (df, _) in expected.items()}


@pytest.fixture
def table(spark):
    rows = [("A", "x", -0.3), ("A", "a", -0.2), ("A", "b", -0.2), ("A", "c", -0.2), ("A", "n", float("nan"))]
    rows += [("B", "x", -0.4), ("B", "y", -0.3), ("B", "z", -0.1), ("C", "x", -0.5), ("C", "y", -0.2)]
    rows = [(band, term, 1, value, [term + "s", term]) for band, term, value in rows]
    return spark.createDataFrame(rows, "band string, term string, df bigint, idf double, forms array<string>")


def test_top_terms_and_ties(table):
    top = {(r.band, r.rk): r.term for r in topk_terms(table, 2).collect()}
    assert top == {("A", 1): "x", ("A", 2): "a", ("B", 1): "x", ("B", 2): "y", ("C", 1): "x", ("C", 2): "y"}
    assert topk_terms(table, 99).where("term = 'n'").first().rk == 5


def test_large_k_is_ranked_in_slices_first(spark, table):
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "1")
    try:
        sliced = topk_terms(table, 3).collect()
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    assert sorted(map(str, sliced)) == sorted(map(str, topk_terms(table, 3).collect()))


def test_terms_of_one_band_only(table):
    kept = distinctive_terms(topk_terms(table, 3)).collect()
    assert [(r.band, r.term) for r in kept] == [("A", "a"), ("A", "b"), ("B", "z")]
    words = top_words(distinctive_terms(topk_terms(table, 3)), "A", 5).collect()
    assert [r.word for r in words] == ["bs", "as"]
    assert [r.word for r in top_words(distinctive_terms(topk_terms(table, 3)), "A", 1).collect()] == ["bs"]


def test_report_order_and_lines(table):
    report = idf_report(table.where("band = 'A'")).collect()
    assert [r.term for r in report] == ["x", "a", "b", "c", "n"]
    assert report[0].line == "-0.3\tx\txs x"
    assert idf_report(table, 3).where("band = 'C'").first().line == "-0.500\tx\txs x"


def test_switches_read_and_shuffle_the_text_once(spark, tmp_path, three_docs):
    # from files, so that a scan shows
    three_docs.selectExpr("*", "'A' AS band").write.parquet(str(tmp_path / "corpus"))
    corpus = spark.read.parquet(str(tmp_path / "corpus"))
    skipped = idf_by_band(corpus, 3, STOP, forms="skip_first_doc")
    skipped.collect()
    plan = skipped._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    scans = [line for line in plan.splitlines() if "Scan parquet" in line]
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning(doc_id" in line and "Reused" not in line]
    assert len(scans) == len(shuffles) == 1
    # the greatest term is looked up in what has been settled
    dropped = idf_by_band(corpus, 3, STOP, drop_last_term=True)
    plan = dropped._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" not in plan.split("InMemoryRelation")[0]


def test_stop_words_as_written(spark):
    docs = spark.createDataFrame([(1, "A", "don't walk")], "doc_id bigint, band string, text string")
    assert {r.term for r in idf_by_band(docs, stopwords=["don't"]).collect()} == {"dont", "walk"}
    assert {r.term for r in idf_by_band(docs, stopwords=["don't"], normalize=True).collect()} == {"walk"}
    assert [r.term for r in document_frequency(docs, stopwords=["don't"], normalize=True).collect()] == ["walk"]


def test_a_task_has_a_bounded_share_of_the_text(three_docs):
    """The number of tasks follows the size of the texts, not the settings of a shuffle."""
    from bandlex.operators import index

    many = three_docs.unionByName(three_docs.withColumn("doc_id", three_docs.doc_id + 10))
    for docs, factor in ((three_docs, 1), (many, 2)):
        size = sum(len(r.text) for r in docs.collect())
        dealt = index._colocate(docs, (), False, per_task=10)
        assert dealt.rdd.getNumPartitions() == -(-size // 10) > 4 * factor
