import pytest

from bandlex.functions.analysis import LETTERS, STEMS
from bandlex.operators import term_ids
from bandlex.operators.index import document_frequency, idf_by_band
from bandlex.operators.row_lookup import row_lookup
from bandlex.operators.tokens import remove_stopwords, tokenize
from fixed_words import STOP
from pyspark.sql import functions as F


@pytest.fixture
def docs(spark):
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}{end}" for i in range(80) for end in ("x", "xing", "xes")]
    rows = [(d, "AB"[d % 2], " ".join(words[(d * d + 7 * i) % len(words)] for i in range(d % 40))) for d in range(120)]
    rows += [(500, "A", None), (501, "B", ""), (502, "B", "- - the")]
    return spark.createDataFrame(rows, "doc_id long, band string, text string").repartition(3)


def as_set(table):
    return sorted(map(tuple, table.collect()))


def test_lookup_in_a_row(spark):
    table = spark.createDataFrame([(f"k{i}", i) for i in range(300)] + [("", 300)], "key string, id long")
    rows = spark.createDataFrame([(1, ["k3", "none", "", "k299", None, "k3"]), (2, []), (3, None)], "n int, words array<string>")
    found = {r.n: r.found for r in row_lookup(rows, "words", "found", table).collect()}
    assert [x.id for x in found[1]] == [3, None, 300, 299, None, 3] and found[2] == [] and found[3] is None
    with pytest.raises(ValueError, match="above the bound"):
        row_lookup(rows, "words", "found", table, max_bytes=1000)
    empty = row_lookup(rows, "words", "found", table.limit(0)).where("n = 1").first()
    assert [x.id for x in empty.found] == [None] * 6


@pytest.mark.parametrize("analyser", [STEMS, LETTERS])
@pytest.mark.parametrize("max_bytes", [64 << 20, 4000, 0])
def test_frequency_by_ids(docs, analyser, max_bytes):
    """With all terms in the lookup table, with the frequent ones only, and with none."""
    dictionary = term_ids.new_words(docs, None, STOP, analyser=analyser)
    for by in ((), ("band",)):
        expected = document_frequency(docs, by, STOP, analyser=analyser).select(*by, "term", "df")
        assert as_set(term_ids.frequency_by_ids(docs, dictionary, by, STOP, analyser=analyser, max_bytes=max_bytes)) == as_set(expected)


def test_stop_words_as_a_table(spark, docs):
    table = spark.createDataFrame([(w,) for w in (*STOP, "waax")], "token string")
    dictionary = term_ids.new_words(docs)
    expected = document_frequency(docs, (), table).select("term", "df")
    assert as_set(term_ids.frequency_by_ids(docs, dictionary, (), table)) == as_set(expected)


def test_the_text_is_not_shuffled(docs):
    dictionary = term_ids.new_words(docs, None, STOP)
    plan = term_ids.frequency_by_ids(docs.coalesce(1), dictionary, (), STOP)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    for line in plan.splitlines():
        assert "Exchange" not in line or ("doc_id" not in line and "text" not in line)


def test_ids_are_dense_and_stay(spark, docs, tmp_path):
    path = str(tmp_path / "words")
    first = as_set(term_ids.append_dictionary(docs.where("doc_id < 30"), path, stopwords=STOP))
    second = as_set(term_ids.append_dictionary(docs, path, stopwords=STOP))
    third = as_set(term_ids.append_dictionary(docs, path, stopwords=STOP))
    assert set(first) < set(second) and second == third
    rows = term_ids.read_dictionary(spark, path).collect()
    assert sorted(r.token_id for r in rows) == list(range(len(rows)))
    terms = {r.term: r.term_id for r in rows}
    assert sorted(terms.values()) == list(range(len(terms))) and {(r.term, r.term_id) for r in rows} == set(terms.items())
    expected = document_frequency(docs, (), STOP).select("term", "df")
    assert as_set(term_ids.frequency_by_ids(docs, term_ids.read_dictionary(spark, path), (), STOP)) == as_set(expected)


def test_encoded_documents(docs):
    dictionary = term_ids.new_words(docs)
    rows = term_ids.encode_documents(docs, dictionary).collect()
    assert len(rows) == 123 and all(r.ids == sorted(set(r.ids)) and r.rest == [] for r in rows if r.doc_id != 500)


def test_another_analyser_leaves_the_rest_as_it_is(spark):
    docs = spark.createDataFrame(
        [(1, "A", "Été-2024: l'été, ÉTÉS don't"), (2, "A", "étés"), (3, "B", "x")], "doc_id long, band string, text string"
    )
    found = {r.term: (r.df, r.forms) for r in idf_by_band(docs, analyser=LETTERS, stopwords=["don't"], normalize=True).collect()}
    assert found == {"été": (1, ["été"]), "étés": (2, ["étés"]), "don": (1, ["don"])}
    plan = idf_by_band(docs, analyser=LETTERS)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    words = tokenize(docs.where("doc_id = 1"), analyser=LETTERS).where(F.col("token") == "été")
    assert [r.pos for r in words.orderBy("pos").collect()] == [0, 2]
    assert remove_stopwords(words, ["É.té"], normalize=True, analyser=LETTERS).collect() == []


def test_texts_are_encoded_once_for_ids_and_rare_words(spark, docs):
    dictionary = term_ids.new_words(docs, None, STOP)
    expected = as_set(document_frequency(docs, ("band",), STOP).select("band", "term", "df"))
    read = spark.sparkContext.accumulator(0)

    def seen(text):
        read.add(1)
        return text

    counted = docs.withColumn("text", F.udf(seen, "string")("text"))
    found = term_ids.frequency_by_ids(counted, dictionary, ("band",), STOP, max_bytes=4000)
    assert as_set(found) == expected and read.value == 123
