import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from bandlex.functions.text import author_from_file_name, normalize_text
from bandlex.operators.bands import parse_corpus_lines
from bandlex.operators.tokens import remove_stopwords, stem_tokens, tokenize


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "text string").select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "text, expected",
    [
        ("a\tb  c", "a b c"),
        ("a\r\nb\rc\n", "a b c"),
        ("a\n\nb", "a  b"),
        ("a \n \t \n b", "a  b"),
        ("  \x01 a\x0b\x0cb \x1f\n c\x01d ", "a b c\x01d"),
        ("", ""),
        ("\n\n", ""),
        ("a  b", "a  b"),
    ],
)
def test_normalize_text(spark, text, expected):
    assert one(spark, text, normalize_text(F.col("text"))) == expected


@pytest.mark.parametrize(
    "name, last, full",
    [
        ("Ann-Example_12012010_001.txt", "EXAMPLE", "ANN-EXAMPLE"),
        ("Jo-Sample-11242010_002.txt", "SAMPLE", "JO-SAMPLE"),
        (" Kit - Other _083182010_001.txt", "OTHER", "KIT-OTHER"),
        ("Nobody_1.txt", None, None),
    ],
)
def test_author_from_file_name(spark, name, last, full):
    assert one(spark, name, author_from_file_name(F.col("text"))) == last
    assert one(spark, name, author_from_file_name(F.col("text"), "full_name")) == full


def words(spark, text, stop=("the", "a", "is", "in")):
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    rows = stem_tokens(remove_stopwords(tokenize(docs), stop)).orderBy("pos").collect()
    return [(r.token, r.term) for r in rows]


def test_sentences(spark):
    assert words(spark, "Rain fell in a garden; the gate is open.") == [
        ("rain", "rain"), ("fell", "fell"), ("garden", "garden"), ("gate", "gate"), ("open", "open"),
    ]
    assert words(spark, "Who is it!?--//  a. bird, calling ...") == [
        ("who", "who"), ("bird", "bird"), ("calling", "call"),
    ]


@pytest.mark.parametrize(
    "text, tokens",
    [
        ("re-elect", ["elect"]),
        ("U.S.", []),
        ("2010", []),
        ("don't", ["dont"]),
        ("", []),
        (None, []),
        ("one\ftwo three four", ["onetwo", "threefour"]),
        ("naïve CAFÉS", ["nave", "cafs"]),
        ("Kelvin TİP", ["kelvin", "tip"]),
        ("line\r\nbreak\ttab", ["line", "break", "tab"]),
    ],
)
def test_tokens(spark, text, tokens):
    assert [token for token, _ in words(spark, text)] == tokens


def test_positions_count_pieces(spark):
    docs = spark.createDataFrame([(1, "ab  cat-dog x")], "doc_id bigint, text string")
    assert [(r.pos, r.token) for r in tokenize(docs).orderBy("pos").collect()] == [(2, "cat"), (3, "dog")]


def test_stopwords_as_list_and_table(spark):
    docs = spark.createDataFrame([(1, "Don't stop the cat")], "doc_id bigint, text string")
    table = spark.createDataFrame([("THE",), ("don't",), ("the",)], "token string")
    for stop in (["THE", "don't"], table):
        assert {r.token for r in remove_stopwords(tokenize(docs), stop).collect()} == {"dont", "stop", "cat"}
        assert {r.token for r in remove_stopwords(tokenize(docs), stop, normalize=True).collect()} == {"stop", "cat"}


def test_corpus_lines(spark):
    lines = spark.createDataFrame([("7\tone\ttwo ",), ("no tab",), ("x1\ttext",), ("+8\tb",), (" 9\tc",)], "value string")
    good = {(r.doc_id, r.text) for r in parse_corpus_lines(lines, on_bad="drop").collect()}
    assert good == {(7, "one\ttwo"), (8, "b")}
    kept = {(r.doc_id, r.text) for r in parse_corpus_lines(lines, on_bad="quarantine").collect()}
    assert kept == good | {(None, "no tab"), (None, "x1\ttext"), (None, " 9\tc")}
    with pytest.raises(SparkRuntimeException, match="bad corpus line"):
        parse_corpus_lines(lines).collect()
