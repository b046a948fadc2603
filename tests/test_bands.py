import math
import re

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from bandlex.operators.bands import (
    band_sizes,
    banded_corpus,
    banded_scores,
    parse_score_lines,
    score_band,
    score_last_wins,
    unscored_documents,
)
from bandlex.operators.index import document_frequency


def test_score_lines(spark):
    lines = [
        'name,Mean,SD',
        '"DOE (X YY)",-1.25,0.1',
        '"ROE (X YY)" ,  2.5  ,',
        '"POE (X YY)",3.5',
        '"LOW (X YY)",n/a,1',
        '"EXP (X YY)",1e2,1',
        '"NAN (X YY)",NaN,1',
        '"INF (X YY)",inf,1',
        ',1.0,1',
        "",
    ]
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    found = {r.author: r.score for r in parse_score_lines(df).collect()}
    assert math.isnan(found.pop("NAN"))
    assert found == {"DOE": -1.25, "ROE": 2.5, "EXP": 100.0}


def test_last_score_wins(spark):
    df = spark.createDataFrame([("A", 1.0, 0), ("B", 2.0, 1), ("A", 2.0, 2)], "author string, score double, line_no int")
    assert {(r.author, r.score) for r in score_last_wins(df).collect()} == {("A", 2.0), ("B", 2.0)}
    with pytest.raises(SparkRuntimeException, match="shared"):
        score_last_wins(df, unique_scores="error").collect()
    single = score_last_wins(df.where("author = 'A'"), unique_scores="error")
    assert [(r.author, r.score) for r in single.collect()] == [("A", 2.0)]


def test_band_edges(spark):
    values = [-0.66, -0.65, 0.60, 0.61, float("nan"), None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, score double")
    rows = df.select("i", score_band(F.col("score"), -0.65, 0.61).alias("band")).orderBy("i").collect()
    assert [r.band for r in rows] == ["LOW", "MID", "MID", "HIGH", "HIGH", None]
    for lower, upper in ((0.61, -0.65), (float("nan"), 1.0), (0.0, float("nan"))):
        with pytest.raises(ValueError):
            score_band(F.col("score"), lower, upper)


@pytest.fixture
def docs(spark):
    # one author holds most of the documents
    rows = [(i, "HOT" if i % 10 else f"A{i}", f"text {i}") for i in range(200)]
    return spark.createDataFrame(rows, "doc_id bigint, author string, text string")


@pytest.fixture
def scores(spark):
    rows = [("HOT", 0.0)] + [(f"A{i}", i / 100 - 1) for i in range(0, 200, 10)]
    return spark.createDataFrame(rows, "author string, score double")


def test_missing_author(spark, docs, scores):
    some = banded_scores(scores.where("author <> 'A50'"), (-0.5, 0.5))
    with pytest.raises(SparkRuntimeException, match="no score for author A50"):
        banded_corpus(docs, some).collect()
    assert banded_corpus(docs, some, on_missing="quarantine").count() == 199
    assert [r.doc_id for r in unscored_documents(docs, some).collect()] == [50]


@pytest.mark.parametrize("on_missing", ["error", "quarantine"])
def test_shuffled_join_gives_the_same(spark, docs, scores, on_missing):
    banded = banded_scores(scores, (-0.5, 0.5))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = banded_corpus(docs, banded, on_missing)
        large = banded_corpus(docs, banded, on_missing, max_broadcast_bytes=0)
        plan = large._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in plan
        # the skewed key moves ids only; grouping by document adds no further exchange
        frequencies = document_frequency(large, ["band"])
        exchanges = re.findall(r"Exchange hashpartitioning\((\w+)#", frequencies._jdf.queryExecution().executedPlan().toString())
        assert sorted(exchanges) == ["author", "author", "band", "doc_id", "doc_id"]
        assert sorted(small.collect()) == sorted(large.collect())
        assert sorted(frequencies.collect()) == sorted(document_frequency(small, ["band"]).collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(r.n for r in band_sizes(small).collect()) == 200


def test_cuts_from_density(scores):
    bands = {r.author: r.band for r in banded_scores(scores).collect()}
    assert bands["A0"] == "LOW" and bands["HOT"] == "MID" and bands["A190"] == "HIGH"


def test_scores_that_are_not_finite(spark, scores):
    cuts = {r.author: r.band for r in banded_scores(scores).collect()}
    odd = [("MOST", float("inf")), ("LEAST", float("-inf")), ("NAN", float("nan")), ("NONE", None)]
    more = scores.unionByName(spark.createDataFrame(odd, "author string, score double"))
    found = {r.author: r.band for r in banded_scores(more).collect()}
    expected = {"MOST": "HIGH", "LEAST": "LOW", "NAN": "HIGH", "NONE": None}
    assert found == cuts | expected
