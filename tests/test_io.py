import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from bandlex import build_corpus, run
from bandlex.operators.contrast import distinctive_terms, idf_report, topk_terms
from bandlex.operators.index import document_frequency, idf_by_band
from bandlex.sources import readers, writers


@pytest.fixture
def speeches(tmp_path):
    folder = tmp_path / "speeches"
    (folder / "nested").mkdir(parents=True)
    (folder / "nested" / "Deep-File_1.txt").write_text("not read")
    for i in range(12):
        name = ("Ann-Low", "Bo-Mid", "Cy-High")[i % 3]
        own = ("apples", "bridges", "candles")[i % 3]
        (folder / f"{name}_0101_{i:03}.txt").write_text(f"Dear all,\r\n\tthe {own}  are good\n\nwords {i}.\n")
    return str(folder)


@pytest.fixture
def score_file(tmp_path):
    path = tmp_path / "scores.csv"
    path.write_text('name,Mean,SD\n"LOW (X YY)",5.0,0.1\n"LOW (X YY)",-1.0,0.1\n"MID (X YY)", 0.0,0.1\n"HIGH (X YY)",1.0,0\n')
    return str(path)


def test_documents(spark, speeches):
    rows = readers.read_documents(spark, speeches).collect()
    assert sorted(r.doc_id for r in rows) == list(range(12))
    assert {r.author for r in rows} == {"LOW", "MID", "HIGH"}
    assert {r.text for r in rows if r.file_name.endswith("000.txt")} == {"Dear all, the apples are good  words 0."}
    again = readers.read_documents(spark, speeches, key="full_name").collect()
    assert {r.file_name: r.doc_id for r in again} == {r.file_name: r.doc_id for r in rows}
    assert {r.author for r in again} == {"ANN-LOW", "BO-MID", "CY-HIGH"}


def test_ids_move_no_text(spark, speeches):
    plan = readers.read_documents(spark, speeches)._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        assert "Exchange" not in line or "value" not in line
    assert "Sort" not in plan.split("InMemoryRelation")[0] or "value" not in plan.split("Sort")[0]
    rows = readers.read_documents(spark, speeches).collect()
    assert [r.file_name for r in sorted(rows, key=lambda r: r.doc_id)] == sorted(r.file_name for r in rows)


def test_corpus_files_lose_no_text(spark, tmp_path):
    rows = [(1, "A", "alpha\tbeta\n\ngamma\r\n7\tepsilon "), (2, "A", None), (3, "B", "plain")]
    corpus = spark.createDataFrame(rows, "doc_id bigint, band string, text string")
    writers.write_corpus(corpus, str(tmp_path / "c"))
    found = readers.read_corpus(spark, str(tmp_path / "c")).collect()
    assert {r.doc_id: r.text for r in found} == {1: "alpha beta  gamma 7 epsilon", 2: "", 3: "plain"}
    (tmp_path / "c" / "band=A" / "part-extra.txt").write_text("no tab\n")
    with pytest.raises(SparkRuntimeException, match="bad corpus line"):
        readers.read_corpus(spark, str(tmp_path / "c")).collect()


def test_full_names(spark, speeches, tmp_path):
    (tmp_path / "s.csv").write_text('"ANN-LOW (X YY)",-1.0,0\n"BO-MID (X YY)",0.0,0\n"CY-HIGH (X YY)",1.0,0\n')
    docs = readers.read_documents(spark, speeches, key="full_name")
    corpus = build_corpus(docs, readers.read_scores(spark, str(tmp_path / "s.csv")), (-0.5, 0.5))
    assert {(r.author, r.band) for r in corpus.collect()} == {("ANN-LOW", "LOW"), ("BO-MID", "MID"), ("CY-HIGH", "HIGH")}
    (tmp_path / "t.csv").write_text("Low; Ann,-1.0,0\nMid; Bo,0.0,0\nHigh; Cy,1.0,0\n")
    other = readers.read_scores(
        spark,
        str(tmp_path / "t.csv"),
        author=lambda field: F.upper(F.concat_ws("-", F.element_at(F.split(field, "; "), 2), F.element_at(F.split(field, "; "), 1))),
    )
    assert build_corpus(docs, other, (-0.5, 0.5)).count() == 12


def test_switches_through_the_whole_way(spark, speeches, score_file):
    docs, scores = readers.read_documents(spark, speeches), readers.read_scores(spark, score_file)

    def found(**switches):
        return {r.term: r for r in run(docs, scores, ["the", "a'r-e"], (-0.65, 0.61), **switches).collect()}

    plain = found()
    assert "appl" in plain and found(variant="bm25")["appl"].idf != plain["appl"].idf
    assert found(forms="skip_first_doc")["appl"].forms == ["apples"]
    assert found(colocated=True).keys() == plain.keys()
    assert found(normalize=True).keys() == plain.keys()
    assert "appl" in found(drop_last_term=True)


def test_dense_ids_of_many_keys(spark):
    rows = spark.range(5000).select(F.concat(F.lit("file"), "id").alias("k"))
    assert sorted(r.doc_id for r in readers.dense_ids(rows, "k").collect()) == list(range(5000))


def test_score_files(spark, score_file):
    assert {r.author: r.score for r in readers.read_scores(spark, score_file).collect()} == {"LOW": -1.0, "MID": 0.0, "HIGH": 1.0}
    assert sorted(r.score for r in readers.read_score_column(spark, score_file).collect()) == [-1.0, 0.0, 1.0, 5.0]


def test_stopword_file(spark, tmp_path):
    (tmp_path / "stop.txt").write_text("The\nARE\n\n")
    assert {r.token for r in readers.read_stopwords(spark, str(tmp_path / "stop.txt")).collect()} == {"the", "are"}


def test_from_files_to_report(spark, speeches, score_file, tmp_path):
    docs, scores = readers.read_documents(spark, speeches), readers.read_scores(spark, score_file)
    labels = ("LEFT", "CENTER", "RIGHT")
    corpus = build_corpus(docs, scores, (-0.65, 0.61), labels)
    out = {name: str(tmp_path / name) for name in ("corpus", "idf", "sorted", "report")}

    for _ in range(2):  # the second run replaces the first
        writers.write_corpus(corpus, out["corpus"])
    stored = readers.read_corpus(spark, out["corpus"])
    assert sorted(stored.collect()) == sorted(corpus.select("doc_id", "band", "text").collect())

    table = idf_by_band(stored, stopwords=["the", "are"])
    writers.write_idf(table, out["idf"])
    back = readers.read_idf(spark, out["idf"])
    columns = ["band", "term", "idf", "forms"]
    assert sorted(back.select(columns).collect()) == sorted(table.select(columns).collect())
    writers.write_idf_report(table, out["sorted"])
    for label in labels:
        files = sorted((tmp_path / "sorted" / f"band={label}").glob("part-*"))
        terms = [line.split("\t")[1] for file in files for line in file.read_text().splitlines()]
        assert terms == [r.term for r in idf_report(table.where(F.col("band") == label)).collect()]

    kept = distinctive_terms(topk_terms(back))
    assert {(r.band, r.term) for r in kept.collect()} == {("LEFT", "appl"), ("CENTER", "bridg"), ("RIGHT", "candl")}
    writers.write_report(kept, out["report"])
    assert sorted(readers.read_report(spark, out["report"]).collect()) == sorted(kept.select("band", "idf", "term", "forms").collect())
    lines = [line for file in sorted((tmp_path / "report").glob("part-*")) for line in file.read_text().splitlines()]
    assert [line.split("\t")[2] for line in lines] == ["appl", "bridg", "candl"]
    whole = run(docs, scores, ["the", "are"], (-0.65, 0.61), labels=labels).select("band", "idf", "term", "forms")
    assert sorted(whole.collect()) == sorted(kept.select("band", "idf", "term", "forms").collect())


def test_empty_forms_survive_a_round_trip(spark, tmp_path):
    table = spark.createDataFrame([("A", -0.1, "x", [])], "band string, idf double, term string, forms array<string>")
    writers.write_idf(table, str(tmp_path / "idf"))
    assert readers.read_idf(spark, str(tmp_path / "idf")).first().forms == []


def exchanges(df):
    """Exchanges of the initial plan, without those of subqueries."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange" in line and "Broadcast" not in line]


def test_bucketed_corpus_needs_no_shuffle_of_text(spark, tmp_path):
    corpus = spark.createDataFrame([(i, "A", f"cats dogs cat {i}") for i in range(50)], "doc_id bigint, band string, text string")
    spark.sql("CREATE DATABASE IF NOT EXISTS bucketed LOCATION '%s'" % (tmp_path / "db"))
    writers.write_corpus_table(corpus, "bucketed.corpus", 4)
    try:
        stored = spark.table("bucketed.corpus")
        there = document_frequency(stored, ["band"], colocated=True)
        assert len(exchanges(there)) == 1
        assert len(exchanges(document_frequency(corpus, ["band"]))) == 2
        assert sorted(there.collect()) == sorted(document_frequency(corpus, ["band"]).collect())
    finally:
        spark.sql("DROP DATABASE bucketed CASCADE")
