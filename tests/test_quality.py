import hashlib
import math

import pytest

from bandlex.operators import incremental, samples, stability
from bandlex.operators.density import density_thirds
from bandlex.operators.index import idf_by_band
from bandlex.sources import readers, versions, writers
from fixed_words import STOP
from pyspark.sql import functions as F


def test_samples_do_not_depend_on_partitions_and_merge(spark):
    rows = spark.range(5000).select(F.col("id").alias("key"), F.lit("d").alias("detail"))
    first = samples.sample_rows(rows, "c", 7).collect()
    want = sorted((hashlib.md5(f"42\x1fc\x1f{i}".encode()).hexdigest(), str(i)) for i in range(5000))[:7]
    assert sorted((r.priority, r.key) for r in first) == want
    parts = [samples.sample_rows(rows.where(F.col("key") % 3 == k).repartition(5), "c", 7) for k in range(3)]
    assert sorted(samples.merge_samples(*parts, k=7).collect()) == sorted(first)
    assert samples.sample_rows(rows, "c", 7, seed=1).collect() != first
    repeated = rows.unionByName(rows.where("key = 3").select("key", "detail").crossJoin(spark.range(3000).select()))
    assert sorted(samples.sample_rows(repeated, "c", 7).collect()) == sorted(first)


def test_causes(spark):
    docs = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, None, "z")], "doc_id long, author string, text string")
    scores = spark.createDataFrame([("a", 1.0)], "author string, score double")
    lines = spark.createDataFrame([("1\tok",), ("bad",), ("x\tbad",)], "value string")
    table = spark.createDataFrame([("L", "t", 9, math.nan), ("L", "u", 1, -0.1)], "band string, term string, df long, idf double")
    found = samples.suspect_sample(
        {"unscored": samples.unscored(docs, scores), "bad line": samples.bad_lines(lines), "undefined idf": samples.undefined_idf(table)}, k=2
    )
    assert sorted((r.cause, r.detail) for r in found.collect() if r.detail) == [
        ("bad line", "bad"), ("bad line", "x\tbad"), ("undefined idf", "df 9"), ("unscored", "b")]
    plan = samples.sample_rows(spark.range(5000).select(F.col("id").alias("key"), F.lit("d").alias("detail")), "c")
    plan = plan._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" in plan and "Sort [" not in plan


def test_poisson_numbers(spark):
    """Mean and variance on both sides of the bound between the two ways."""
    rows = spark.range(20000).crossJoin(spark.createDataFrame([(1,), (7,), (64,), (65,), (5000,)], "n long"))
    u = [stability.uniform(3, name, F.col("id"), F.col("n")) for name in "ab"]
    rows = rows.select("n", F.explode(F.array(F.struct(u[0].alias("a"), u[1].alias("b")))).alias("u"))
    rows = rows.select("n", stability.poisson(F.col("n"), F.col("u.a"), F.col("u.b")).alias("x"))
    for r in rows.groupBy("n").agg(F.avg("x").alias("mean"), F.variance("x").alias("variance"), F.min("x").alias("least")).collect():
        assert abs(r["mean"] - r.n) < 5 * math.sqrt(r.n / 20000) and abs(r.variance / r.n - 1) < 0.06 and r.least >= 0


def test_cuts_of_replicates(spark):
    rows = spark.range(400).select((F.pow(F.col("id") / 40, 2) + F.sin(F.col("id") * 1.0)).alias("score"))
    cuts = {r.replicate: (r.lower, r.upper) for r in stability.replicate_cuts(rows, replicates=30).collect()}
    plain = density_thirds(rows).first()
    assert len(cuts) == 31 and cuts[0] == pytest.approx(tuple(plain), abs=1e-9)
    found = {r.cut: r for r in stability.cut_stability(rows, replicates=30).collect()}
    for i, cut in enumerate(("lower", "upper")):
        drawn = [cuts[b][i] for b in range(1, 31)]
        r = found[cut]
        assert min(drawn) <= r.low <= r.high <= max(drawn) and r.low <= r.value <= r.high and r.undefined == 0
        assert math.isclose(r["mean"], sum(drawn) / 30) and len(set(drawn)) > 3
    for r in stability.cut_stability(rows.repartition(4), replicates=30).collect():
        assert r.low == pytest.approx(found[r.cut].low) and r.sd == pytest.approx(found[r.cut].sd)
    assert stability.cut_stability(rows.where("score is null")).collect() == []


def test_more_scores_give_narrower_cuts(spark):
    def width(n):
        rows = spark.range(n).select((F.sin(F.col("id") * 12.9898) * 3 + F.cos(F.col("id") * 78.233)).alias("score"))
        found = stability.cut_stability(rows, replicates=60).collect()
        return max(r.sd for r in found)

    assert width(20000) < width(200) / 3


@pytest.fixture
def corpus(spark, three_docs):
    return three_docs.withColumn("band", F.when(F.col("doc_id") == 3, "LOW").otherwise("MID"))


def as_rows(table):
    return sorted((r.band, r.term, r.df, r.idf, tuple(r.forms)) for r in table.collect())


def test_batches_add_up_and_lose_documents(spark, corpus, tmp_path):
    path = str(tmp_path / "idf")
    incremental.put_batch(corpus.where("doc_id = 2"), path, "b", stopwords=STOP)
    incremental.put_batch(corpus.where("doc_id != 2"), path, "a", stopwords=STOP)
    assert as_rows(incremental.stored_idf(spark, path)) == as_rows(idf_by_band(corpus, stopwords=STOP))
    gone = spark.createDataFrame([(1,), (99,)], "doc_id long")
    left = incremental.without_documents(corpus.where("doc_id != 2"), gone)
    incremental.put_batch(left, path, "a", stopwords=STOP)
    assert as_rows(incremental.stored_idf(spark, path)) == as_rows(idf_by_band(corpus.where("doc_id != 1"), stopwords=STOP))
    incremental.put_batch(left.limit(0), path, "a", stopwords=STOP)
    assert as_rows(incremental.stored_idf(spark, path)) == as_rows(idf_by_band(corpus.where("doc_id = 2"), stopwords=STOP))
    versions.withdraw(spark, path, "a")
    assert versions.part_names(spark, path) == ["b"]


def test_bands_are_replaced_as_a_whole(spark, corpus, tmp_path):
    path = str(tmp_path / "bands")
    writers.replace_bands(corpus, path)
    before = sorted(map(tuple, readers.read_bands(spark, path).collect()))
    assert before == sorted((r.doc_id, r.band, r.text) for r in corpus.collect())
    assert readers.read_bands(spark, path, ["HIGH"]).collect() == []  # empty, but there
    broken = corpus.withColumn("text", F.when(F.col("band") == "LOW", F.raise_error(F.lit("lost"))).otherwise("new"))
    with pytest.raises(Exception, match="lost"):
        writers.replace_bands(broken, path)
    assert sorted(map(tuple, readers.read_bands(spark, path).collect())) == before
    writers.replace_bands(broken, path, ["MID"])
    after = {(r.band, r.text) for r in readers.read_bands(spark, path).collect()}
    assert ("MID", "new") in after and {t for b, t in after if b == "LOW"} == {r[2] for r in before if r[1] == "LOW"}
    assert len(versions.old_folders(spark, path)) >= 2
    with pytest.raises(FileNotFoundError):
        readers.read_bands(spark, path, ["NONE"])
    with pytest.raises(FileNotFoundError):
        readers.read_bands(spark, str(tmp_path / "nothing"))


def test_two_writers(spark, corpus, tmp_path):
    path = str(tmp_path / "bands")
    writers.replace_bands(corpus, path)
    with pytest.raises(RuntimeError, match="another writer"):
        versions._put_manifest(spark, path, 1, {})
    assert readers.read_bands(spark, path).count() == 3
