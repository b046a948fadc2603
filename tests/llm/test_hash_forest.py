import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from bandlex.llm import hash_forest as hf
from bandlex.llm.queries import op12_hash_forest


def brute_nearest(rows, k=5, every=50):
    """``(query, rank) -> (id, score)`` over rows ``(id, vector)`` of distinct ids."""
    found = {}
    for i, v in rows:
        if i % every == 0:
            scores = sorted((-hf.exact_cosine(np.array(v, float), np.array(w, float)), j) for j, w in rows if j != i)
            found |= {(i, n + 1): (j, -s) for n, (s, j) in enumerate(scores[:k])}
    return found


def recall(found, want):
    of = lambda table: {(q, i) for (q, _), (i, _) in table.items()}
    return len(of(found) & of(want)) / len(want)


def as_dict(table):
    return {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in table.collect()}


def test_query_against_brute_force(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    found, want = as_dict(op12_hash_forest(spark, sf)), brute_nearest(rows)
    assert set(found) == set(want) and recall(found, want) >= 0.9
    vectors = dict(rows)
    for (q, _), (i, score) in found.items():
        a, b = np.array(vectors[q], float), np.array(vectors[i], float)
        assert math.isclose(score, a @ b / (np.linalg.norm(a) * np.linalg.norm(b)), abs_tol=1e-12)
    for q in {q for q, _ in found}:
        listed = [(-found[q, n][1], found[q, n][0]) for n in range(1, 6)]
        assert listed == sorted(listed)


@pytest.mark.parametrize("noise", [0.05, 0.5])
def test_recall_in_clusters_and_shards(spark, noise):
    """Vectors around 40 centres, dealt to several shards; ids of one query in ten."""
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((40, 32))
    vectors = centres[rng.integers(0, 40, 2000)] + noise * rng.standard_normal((2000, 32))
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    found = as_dict(hf.nearest_vectors(table, every=100, shard=500))
    assert recall(found, brute_nearest(rows, every=100)) >= 0.9


def test_slices_hold_exactly_the_common_prefixes():
    rng = np.random.default_rng(4)
    shard = hf.Shard([[i] for i in range(300)], rng.standard_normal((300, 8)))
    strings = hf.hash_strings(hf.units(rng.standard_normal((6, 8))))
    plain = hf.hash_strings(shard.units)
    for length in (0, 1, 5, 63, 64):
        begin, end = shard.slices(strings, np.full(6, length))
        for q in range(6):
            for t in range(hf.TREES):
                common = (plain[:, t] ^ strings[q, t]) >> np.uint64(64 - length) == 0 if length else np.ones(300, bool)
                assert set(shard.order[begin[q, t] : end[q, t], t]) == set(np.flatnonzero(common))


def test_near_neighbours_need_long_prefixes(spark):
    cosines = [None, -1.0, 0.0, 0.45, 0.9, 0.999, 1.0]
    table = spark.createDataFrame([(i, c) for i, c in enumerate(cosines)], "i int, c double")
    found = [r.n for r in table.select("i", hf.prefix_length(F.col("c")).alias("n")).orderBy("i").collect()]
    assert found[0] == 0 and found == sorted(found) and found[-1] == hf.BITS
    for cosine, length in zip(cosines[2:-1], found[2:-1]):
        agree = 1 - math.acos(cosine) / math.pi
        assert 1 - (1 - agree**length) ** hf.TREES >= hf.SURE
        assert length == hf.BITS or 1 - (1 - agree ** (length + 1)) ** hf.TREES < hf.SURE


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (7, [2.0, 0.0]), (3, [2.0, 0.0]), (5, [0.0, 1.0]), (9, [-1.0, -0.0]), (9, [-1.0, 0.0]),
            (50, [1e300, 1e300]), (51, [1e-300, 0.0]), (1, None), (100, None), (2, [0.0, 0.0]), (4, [nan, 1.0]), (6, [inf, 1.0]),
            (8, [None, 1.0]), (10, []), (None, [1.0, 0.0])]
    schema = "vec_id long, embedding array<double>, query int, score string, rank int, vector string, ids int, shard int"
    table = spark.createDataFrame([r + (1, "x", 1, "v", 1, 1) for r in rows], schema)
    found = as_dict(hf.nearest_vectors(table))
    half = math.sqrt(0.5)
    assert {k: v[0] for k, v in found.items()} == {
        (0, 1): 3, (0, 2): 7, (0, 3): 51, (0, 4): 50, (0, 5): 5, (50, 1): 0, (50, 2): 3, (50, 3): 5, (50, 4): 7, (50, 5): 51,
    }
    assert [found[0, n][1] for n in (1, 3, 5)] == [1.0, 1.0, 0.0] and math.isclose(found[0, 4][1], half)
    assert hf.nearest_vectors(table.limit(0)).collect() == []
    one = spark.createDataFrame([(0, [1.0, 2.0])], "vec_id long, embedding array<double>")
    assert hf.nearest_vectors(one).collect() == []
    with pytest.raises(Exception, match="vectors must have one length"):
        hf.nearest_vectors(spark.createDataFrame([(0, [1.0]), (1, [1.0, 2.0])], "vec_id long, embedding array<double>")).collect()


def test_a_vector_of_very_many_rows(spark):
    rows = [(i, [1.0, 1.0, 0.0]) for i in range(3000)] + [(i, [float(i % 7), 1.0, float(i % 11)]) for i in range(3000, 3300)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(6)
    found = as_dict(hf.nearest_vectors(table, every=1000))
    assert [found[1000, n][0] for n in range(1, 6)] == [0, 1, 2, 3, 4]
    assert [found[0, n][0] for n in range(1, 6)] == [1, 2, 3, 4, 5]
