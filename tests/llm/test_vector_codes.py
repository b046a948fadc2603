import hashlib

import numpy as np
import pytest

from bandlex.llm import vector_codes as vc
from bandlex.llm.queries import op11_vector_codes


def brute_codes(rows, parts=8, entries=16, rounds=6):
    """Codes, errors and codebooks by comparing every part with every entry."""
    points = np.floor(np.array([v for _, v in rows], float) * 4096).astype(np.int64)
    first = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1]))[:entries]
    codes, errors, books = [], 0, []
    for p in np.split(points, parts, axis=1):
        book = p[first]
        for _ in range(rounds):
            label = ((p[:, None] - book) ** 2).sum(2).argmin(1)
            book = np.array([p[label == e].sum(0) // (label == e).sum() if (label == e).any() else book[e] for e in range(len(book))])
        label = ((p[:, None] - book) ** 2).sum(2).argmin(1)
        codes.append(label)
        books.append(book)
        errors = errors + ((p - book[label]) ** 2).sum(1)
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return ["".join(f"{x:02x}" for x in row) for row in zip(*codes)], errors.tolist(), digest


def clustered(seed, n, width, centres=12):
    rng = np.random.default_rng(seed)
    return np.round(rng.standard_normal((centres, width))[rng.integers(0, centres, n)] * 900 + rng.standard_normal((n, width)) * 60).astype(np.int64)


@pytest.mark.parametrize("points", [clustered(1, 700, 8), clustered(2, 300, 2), np.zeros((50, 3), np.int64),
                                    np.repeat(clustered(3, 5, 4), 60, axis=0), clustered(4, 1, 8),
                                    np.round(1.01 ** np.arange(1500))[:, None].astype(np.int64)])
def test_trees_own_what_comparing_everything_gives(points):
    tree = vc.Tree(points)
    assert sorted(tree.order) == list(range(len(points)))
    for i, (a, b) in enumerate(zip(tree.lo, tree.hi)):
        held = points[tree.order[a:b]]
        assert tree.counts[i] == b - a and (tree.sums[i] == held.sum(0)).all()
        assert (np.sqrt(((held - tree.pivots[i]) ** 2).sum(1)) <= tree.radii[i]).all()
    book = np.concatenate((points[:5], points[:1], points[-3:] + 7))
    want = ((points[:, None] - book) ** 2).sum(2).argmin(1)
    assert (tree.labels(book) == want).all()
    counts, sums = tree.totals(book)
    assert (counts == np.bincount(want, minlength=len(book))).all()
    assert all((sums[e] == points[want == e].sum(0)).all() for e in range(len(book)))


def test_whole_balls_are_owned():
    points = clustered(5, 4000, 8)
    balls, _, singles, _ = vc.Tree(points).owners(points[:12])
    assert len(balls) and len(singles) < len(points) / 2


def test_anchors_against_all_distances():
    points = clustered(6, 500, 4).astype(float)
    pivots, owner, distance = vc._anchors(points, 20)
    every = np.sqrt(((points[:, None] - points[pivots]) ** 2).sum(2))
    assert len(pivots) == 20 and np.allclose(distance, every.min(1)) and np.allclose(every[np.arange(500), owner], distance)


def test_query_against_sql(spark, sf, sql):
    from bandlex.llm.oracle import oracle_sql

    found = op11_vector_codes(spark, sf)
    expected = sql.execute(oracle_sql()["op11_vector_codes"])
    columns = [d[0] for d in expected.description]
    assert sorted(map(repr, (tuple(r) for r in found.select(columns).collect()))) == sorted(map(repr, expected.fetchall()))


def test_chunks_do_not_matter(spark):
    rng = np.random.default_rng(7)
    rows = [(i, (rng.standard_normal(16) * (1 + i % 3)).tolist(), i % 4) for i in range(400)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    found = {r.vec_id: r for r in vc.vector_codes(table).collect()}
    codes, errors, digest = brute_codes([r[:2] for r in rows])
    assert [(found[i].code, found[i].error) for i in range(400)] == list(zip(codes, errors))
    assert {r.codebooks_sha256 for r in found.values()} == {digest}
    kept = table.select("vec_id", "label", table.embedding.alias("vector"))
    small = vc.tree_chunks(kept, chunk=37)
    assert small.agg({"size": "sum", "*": "count"}).first()[0] == 400 and small.count() > 9
    books = vc.fit_codebooks(small, vc._first_entries(kept, 16, 8))
    assert vc.codebooks_digest(books) == digest


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    v = [0.1, -0.1, 2.0, 3.5, 0.0, -0.0001, 1.0, 9.0]
    w = [-x for x in v]
    rows = [(1, v, 5), (1, v, 5), (2, w, None), (None, w, None), (3, None, 5), (4, [nan] * 8, 5), (5, [inf] * 8, 5),
            (6, [None] * 8, 5), (7, [], 5), (2, v, 6)]
    schema = "vec_id long, embedding array<float>, label int"
    clash = ", code int, error string, trees int, of int, vector int, rows int, size string, label_error int"
    table = spark.createDataFrame([r + (1, "x", 1, 1, 1, 1, "y", 1) for r in rows], schema + clash)
    found = vc.vector_codes(table)
    assert found.columns == ["vec_id", "label", "code", "error", "label_error", "codebooks_sha256"]
    kept = [(i, np.float32(x).astype(float).tolist()) for i, x, _ in rows if x and None not in x and np.isfinite(x).all()]
    codes, errors, digest = brute_codes(kept)
    got = found.collect()
    assert sorted((r.vec_id or 0, r.code, r.error) for r in got) == sorted((i or 0, c, e) for (i, _), c, e in zip(kept, codes, errors))
    assert {r.codebooks_sha256 for r in got} == {digest} and all(r.label_error == 0 for r in got)
    assert vc.vector_codes(table.limit(0)).collect() == []
    for bad in ([[1.0] * 8, [1.0] * 16], [[1.0] * 9], [[1e30] * 8]):
        with pytest.raises(Exception, match="vectors must have one length|components must be below"):
            vc.vector_codes(spark.createDataFrame([(i, x, 1) for i, x in enumerate(bad)], schema).coalesce(1)).collect()


def test_labels_are_summed_with_nulls_together(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.standard_normal(8).tolist(), [None, 1, 2][i % 3]) for i in range(90)]
    found = vc.vector_codes(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    for label in (None, 1, 2):
        mine = [r for r in found if r.label == label]
        assert len(mine) == 30 and {r.label_error for r in mine} == {sum(r.error for r in mine)}
