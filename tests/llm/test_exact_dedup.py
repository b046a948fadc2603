"""Exact deduplication against SQL and on odd rows."""

import re
from collections import Counter

import pytest

from bandlex.llm import exact_dedup
from bandlex.llm.oracle import oracle_sql
from bandlex.llm.queries import op6_exact_dedup


def test_query_against_sql(spark, sf, sql):
    found = op6_exact_dedup(spark, sf)
    expected = sql.execute(oracle_sql()["op6_exact_dedup"]).fetchall()
    columns = [d[0] for d in sql.description]
    assert sorted(found.columns) == sorted(columns)
    assert sorted(map(tuple, found.select(columns).collect())) == sorted(expected)


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


@pytest.mark.parametrize("counters", [1, 2, 50])
def test_odd_rows(spark, odd_docs, counters):
    rows = exact_dedup.exact_duplicates(odd_docs, counters).collect()
    docs = odd_docs.collect()
    sizes = Counter(normal(d.text) for d in docs)
    assert len(rows) == len(docs)
    assert sum(r.kept for r in rows) == len(sizes)
    assert Counter(r.group_size for r in rows) == Counter(sizes[normal(d.text)] for d in docs)
    assert [r.kept for r in rows if r.doc_id == 2] == [False, False]
    assert {r.keep_id for r in rows if r.doc_id == 7} == {7}
    # a null id stays where it is alone, and yields to any other
    assert sorted((r.keep_id, r.kept) for r in rows if r.doc_id is None and r.keep_id) == [(3, False)]
    assert exact_dedup.exact_duplicates(odd_docs.limit(0)).collect() == []


def test_rows_that_stay(spark, odd_docs):
    docs = odd_docs.unionByName(odd_docs.where("doc_id = 1"))
    rows = exact_dedup.drop_exact_duplicates(docs)
    assert rows.columns == docs.columns
    found = Counter((r.doc_id, r.text) for r in rows.collect())
    assert set(found.values()) == {1}
    assert Counter(normal(t) for _, t in found) == Counter({normal(d.text): 1 for d in docs.collect()})
    assert exact_dedup.drop_exact_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("counters", [1, 3, 10])
def test_misra_gries_keeps_every_frequent_item(counters):
    items = [i % 7 for i in range(700)] + ["a"] * 400 + list(range(100, 400)) + ["b"] * 300
    kept, n = exact_dedup.misra_gries(iter(items), counters), len(items)
    for item, count in Counter(items).items():
        assert count - n / (counters + 1) <= kept.get(item, 0) <= count


def test_heavy_digests_are_verified(spark):
    rows = [(b"hot", i, i) for i in range(500)] + [(b"%d" % i, i, 1000 + i) for i in range(400)] + [(b"warm", i, i) for i in range(90)]
    frame = spark.createDataFrame(rows, "digest binary, id long, row long").repartition(7)
    heavy = {bytes(r.digest): (r.n, r.least.id) for r in exact_dedup.heavy_digests(frame, 9).collect()}
    assert heavy == {b"hot": (500, 0)}
