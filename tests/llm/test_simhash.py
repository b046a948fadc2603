"""SimHash links and components against brute force."""

import random

import numpy as np
import pytest
import xxhash

from bandlex.llm import simhash
from bandlex.llm.components import connected_components
from bandlex.llm.queries import op5_simhash


def brute_print(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in words).split(" ") if w]
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, prints, radius=4):
    parent = {f: f for f in prints}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    distinct = np.array(sorted(set(prints)), dtype=np.uint64)
    for i, f in enumerate(distinct):
        for g in distinct[i + 1 :][np.bitwise_count(distinct[i + 1 :] ^ f) <= radius]:
            a, b = root(int(f)), root(int(g))
            parent[max(a, b)] = min(a, b)
    least = {}
    for i, f in zip(ids, prints):
        if i is not None:
            least[root(f)] = min(i, least.get(root(f), i))
    return [least.get(root(f)) for f in prints]


def test_query_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    found = {r.doc_id: r for r in op5_simhash(spark, sf).collect()}
    prints = [brute_print(d.text) for d in docs]
    expected = brute_components([d.doc_id for d in docs], prints)
    assert len(found) == len(docs)
    for d, f, c in zip(docs, prints, expected):
        assert (found[d.doc_id].fingerprint, found[d.doc_id].component_id) == (f"{f:016x}", c)
    assert len(set(expected)) < len({d.text for d in docs})


def test_odd_rows(spark, odd_docs):
    rows = simhash.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    empty = {r.component_id for r in rows if r.fingerprint == "0" * 16}
    assert empty == {3}
    assert {r.component_id for r in rows if r.doc_id in (1, 2)} == {1}
    texts = odd_docs.collect()
    expected = brute_components([d.doc_id for d in texts], [brute_print(d.text) for d in texts])
    assert sorted(map(str, expected)) == sorted(str(r.component_id) for r in rows)
    assert simhash.near_duplicates(odd_docs.limit(0)).collect() == []


@pytest.mark.parametrize("width", [8, 4, 1])
@pytest.mark.parametrize("cell_rows", [37, 1 << 15])
def test_links_at_any_depth_and_cell_size(spark, monkeypatch, width, cell_rows):
    monkeypatch.setattr(simhash, "SEGMENTS", (width,))
    rng = random.Random(width)
    prints = [rng.getrandbits(64) for _ in range(150)]
    for f in prints[:60]:  # neighbours at 1 to 6 bits
        for bits in (1, 3, 4, 5, 6):
            prints.append(f ^ sum(1 << b for b in rng.sample(range(64), bits)))
    dense = rng.getrandbits(64)  # a family in one shard
    prints += [dense ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5))) for _ in range(300)]
    prints = sorted(set(prints))
    signed = np.array(prints, dtype=np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(f,) for f in signed], "fingerprint long")
    links = simhash.fingerprint_links(frame, cell_rows=cell_rows)
    found = {r.node: r.component for r in connected_components(links).collect()}
    roots = [found.get(f, f) for f in signed]
    expected = brute_components(range(len(prints)), prints)
    # the same partition of the fingerprints
    assert len(set(zip(roots, expected))) == len(set(roots)) == len(set(expected))
    if cell_rows > len(prints):  # forests, one for each shard
        assert links.count() < 8 * len(prints)


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(100, 400)]
    star = [(7, 1000 + i) for i in range(300)]
    edges = spark.createDataFrame([*path, *star, (5, 5), (None, 3)], "x long, y long")
    found = {r.node: r.component for r in connected_components(edges).collect()}
    assert all(found[i] == 100 for i in range(100, 401))
    assert all(found[1000 + i] == 7 for i in range(300)) and found[7] == 7
    assert len(found) == 301 + 301
    assert connected_components(edges.limit(0)).collect() == []
