import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from bandlex.llm import divergence as dv
from bandlex.llm.queries import op13_source_divergence

WORD = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return [w.translate(LOWER) for w in WORD.findall(text or "")]


def brute(docs, least=30, shown=50):
    """Rows from ``(lang, source, text)``."""
    counts, df, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in docs:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        counts[lang, source].update(words(text))
        df[lang].update(set(words(text)))
    rows = []
    for lang, source in groups:
        kept = [t for t, n in df[lang].items() if n >= least]
        others = [s for x, s in groups if x == lang]

        def shares(count):
            total = sum(count[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (count[t] + 5) // total for t in kept}

        p = {s: shares(counts[lang, s]) for s in others}
        q = shares(sum((counts[lang, s] for s in others), Counter()))
        mine = p[source]
        pairs = [(s, sum(abs(mine[t] - p[s][t]) for t in kept)) for s in others if s != source]
        terms = [(t, mine[t] - q[t]) for t in kept if counts[lang, source][t] and mine[t] > q[t]]
        for part, found in (("pair", pairs), ("term", terms)):
            found.sort(key=lambda x: (-x[1], x[0].encode()))
            found = found if part == "pair" else found[:shown]
            rows += [(lang, source, part, item, value, n + 1) for n, (item, value) in enumerate(found)]
    return sorted(rows)


def as_rows(table):
    return sorted((r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in table.collect())


TEXTS = ["", "One two-two Öre ÖRE one", "a" * 40 + " " + "a" * 39 + " " + "a" * 41, "abcdefgh abcdefghi abcdefg abcdefgh", "123 _ [ ` {",
         "naïve ﬁ 中文字 中文 \x7f\x00x", "end", "end", "Z", "zzzzzzzzZZZZZZZZ zzzzzzzzzzzzzzzz"]


def test_runs_against_counting():
    rng = np.random.default_rng(1)
    alphabet = ["ab", "abc", "b", "abcdefgh", "abcdefghijkl", "Abcdefghijkm", "é", "éé"]
    texts = TEXTS + [" ".join(rng.choice(alphabet, rng.integers(0, 60))) for _ in range(40)]
    array = pa.array(texts)
    offsets = np.frombuffer(array.buffers()[1], np.int32)[: len(texts) + 1].astype(np.int64)
    data = np.frombuffer(array.buffers()[2], np.uint8)[: offsets[-1]]
    group = rng.integers(0, 3, len(texts))
    counts, docs = Counter(), Counter()
    for g, text in zip(group.tolist(), texts):
        found = Counter(words(text))
        counts.update({(g, w): n for w, n in found.items()})
        docs.update((g, w) for w in found)
    got = list(zip(*dv._runs(data, offsets, group)))
    assert {(g, t.decode()): (n, d) for g, t, n, d in got} == {k: (counts[k], docs[k]) for k in counts}
    assert len(got) == len(counts)  # one run per word and group


def test_pointers_are_sorted_and_stable():
    text = "b a b abcdefghZ abcdefghy abcdefgh a c abcdefghz".lower().encode()
    data = np.concatenate((np.frombuffer(text, np.uint8), np.zeros(8, np.uint8)))
    starts, lengths, _ = dv.word_pointers(data[:-8], np.array([0, len(text)]))
    order, heads = dv.sort_pointers(data, starts, lengths, np.array([4, 0, 5]))
    found = [text[starts[i] : starts[i] + lengths[i]] for i in order]
    assert found[:4] == sorted(found[:4]) and found[4:] == sorted(found[4:])
    assert order[:4].tolist() == [1, 3, 0, 2] and heads.tolist() == [True, True, True, False] + [True] * 5


def test_every_eight_bytes_are_sorted_once(monkeypatch):
    """However many words there are, each width of them is read and sorted in one pass."""
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdefgh"), rng.integers(1, 17))) for _ in range(5000)]
    data, starts, lengths = text_of(words)
    passes = []
    wide = dv._wide
    monkeypatch.setattr(dv, "_wide", lambda *args: passes.append(len(args[1])) or wide(*args))
    order, heads = dv.sort_pointers(data, starts, lengths, np.array([2000, 0, 3000]))
    assert len(passes) <= 3 and passes[0] == 5000
    found = [words[i] for i in order]
    assert found == sorted(words[:2000]) + sorted(words[2000:])
    assert heads.sum() == len(set(words[:2000])) + len(set(words[2000:]))


def text_of(words):
    lengths = np.array([len(w) for w in words])
    data = np.frombuffer("".join(words).encode() + bytes(dv.WIDE), np.uint8)
    return data, np.cumsum(lengths) - lengths, lengths


def test_query_against_sql(spark, sf, sql):
    from bandlex.llm.oracle import oracle_sql

    expected = sql.execute(oracle_sql()["op13_source_divergence"])
    columns = [d[0] for d in expected.description]
    found = op13_source_divergence(spark, sf).select(columns).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected.fetchall()))


@pytest.mark.parametrize("size", [64, 1 << 20])
def test_against_brute_force(spark, size):
    """Slices of a few words, and all in one."""
    rng = np.random.default_rng(2)
    vocabulary = [f"w{chr(97 + i % 26)}{'x' * (i % 19)}{chr(97 + i // 26)}" for i in range(90)]
    docs = [
        (str(rng.choice(["en", "de"])), f"s{rng.integers(0, 5)}", " ".join(rng.choice(vocabulary[: rng.integers(20, 90)], rng.integers(0, 50))))
        for _ in range(300)
    ]
    table = spark.createDataFrame(docs, "lang string, source string, text string").repartition(3)
    assert as_rows(dv.source_divergence(table, size=size)) == brute(docs)


def test_blocks_of_sources(spark):
    rows, want = [], []
    rng = np.random.default_rng(3)
    bases = rng.integers(1, 50, 7)
    table = rng.integers(1, 1000, (20, 7)) * (rng.random((20, 7)) < 0.5)
    for t, p in enumerate(table):
        rows.append(("en", [(i, int(x)) for i, x in enumerate(p) if x], bases.tolist()))
    dense = np.where(table > 0, table, bases)
    for a in range(7):
        for b in range(a + 1, 7):
            want.append(("en", a, b, int(np.abs(dense[:, a] - dense[:, b]).sum()) - 20 * int(abs(bases[a] - bases[b]))))
    terms = spark.createDataFrame(rows, "lang string, held array<struct<number long, p long>>, bases array<long>")
    for block, cells in ((2, 8), (3, 1 << 20), (256, 1)):
        assert sorted(tuple(r) for r in dv._distances(terms, block, cells).collect()) == want


def test_odd_rows(spark, odd_docs):
    rows = [(r.lang, r.source, r.text) for r in odd_docs.collect()]
    for least in (1, 2, 30):
        assert as_rows(dv.source_divergence(odd_docs, least)) == brute(rows, least)
    clash = odd_docs.selectExpr("*", "1 as term", "'x' as part", "2 as n_", "3 as rank", "4 as docs", "5 as value", "6 as item", "7 as number")
    assert as_rows(dv.source_divergence(clash, 1, size=1000)) == brute(rows, 1)
    assert dv.source_divergence(odd_docs.limit(0)).collect() == []
    lone = spark.createDataFrame([("en", "a", None)], "lang string, source string, text string")
    assert dv.source_divergence(lone).collect() == []
    two = spark.createDataFrame([("en", "a", None), ("en", None, "x")], "lang string, source string, text string")
    assert as_rows(dv.source_divergence(two)) == [("en", "", "pair", "a", 0, 1), ("en", "a", "pair", "", 0, 1)]
