import math
from collections import Counter

import pytest

from bandlex.functions.analysis import LETTERS
from bandlex.operators import phrases, row_members
from porter import stem
from pyspark.sql import functions as F

STOP = ["the", "and"]


def sequence(text):
    """Words of a text by place, None where there is none."""
    found = []
    for piece in text.lower().replace("\t", " ").replace("\n", " ").replace("-", " ").split(" "):
        word = "".join(c for c in piece if "a" <= c <= "z")
        found.append(word if len(word) > 2 and word not in STOP else None)
    return found


def brute(texts, min_count=5, min_score=10.828):
    pairs = [[(stem(a), stem(b)) if a and b else None for a, b in zip(s, s[1:])] for s in map(sequence, texts)]
    n = Counter(p for row in pairs for p in row if p)
    total, first, second = sum(n.values()), Counter(), Counter()
    for (a, b), k in n.items():
        first[a] += k
        second[b] += k
    found = {}
    for (a, b), k in n.items():
        table = ((k, first[a], second[b]), (first[a] - k, first[a], total - second[b]),
                 (second[b] - k, total - first[a], second[b]), (total - first[a] - second[b] + k, total - first[a], total - second[b]))
        score = 2 * sum(x * math.log(x * total / r / c) for x, r, c in table if x)
        if k >= min_count and k * total > first[a] * second[b] and score >= min_score:
            found[a, b] = [k, score, 0]
    places = []
    for d, row in enumerate(pairs):
        last = -2
        for i, p in enumerate(row):
            if p in found and i > last + 1:
                found[p][2] += 1
                places.append((d, i, *p))
                last = i
    return found, places


@pytest.fixture(scope="module")
def texts():
    fill = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima".split()
    made = []
    for i in range(60):
        made.append(f"{fill[i % 12]} North Koreas {fill[i * 5 % 12]} the north-korea {fill[i * 7 % 12]} {fill[i * i % 12]} pyongyang")
    return [*made, "", "one", "north korea north korea north", "north the korea", "very very very very very very very"]


@pytest.fixture
def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)


def test_against_brute_force(docs, texts):
    expected, _ = brute(texts)
    rows = phrases.phrases_in(docs, stopwords=STOP).collect()
    assert {(r.first, r.second): (r.n, r.taken) for r in rows} == {k: (n, t) for k, (n, _, t) in expected.items()}
    assert all(math.isclose(r.score, expected[r.first, r.second][1], rel_tol=1e-9) for r in rows)
    assert ("north", "korea") in expected and ("veri", "veri") in expected


@pytest.mark.parametrize("max_bytes", [64 << 20, 0])
def test_places_in_the_row_and_by_a_join(docs, texts, max_bytes):
    """Where the words of phrases do not fit a lookup table, the same places come from a join."""
    found = phrases.find_phrases(docs, stopwords=STOP)
    rows = phrases.phrase_places(docs, found, stopwords=STOP, max_bytes=max_bytes).collect()
    assert sorted((r.doc_id, r.pos, r["first"], r["second"]) for r in rows) == sorted(brute(texts)[1])


def test_stop_words_as_a_table(spark, docs):
    table = spark.createDataFrame([(w,) for w in STOP], "token string")
    rows = [sorted(map(tuple, phrases.phrases_in(docs, stopwords=stop).collect())) for stop in (STOP, table)]
    assert rows[0] == rows[1]


def test_counting_moves_no_positions(docs):
    plan = phrases._counted(docs, "text", STOP, False, LETTERS)._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange" in line and "RoundRobin" not in line and "REPARTITION" not in line]
    assert "Python" not in plan and len(moved) == 1 and "hashpartitioning(pair" in moved[0]


def test_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert phrases.phrases_in(empty).collect() == []
    nulls = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert phrases.phrases_in(nulls).collect() == []
    many = nulls.withColumn("text", F.lit("north korea"))
    assert phrases.phrases_in(many).collect() == []


def test_pairs_are_made_in_generated_code(docs):
    """The same pairs as those inside the rows, without lambdas, which are interpreted."""
    inside = phrases._neighbours(docs, "text", STOP, False, LETTERS)
    inside = inside.select("doc_id", F.posexplode("pairs").alias("pos", "pair")).where("pair is not null")
    rows = phrases._following(docs, "text", STOP, False, LETTERS).select("doc_id", "pos", phrases._pair().alias("pair"))
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, inside.collect())) != []
    assert "lambda" not in phrases._counted(docs, "text", STOP, False, LETTERS)._jdf.queryExecution().executedPlan().toString()


def test_places_are_not_sorted_by_their_pairs(docs):
    found = phrases.find_phrases(docs, stopwords=STOP)
    plan = phrases.phrase_places(docs, found, stopwords=STOP, max_bytes=0)._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin [key" in plan and "Sort [key" not in plan


def test_no_place_is_shuffled_where_only_fingerprints_fit(docs, texts):
    """Words of phrases beyond the bound: places stay in their rows while 16 bits a phrase are within it."""
    bound = 2000
    found = phrases.find_phrases(docs, stopwords=STOP)
    keys = found.select(F.explode("words").alias("key"))
    assert keys.agg(F.sum(F.octet_length("key") + 64)).first()[0] > bound
    rows = phrases.phrases_in(docs, max_bytes=bound, stopwords=STOP)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "hashpartitioning" in line]
    assert "Window" not in plan and moved and not any("pos" in line or "key" in line or "row" in line for line in moved)
    expected, _ = brute(texts)
    assert {(r.first, r.second): (r.n, r.taken) for r in rows.collect()} == {k: (n, t) for k, (n, _, t) in expected.items()}


@pytest.mark.parametrize("bits", [0, 64])
def test_pairs_that_look_like_phrases_are_no_phrases(docs, texts, monkeypatch, bits):
    """Without fingerprints every pair looks like those of its bucket; with none of the hash left, all pairs share one."""
    if bits == 0:
        monkeypatch.setattr(row_members, "_fingerprint", lambda h: F.shiftright(h, 63).cast("smallint"))
    else:
        monkeypatch.setattr(phrases, "_hash_of_key", lambda key: F.lit(1).cast("long"))
    expected, _ = brute(texts)
    rows = phrases.phrases_in(docs, stopwords=STOP).collect()
    assert {(r.first, r.second): (r.n, r.taken) for r in rows} == {k: (n, t) for k, (n, _, t) in expected.items()}


def test_members_of_a_set(spark):
    """All hashes inside, few outside, and by their whole hash none outside."""
    hashes = spark.range(60000).select(F.xxhash64("id").alias("h"), (F.col("id") % 6 == 0).alias("inside"))
    inside = hashes.where("inside").select("h")
    for kind, least, most in ((row_members.alike, 1, 500), (row_members.among, 0, 0)):
        table = kind(inside, 10000)
        rows = hashes.select("inside", table.has(table.whole, F.col("h")).alias("has")).groupBy("inside", "has").count().collect()
        n = {(r.inside, r.has): r["count"] for r in rows}
        assert n[True, True] == 10000 and (True, False) not in n and least <= n.get((False, True), 0) <= most


def test_terms_that_are_words_are_counted_in_one_exchange(docs):
    """The counts of pairs are neither stored with their terms nor dealt again by these."""
    counted = phrases._settled_counts(docs, "text", STOP, False, LETTERS)
    found = phrases._scored(counted, LETTERS)
    assert "Window" not in found._jdf.queryExecution().executedPlan().toString()
    whole = phrases._counted(docs, "text", STOP, False, LETTERS)
    assert sorted(map(tuple, counted.collect())) == sorted(map(tuple, whole.collect()))
