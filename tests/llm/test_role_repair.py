"""Role repair against trying every way, and over many partitions."""

import functools
import itertools
import random
from collections import defaultdict

import duckdb
import pyarrow as pa
import pytest

from bandlex.llm import role_repair as rr
from bandlex.llm.oracle import oracle_sql
from bandlex.llm.queries import op4_role_repair

NAMES = ("system", "user", "assistant")


def brute_cost(roles, costs):
    """The least cost over all ways, by the definition: any turn may be kept, merged or
    relabelled, and any number of empty turns may stand before it and at the end."""
    follows = {None: {"system", "user"}, "system": {"user"}, "user": {"assistant"}, "assistant": {"user"}}

    @functools.cache
    def rest(i, last, inserted):
        if i == len(roles) and last == "assistant":
            return 0
        best = 10**9
        if i < len(roles):
            for role in NAMES:
                price = 0 if role == roles[i] else costs.relabel
                if role in follows[last]:
                    best = min(best, price + rest(i + 1, role, 0))
                if role == last and not inserted:
                    best = min(best, price + costs.merge + rest(i + 1, role, 0))
        if inserted < 3:
            best = min([best, *(costs.insert + rest(i, role, inserted + 1) for role in follows[last])])
        return best

    return rest(0, None, 0)


def check(rows, conversations, costs=rr.Costs()):
    given, found = defaultdict(list), defaultdict(list)
    for c in conversations:
        given[c.conv_id].append(c)
    for r in rows:
        found[r.conv_id].append(r)
    assert set(found) == set(given)
    for conv, out in found.items():
        out.sort(key=lambda r: r.seq)
        assert len({r.seq for r in out}) == len(out)
        turns = [r for r in out if r.action != "insert"]
        assert sorted(map(repr, ((r.turn, r.role) for r in turns))) == sorted(map(repr, ((c.turn, c.role) for c in given[conv])))
        assert [r.turn for r in turns] == sorted((r.turn for r in turns), key=lambda t: (t is not None, t or 0))
        roles = [(r.role or "").strip().lower() for r in turns]
        if len(roles) < 40:
            assert sum(r.cost for r in out) == brute_cost(tuple(roles), costs)
        # the rendering is a legal conversation with all the texts
        text = "".join(r.rendered for r in out)
        parts = text.split("<|end|>\n")
        assert parts.pop() == ""
        heads = [p.split("|>\n", 1)[0].removeprefix("<|") for p in parts]
        body = heads[1:] if heads[0] == "system" else heads
        assert body == ["user", "assistant"] * (len(body) // 2) and body
        texts = sorted((c.text or "").replace("<|", "< |") for c in given[conv])
        assert sum(len(p.split("|>\n", 1)[1]) for p in parts) == sum(map(len, texts)) + 2 * sum(r.action == "merge" for r in out)
        for r in out:
            assert r.rendered.count(r.new_role) or r.action == "merge"


def test_query(spark, sf):
    rows = op4_role_repair(spark, sf).collect()
    check(rows, spark.read.parquet(f"{sf}/conversations.parquet").collect())
    assert any(r.action == "insert" for r in rows)


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


def test_query_against_sql(spark, sf, sql):
    expected = sql.execute(oracle_sql()["op4_role_repair"]).fetchall()
    columns = [d[0] for d in sql.description]
    assert order(map(tuple, op4_role_repair(spark, sf).select(columns).collect())) == order(expected)


def test_sql_on_any_roles(spark):
    """Sequences that the given table lacks, and a conversation without an id."""
    rng = random.Random(8)
    kinds = ["system", "user", "assistant", " User\n", "tool", "", None]
    rows = [(conv or None, turn, rng.choice(kinds), rng.choice(["a <|x|>", "", None])) for conv in range(200) for turn in range(rng.randint(1, 8))]
    table = frame(spark, rows)
    connection = duckdb.connect()
    connection.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    connection.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    expected = connection.execute(oracle_sql()["op4_role_repair"]).fetchall()
    columns = [d[0] for d in connection.description]
    assert order(map(tuple, rr.repair_roles(table).select(columns).collect())) == order(expected)


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


@pytest.mark.parametrize("costs", [rr.Costs(), rr.Costs(5, 2, 1), rr.Costs(1, 1, 1), rr.Costs(0, 3, 2)])
def test_every_short_sequence(spark, costs):
    rng = random.Random(sum(costs))
    rows = []
    for conv in range(300):
        for turn in range(rng.randint(1, 7)):
            rows.append((conv, turn, rng.choice(["system", "user", "assistant", "User ", "tool", None]), f"t{turn} <|x|>"))
    rr_rows = rr.repair_roles(frame(spark, rows), costs).collect()
    check(rr_rows, frame(spark, rows).collect(), costs)


def test_conversations_over_many_partitions(spark):
    rng = random.Random(4)
    rows = [(5, turn, rng.choice(["user", "user", "assistant", "assistant", "system", "tool"]), f"t{turn}") for turn in range(3000)]
    rows += [(conv, turn, rng.choice(["user", "assistant"]), "x") for conv in (1, 2, 9) for turn in range(30)]
    rows += [(7, 0, "user", "same")] * 500
    rng.shuffle(rows)
    table = frame(spark, rows)
    results = []
    settings = {"spark.sql.shuffle.partitions": "23", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for given in ({}, settings):
        before = {k: spark.conf.get(k) for k in given}
        for k, v in given.items():
            spark.conf.set(k, v)
        found = rr.repair_roles(table)
        results.append(sorted(map(repr, map(tuple, found.collect()))))
        if given:
            assert found.rdd.getNumPartitions() > 15
            check(found.collect(), rows := table.collect())
        for k, v in before.items():
            spark.conf.set(k, v)
    assert results[0] == results[1]
    automaton = rr.Automaton(rr.Costs())
    numbers = [rr.ROLES.index(r.role) if r.role in rr.ROLES else 0 for r in sorted((r for r in rows if r.conv_id == 5), key=lambda r: r.turn)]
    _, at = automaton.path(numbers, rr.begin(), None)
    total = sum(r.cost for r in found.collect() if r.conv_id == 5)
    assert total == min(a + e for a, e in zip(at, automaton.ends))


def test_stretches_are_slices_of_batches():
    """Conversations cut by batches, a null id among them, come back whole, without a copy."""
    rng = random.Random(6)
    ids = [conv for conv in [None, 1, 2, None, 3, 4, 5] for _ in range(rng.randint(1, 9))]
    rows = [(conv, 2, turn, "user", f"t{turn}") for turn, conv in enumerate(ids)]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.string()]
    names = ["conv_id", "number", "turn", "role", "text"]
    whole = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
    for width in (1, 2, 3, 7, 100):
        batches = [whole.slice(at, width) for at in range(0, len(rows), width)] + [whole.slice(0, 0)]
        found = [list(rr._rows(stretch)) for stretch in rr._stretches(iter(batches))]
        assert found == [list(g) for _, g in itertools.groupby(rows, key=lambda r: r[0])]
        for stretch in rr._stretches(iter(batches)):
            assert all(piece.column(4).buffers()[2].address == whole.column(4).buffers()[2].address for piece in stretch)
    assert list(rr._stretches(iter([]))) == []


def test_odd_rows(spark):
    rows = [(None, None, None, None), (None, 1, "user", "a"), (1, None, "assistant", None), (1, None, "assistant", None), (1, 0, "", "")]
    rows += [(2, 0, " USER\t", "x" * 200_000), (2, 0, "user", "y"), (3, 0, "assistant", "only")]
    table = frame(spark, rows).selectExpr("*", "1 AS number", "2 AS seq", "'z' AS cost")
    check(rr.repair_roles(table).collect(), table.collect())
    assert rr.repair_roles(table.limit(0)).collect() == []
