"""Repair of the roles of a conversation at the least cost, and its rendering.

A legal conversation is a word of an automaton: perhaps a system turn, then user and
assistant in turn, the assistant last.  Dynamic programming over its states finds, for any
sequence of roles, the cheapest way to make it legal: a turn is kept, merged into the one
before, relabelled, or preceded by an empty turn of the missing role.

A conversation may hold a large share of all turns, so none is gathered in one place.  The
table is range-partitioned by conversation and turn, and a conversation may run over many
partitions.  Steps of the dynamic program compose: a partition reports what its first
stretch does to any state it may be entered in, and then, entered at known costs, from
which state each exit comes.  The driver joins these reports, a few numbers for each
partition, and every partition repairs its own turns with the states at its two ends.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandlex.llm.shared import settle

#: States of the automaton, which are the role of the last turn; any other role has no state.
START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = ("", "system", "user", "assistant")
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
UNKNOWN = 0
FAR = 1 << 60

OPEN, CLOSE = "<|{}|>\n", "<|end|>\n"
JOINT = "\n\n"  # between merged texts
ROWS, CHARS = 1000, 4 << 20  # of a batch in Python
SCHEMA = "conv_id long, turn long, seq long, role string, new_role string, action string, cost long, rendered string"


class Costs(NamedTuple):
    merge: int = 1
    relabel: int = 2
    insert: int = 3


class Move(NamedTuple):
    """What is done with a turn on the way from one state to another."""

    cost: int
    action: str
    inserted: int  # role of the empty turn before it, or 0


def moves(costs: Costs) -> list[dict[tuple[int, int], Move]]:
    """The cheapest move between two states, for each role of the turn between them; of
    equal ones the first of keep, merge, relabel, insert."""
    found = []
    for role in range(4):
        table = {}
        for p in range(4):
            for q in (SYSTEM, USER, ASSISTANT):
                other = 0 if q == role else costs.relabel
                options = []
                if q in NEXT[p]:
                    options.append(Move(other, "relabel" if other else "keep", 0))
                if p == q:
                    options.append(Move(costs.merge + other, "merge", 0))
                options += [Move(costs.insert + other, "insert", x) for x in NEXT[p] if q in NEXT[x]]
                if options:
                    table[p, q] = min(options, key=lambda m: m.cost)
        found.append(table)
    return found


def endings(costs: Costs) -> list[int]:
    """Cost of ending in each state: the empty turns that are missing."""
    return [0, 2 * costs.insert, costs.insert, 0]


class Automaton:
    def __init__(self, costs: Costs):
        self.moves, self.ends = moves(costs), endings(costs)
        self.into = [
            [[(p, table[p, q].cost) for p in range(4) if (p, q) in table] for q in range(4)] for table in self.moves
        ]

    def step(self, at: list[int], role: int) -> tuple[list[int], list[int]]:
        """Costs of the states after a turn, and the state before on the cheapest way; of
        equal ones the first."""
        costs, before = [FAR] * 4, [0] * 4
        for q in (SYSTEM, USER, ASSISTANT):
            for p, cost in self.into[role][q]:
                if at[p] + cost < costs[q]:
                    costs[q], before[q] = at[p] + cost, p
        return costs, before

    def last(self, at: list[int]) -> int:
        """The state to end in."""
        return min(range(4), key=lambda q: at[q] + self.ends[q])

    def path(self, roles: Iterable[int], at: list[int], end: int | None) -> tuple[bytearray, list[int]]:
        """The states before the first and after every turn, and the costs at the end;
        ``end`` is the last state, or None where the conversation ends."""
        back = bytearray()  # the four states before, two bits each
        for role in roles:
            at, (a, b, c, d) = self.step(at, role)
            back.append(a | b << 2 | c << 4 | d << 6)
        states = bytearray([self.last(at) if end is None else end])
        for before in reversed(back):
            states.append(before >> 2 * states[-1] & 3)
        return states[::-1], at


def begin() -> list[int]:
    return [0, FAR, FAR, FAR]


class Entry(NamedTuple):
    """What a partition has to know: the costs its first stretch is entered with, the number
    of turns before it, and the state its last stretch is left in, or None at its end."""

    costs: list[int]
    turns: int
    leave: int | None


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """Consecutive rows of one conversation, over batches, as slices of these: what is held
    of a long conversation are Arrow's buffers."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        begun = 0
        for at, conv in enumerate(batch.column(0).to_pylist()):
            if last is not None and (conv,) != last:
                yield [*held, batch.slice(begun, at - begun)] if at > begun else held
                held, begun = [], at
            last = (conv,)
        if batch.num_rows > begun:
            held.append(batch.slice(begun))
    if held:
        yield held


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows in Python, at most ``ROWS`` at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield from zip(*(column.to_pylist() for column in batch.slice(at, ROWS).columns))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, int]]:
    for batch in batches:
        yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())


def _report(automaton: Automaton) -> Callable:
    """For each partition with rows: the conversations of its first and last stretch, their
    turns, the first one's costs from each state, and the last one's from the start."""

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = None
        turns = [0, 0]
        from_each = [[0 if s == p else FAR for p in range(4)] for s in range(4)]
        at, one = begin(), True
        for conv, role in _runs(batches):
            if first is None:
                first = (conv,)
            elif conv != last[0]:
                one, at, turns[1] = False, begin(), 0
            last = (conv,)
            if one:
                from_each = [automaton.step(x, role)[0] for x in from_each]
                turns[0] += 1
            else:
                at, turns[1] = automaton.step(at, role)[0], turns[1] + 1
        if first is not None:
            row = {"partition": TaskContext.get().partitionId(), "first": first[0], "last": last[0], "one": one}
            row |= {"first_turns": turns[0], "last_turns": turns[1], "from_each": sum(from_each, []), "at": at}
            yield pa.RecordBatch.from_pylist([row], REPORT_TYPE)

    return report


REPORT = (
    "partition int, first long, last long, one boolean, first_turns long, last_turns long, "
    "from_each array<long>, at array<long>"
)
REPORT_TYPE = pa.schema(
    [
        ("partition", pa.int32()),
        ("first", pa.int64()),
        ("last", pa.int64()),
        ("one", pa.bool_()),
        ("first_turns", pa.int64()),
        ("last_turns", pa.int64()),
        ("from_each", pa.list_(pa.int64())),
        ("at", pa.list_(pa.int64())),
    ]
)


def _origins(automaton: Automaton, entered: dict[int, list[int]]) -> Callable:
    """For each partition that is entered within a conversation: the state before its first
    stretch, for each state after it."""

    def origins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition = TaskContext.get().partitionId()
        at, origin, first = entered.get(partition), list(range(4)), None
        for conv, role in _runs(batches) if at is not None else ():
            if first is None:
                first = (conv,)
            elif conv != first[0]:
                break
            at, before = automaton.step(at, role)
            origin = [origin[p] for p in before]
        if first is not None:
            yield pa.RecordBatch.from_arrays([pa.array([partition], pa.int32()), pa.array([origin], pa.list_(pa.int32()))], ["partition", "origin"])

    return origins


def _entries(roles: DataFrame, automaton: Automaton) -> dict[int, Entry]:
    """The entry of every partition; the driver sees one row of either report for each."""
    reports = sorted(roles.mapInArrow(_report(automaton), REPORT).collect(), key=lambda r: r.partition)
    entered, costs, turns, leaving = {}, {}, {}, {}
    at, before, n = begin(), None, 0
    for r in reports:
        inside = before is not None and r.first == before.last
        costs[r.partition], turns[r.partition] = (at, n) if inside else (begin(), 0)
        if inside:
            entered[r.partition] = at
        begun = costs[r.partition]
        after = [min(begun[s] + r.from_each[4 * s + q] for s in range(4)) for q in range(4)]
        leaving[r.partition] = [min(x, FAR) for x in after]
        at, n = (leaving[r.partition], turns[r.partition] + r.first_turns) if r.one else (list(r.at), r.last_turns)
        before = r
    found = roles.mapInArrow(_origins(automaton, entered), "partition int, origin array<int>") if entered else None
    origin = {r.partition: r.origin for r in found.collect()} if found is not None else {}
    leave, later = {}, None
    for r in reversed(reports):
        leave[r.partition] = None
        if later is not None and later.first == r.last:
            # the next partition's first stretch ends there, or is left in a known state
            end = leave[later.partition] if later.one else None
            end = automaton.last(leaving[later.partition]) if end is None else end
            leave[r.partition] = origin[later.partition][end]
        later = r
    return {p: Entry(costs[p], turns[p], leave[p]) for p in costs}


def _render(text: str | None) -> str:
    """A text that cannot be taken for a marker."""
    return (text or "").replace("<|", "< |")


def repair_rows(stretch: list[pa.RecordBatch], automaton: Automaton, costs: Costs, entry: Entry) -> Iterator[tuple]:
    """The output rows of one stretch of ``conv_id, role number, turn, role, text``; its
    states come from the numbers alone, a byte for each turn, and then texts pass by."""
    numbers = bytearray(n for piece in stretch for n in piece.column(1).to_pylist())
    states, _ = automaton.path(numbers, entry.costs, entry.leave)
    for i, (conv, number, turn, role, text) in enumerate(_rows(stretch)):
        p, q = states[i], states[i + 1]
        move, seq = automaton.moves[number][p, q], 4 * (entry.turns + i)
        opened = OPEN if p == START else CLOSE + OPEN
        if move.inserted:
            name = ROLES[move.inserted]
            yield conv, None, seq, None, name, "insert", costs.insert, opened.format(name)
            opened = CLOSE + OPEN
        relabelled = number != q
        action = "merge" if move.action == "merge" else "relabel" if relabelled else "keep"
        price = move.cost - (costs.insert if move.inserted else 0)
        head = JOINT if action == "merge" else opened.format(ROLES[q])
        tail = ""
        ended = i == len(numbers) - 1 and entry.leave is None
        missing = {SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,)}.get(q, ()) if ended else ()
        if ended and not missing:
            tail = CLOSE
        yield conv, turn, seq + 1, role, ROLES[q], action, price, head + _render(text) + tail
        for k, x in enumerate(missing):
            tail = CLOSE if x == ASSISTANT else ""
            yield conv, None, seq + 2 + k, None, ROLES[x], "insert", costs.insert, (CLOSE + OPEN).format(ROLES[x]) + tail


def repair_roles(conversations: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """``conv_id, turn, seq, role, new_role, action, cost, rendered``: one row per row of
    ``conversations`` and one per inserted turn (whose ``turn`` and ``role`` are null).

    ``seq`` orders the rows of a conversation, and ``rendered`` joined in that order is its
    text: every turn is opened by its role and closed before the next, merged texts have a
    blank line between them, and ``<|`` within a text becomes ``< |``.  ``cost`` is what
    the row adds to the cost of its conversation, the least possible.

    Roles are compared without case and outer white space; others, and null, have to be
    relabelled.  Turns are ordered by ``turn``, nulls first; ties by their content, so that
    repeated rows, which are all kept, give one result.  A null ``conv_id`` is a
    conversation of its own.  A null text is empty.  Other columns are ignored, and no
    rows give no rows.
    """
    name = F.lower(F.btrim(F.coalesce("role", F.lit("")), F.lit(" \t\n\r\x0b\x0c")))
    number = F.coalesce(*(F.when(name == role, F.lit(k)) for k, role in enumerate(ROLES) if role), F.lit(UNKNOWN))
    rows = conversations.select(
        F.col("conv_id").cast("long"), number.alias("number"), F.col("turn").cast("long"), "role", "text"
    )
    order = ["conv_id", "turn", "tie", "same"]
    rows = rows.withColumns({"tie": F.xxhash64("role", "text"), "same": F.monotonically_increasing_id()})
    rows = settle(rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("tie", "same"))
    automaton = Automaton(costs)
    entries = _entries(rows.select("conv_id", "number"), automaton)
    names = [column.split()[0] for column in SCHEMA.split(", ")]

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entry = entries.get(TaskContext.get().partitionId())
        found: list[tuple] = []

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.string() if column.endswith("string") else pa.int64() for column in SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

        stretches, first, size = _stretches(batches), True, 0
        current = next(stretches, None)
        while current is not None:
            following = next(stretches, None)
            given = Entry(
                entry.costs if first else begin(), entry.turns if first else 0, entry.leave if following is None else None
            )
            for row in repair_rows(current, automaton, costs, given):
                found.append(row)
                size += len(row[-1])
                if len(found) == ROWS or size > CHARS:
                    yield batch_of(found)
                    found, size = [], 0
            current, first = following, False
        if found:
            yield batch_of(found)

    return rows.mapInArrow(repair, SCHEMA)
