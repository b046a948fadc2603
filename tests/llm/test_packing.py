"""Packing: every id in exactly one piece, no gaps, little padding; the plan at any histogram."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from bandlex.llm import packing
from bandlex.llm.queries import op9_packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(rows, docs, window=2048):
    """Padding's share of all tokens, after holding the rows against the texts."""
    tokenizer = Tokenizer.from_file(PATH)
    ids = {}
    for d in docs:
        ids.setdefault(d.doc_id, []).append(tokenizer.encode(d.text or "", add_special_tokens=False).ids + [1])
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
        assert any(
            len(x) == r.doc_tokens and zlib.crc32(np.array(x[r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32
            for x in ids[r.doc_id]
        )
    assert set(pieces) == set(ids)
    for doc_id, found in pieces.items():
        expected = Counter(i for x in ids[doc_id] for i in range(len(x)))
        assert Counter(i for r in found for i in range(r.start, r.start + r.length)) == expected
    padding, total = 0, 0
    for found in sequences.values():
        found.sort(key=lambda r: r.offset)
        assert [r.offset for r in found] == [sum(x.length for x in found[:i]) for i in range(len(found))]
        size = sum(r.length for r in found)
        assert size <= window and len({r.tier for r in found}) == len({r.step_group for r in found}) == 1
        padding += 0 if size & (size - 1) == 0 else window - size
        total += size
    assert sorted(sequences) == list(range(len(sequences)))
    return padding / total


def test_query(spark, sf):
    rows = op9_packing(spark, sf).collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert check(rows, docs) < 0.005
    tokens = Counter()
    for r in rows:
        tokens[r.step_group] += r.length
    assert max(tokens.values()) - min(tokens.values()) <= 2 * sum(packing.TIERS)
    # most documents are cut at whole windows only
    assert sum(r.length % 2048 != 0 for r in rows) < 1.3 * len(docs)


def test_odd_rows(spark, odd_docs):
    check(packing.pack_documents(odd_docs, PATH).collect(), odd_docs.collect())
    assert packing.pack_documents(odd_docs.limit(0), PATH).collect() == []


@pytest.mark.parametrize("seed", range(8))
def test_plan_places_every_piece_once(seed):
    rng = random.Random(seed)
    counts = {}
    for _ in range(rng.choice([1, 3, 200, 2000])):
        counts[False, rng.randint(1, rng.choice([3, 300, 2048]))] = rng.choice([1, 7, 500])
    for b in range(11):
        counts[True, 1 << b] = rng.choice([0, 1, 90])
    counts = {k: n for k, n in counts.items() if n}
    runs, n_sequences = packing.plan_runs(counts)
    placed, sizes, spans = Counter(), Counter(), defaultdict(list)
    for run in runs:
        placed[run.filler, run.length] += run.count
        for i in range(run.count):
            sizes[run.sequence + i] += run.length
            spans[run.sequence + i].append((run.offset, run.length))
        same = [r for r in runs if r[:2] == run[:2]]
        assert sorted((r.first, r.count) for r in same)[0][0] == 0
    assert placed == Counter(counts)
    assert set(sizes) == set(range(n_sequences)) and max(sizes.values()) <= 2048
    for found in spans.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
    # at most the sequences that padding forces: no two can be joined
    short = sorted(s for s in sizes.values() if s & (s - 1))
    assert len(short) < 2 or short[0] + short[1] > 2048


def test_cut():
    assert packing.cut(2048 * 2 + 5, False) == [2048, 2048, 5]
    assert packing.cut(2048 + 7, True) == [2048, 4, 2, 1]
    assert packing.cut(1, False) == packing.cut(1, True) == [1]
