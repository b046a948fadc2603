"""Token counts and ids against the library, and what the cache does."""

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from bandlex.llm import token_counts
from bandlex.llm.queries import op7_token_counts
from bandlex.llm.shared import new_path
from bandlex.llm.tokens import PieceEncoder, tokenizer_digest

BYTE, WORD = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
PARTS = ["the", " the", "  ", "\n", "\n\n", "\t", "\r\n", "don't", "'s", "12", "é", "é", "Ü", " ", "​", "\x1c", "\x0b", "\x0c", "\x85", " ", "﻿", "<|endoftext|>", "<|startoftext|>", "日本", "!?", "_", "İ", "Σ", "́", "🙂", " ", "　", "x" * 80]
ENCODERS = {path: (PieceEncoder(path, held=50), Tokenizer.from_file(path)) for path in (BYTE, WORD)}


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.one_of(st.sampled_from(PARTS), st.text(max_size=6)), max_size=12).map("".join), min_size=1, max_size=4))
def test_pieces_have_the_ids_of_the_text(texts):
    for encoder, tokenizer in ENCODERS.values():
        for text, ids in zip(texts, encoder.encode(texts)):
            expected = tokenizer.encode(text, add_special_tokens=False).ids
            assert [int.from_bytes(ids[i : i + 4], "little") for i in range(0, len(ids), 4)] == expected


def brute(docs):
    tokenizer = Tokenizer.from_file(BYTE)
    for d in docs:
        n = len(tokenizer.encode(d.text or "", add_special_tokens=False).ids)
        yield d.doc_id, len((d.text or "").encode()), n, n > 1024


def test_query(spark, sf):
    rows = op7_token_counts(spark, sf).collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert sorted(tuple(r)[:4] for r in rows) == sorted(brute(docs))


@pytest.fixture
def counted(spark, monkeypatch):
    seen = []
    real = token_counts.encoded_counts

    def spy(rows, path):
        rows = rows.persist()
        seen.append(rows.count())
        return real(rows, path)

    monkeypatch.setattr(token_counts, "encoded_counts", spy)
    return seen


def test_odd_rows_and_cache(spark, odd_docs, counted):
    cache = new_path(spark, "cache")
    expected = sorted(map(str, brute(odd_docs.collect())))
    first = token_counts.count_tokens(odd_docs, BYTE, cache)
    assert sorted(str(tuple(r)[:4]) for r in first.collect()) == expected
    assert not any(r.cached for r in first.collect())
    # again, with one more text: only that is encoded
    more = odd_docs.unionByName(odd_docs.where("doc_id = 8").selectExpr("* except (text)", "'new text' AS text"))
    second = token_counts.count_tokens(more, BYTE, cache).collect()
    assert sorted(str(tuple(r)[:4]) for r in second) == sorted(map(str, brute(more.collect())))
    assert sum(not r.cached for r in second) == 1
    assert counted[1] == 1
    # another tokenizer has counts of its own
    token_counts.count_tokens(odd_docs, WORD, cache).collect()
    assert counted[2] == counted[0]
    stored = spark.read.parquet(cache)
    assert stored.groupBy("tokenizer").count().count() == 2
    assert stored.select("digest", "tokenizer").distinct().count() == stored.count()
    assert token_counts.count_tokens(odd_docs.limit(0), BYTE, new_path(spark, "cache")).collect() == []


def test_digest_tells_tokenizers_apart():
    assert tokenizer_digest(BYTE) != tokenizer_digest(WORD) == tokenizer_digest(WORD)
