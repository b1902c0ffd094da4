from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from spanvec.llm import byte_bpe
from spanvec.llm.queries import vocabulary

RANKS = vocabulary()
BPE = byte_bpe.ByteBpe(RANKS, public_tokenizers.PATTERN)
REFERENCE = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@given(st.text(max_size=80))
@settings(max_examples=400, deadline=None)
def test_any_text(text):
    text = text.encode("utf-8", "replace").decode()
    assert BPE.encode(text) == REFERENCE.encode_ordinary(text)
    assert BPE.decode(BPE.encode(text)) == text.encode()


def test_mixed_pieces():
    rng = random.Random(1)
    parts = ["a", "b", "ab", "the", " ", "  ", "\n", "\t", "é", "ß", "1", "23", "!!", "***", "'s", "'re", "日本", "x" * 50, "ing", "tion", "\x00", "\x1c", "\x85", "　", "<|endoftext|>"]
    for _ in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))
        assert BPE.encode(text) == REFERENCE.encode_ordinary(text)


def test_pairs_as_merging_says():
    rng, made = random.Random(2), sorted(BPE.made)
    for _ in range(4000):
        a, b = rng.choice(made), rng.choice(made)
        if len(a) + len(b) < 24:
            assert BPE.go_together(a, b) == (BPE.merge(a + b) == [a, b])


def test_one_piece_of_a_hundred_thousand_letters():
    rng = random.Random(3)
    text = "".join(rng.choice("abcdefgh") for _ in range(100_000))
    assert BPE.encode(text) == REFERENCE.encode_ordinary(text)


def test_tokens_that_merges_never_make():
    """A rank table where "abc" cannot be reached, and repeated letters."""
    ranks = {bytes([b]): b for b in range(256)} | {b"bc": 256, b"ab": 257, b"abc": 300, b"aa": 301, b"aaa": 302, b"abcd": 303}
    own, other = byte_bpe.ByteBpe(ranks, r"\S+|\s+"), tiktoken.Encoding("x", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(4)
    for _ in range(2000):
        text = "".join(rng.choice("aaabcd ") for _ in range(rng.randint(0, 14)))
        assert own.encode(text) == other.encode_ordinary(text), text


def test_memory_is_bounded():
    memory = byte_bpe.Memory(3)
    for i in range(100):
        memory.put(i, i)
        assert memory.get(0) in (0, None) and len(memory.new) <= 3 and len(memory.old) <= 3


def test_a_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r for r in byte_bpe.encode_documents(docs, RANKS, public_tokenizers.PATTERN, with_ids=True).collect()}
    for r in docs.collect():
        ids = REFERENCE.encode_ordinary(r.text or "")
        assert got[r.doc_id].ids == ids and got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


def test_odd_rows(odd_docs, clashing_docs, no_docs):
    want = sorted((str(r.doc_id), r.text or "") for r in odd_docs.collect())
    for docs in (odd_docs, clashing_docs):
        encoded = byte_bpe.encode_documents(docs, RANKS, public_tokenizers.PATTERN, with_ids=True)
        assert sorted((str(r.doc_id), r.text) for r in byte_bpe.decode_documents(encoded, RANKS).collect()) == want
        assert {r.n_tokens for r in encoded.where("doc_id in (1, 2)").collect()} == {0}
        assert {r.ids_sha256 for r in encoded.where("doc_id in (1, 2)").collect()} == {hashlib.sha256(b"").hexdigest()}
    assert byte_bpe.encode_documents(no_docs, RANKS, public_tokenizers.PATTERN).count() == 0
    with pytest.raises(ValueError):
        byte_bpe.ByteBpe({b"a": 0}, r"\S+").encode("ab")
