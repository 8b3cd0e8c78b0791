from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from ridelake.llm.common import pieces_of
from ridelake.llm.token_counts import Counter, op7_token_counts
from ridelake.llm.token_output import Encoder, Permutation, op10_token_output, read_shards, write_shards

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def counted(texts):
    count, out = Counter(PATH), []
    for _, _, data, offsets in pieces_of(pa.array([t.replace("▁", " ") for t in texts], pa.string())):
        out += count(data, offsets).tolist()
    return out


@given(st.lists(st.text(alphabet="ab the nin\té中ß ▁.,0-", max_size=80), max_size=20))
@settings(max_examples=150, deadline=None)
def test_counts_of_any_text(texts):
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    assert counted(texts) == [len(model.encode(t)) for t in texts]


def test_long_sequences(library):
    rng = random.Random(5)
    texts = ["a" * 30000, "ab" * 20000, " " * 20000, "".join(rng.choice("abcdefghij") for _ in range(20000)), "the" * 9000]
    assert counted(texts) == [len(library.encode(t)) for t in texts]


def test_query(documents, library):
    rows = {r.doc_id: r.text for r in documents.collect()}
    got = op7_token_counts(documents, PATH).collect()
    assert len(got) == len(rows)
    for r in got:
        n = len(library.encode(rows[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(rows[r.doc_id].encode()), n, n > 4096)


def test_query_on_odd_texts(texts, odd_texts, library):
    got = sorted((repr(r.doc_id), r.n_bytes, r.n_tokens) for r in op7_token_counts(texts(odd_texts), PATH).collect())
    assert got == sorted((repr(i), len((t or "").encode()), len(library.encode(t or ""))) for i, t in odd_texts)
    assert op7_token_counts(texts([]), PATH).count() == 0


def test_forgetting_changes_nothing(documents):
    texts = pa.array([r.text for r in documents.collect()])
    few, many = Counter(PATH, known=50), Counter(PATH)
    for _, _, data, offsets in pieces_of(texts, 20000):
        assert (few(data, offsets) == many(data, offsets)).all()


def test_ids_are_those_of_the_library(documents, odd_texts, library):
    encode = Encoder(PATH, known=2000)
    every = [r.text for r in documents.collect()] + [t or "" for _, t in odd_texts]
    for low, high, data, offsets in pieces_of(pa.array([t.replace("▁", " ") for t in every]), 50000):
        ids, at = encode(data, offsets)
        for k in range(low, high):
            assert ids[at[k - low] : at[k - low + 1]].tolist() == library.encode(every[k])


@pytest.mark.parametrize("size", [1, 2, 3, 10, 257, 4096, 5000])
def test_permutation(size):
    order = Permutation(size, key=9)
    slots = order.slot(np.arange(size))
    assert sorted(slots.tolist()) == list(range(size))
    assert (order.index(slots) == np.arange(size)).all()
    assert size < 10 or (Permutation(size, key=10).slot(np.arange(size)) != slots).any()


def test_shards_hold_every_token_once(documents, library):
    manifest = write_shards(documents, PATH, length=128, per_shard=64)
    rows = read_shards(manifest, length=128).collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    assert all(r.shard == r.slot // 64 and len(r.tokens) == 256 for r in rows)
    got = np.concatenate([np.frombuffer(r.tokens, "<u2")[: r.n_tokens] for r in rows])
    want = np.concatenate([np.array(library.encode(r.text) + [2]) for r in documents.collect()])
    assert (np.bincount(got, minlength=32000) == np.bincount(want, minlength=32000)).all()
    assert {i for r in rows for i in r.doc_ids} == {r.doc_id for r in documents.collect()}
    # Resumed in the middle of a shard.
    rest = read_shards(manifest, first_slot=100, length=128).collect()
    assert {r.slot: bytes(r.tokens) for r in rest} == {r.slot: bytes(r.tokens) for r in rows if r.slot >= 100}


def test_order_depends_on_the_key_alone(documents):
    one, same, other = (
        {r.slot: bytes(r.tokens) for r in read_shards(write_shards(documents, PATH, key, 256, 32), length=256).collect()}
        for key in (1, 1, 2)
    )
    assert one == same and one != other and sorted(one.values()) == sorted(other.values())


def test_shards_of_odd_texts(texts, odd_texts, library):
    rows = op10_token_output(texts(odd_texts), PATH).collect()
    assert sum(r.n_tokens for r in rows) == sum(len(library.encode(t or "")) + 1 for _, t in odd_texts)
    assert op10_token_output(texts([]), PATH).count() == 0
