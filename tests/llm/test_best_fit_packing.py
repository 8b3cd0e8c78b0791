from __future__ import annotations

import random
import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ridelake.llm.best_fit_packing import (
    Capacities,
    PartIds,
    best_fit,
    op11_best_fit_packing,
    packed,
    pieces,
    placed,
    sequences,
)
from ridelake.llm.common import text_bytes

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def one_by_one(lengths, size):
    """Sequences that best-fit decreasing takes, piece by piece with a sorted list."""
    open_bins, made = [], 0
    for n in sorted(lengths, reverse=True):
        at = bisect_left(open_bins, n)
        if at == len(open_bins):
            made, left = made + 1, size - n
        else:
            left = open_bins.pop(at) - n
        if left:
            insort(open_bins, left)
    return made


def check_gapless(rows, size=4096):
    inside = defaultdict(list)
    for r in rows:
        inside[r.sequence_id].append((r.offset, r.length))
    for spans in inside.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= size
    return len(inside)


odd = st.text(alphabet="ab Aé'sßΣ1２ \t\x0b\x0c\r\n\x1c\x85  ́中\x00<|endoftext>.,", max_size=60)


ENCODE = PartIds(PATH, known=3000)


def ids_of(encode, texts):
    data, offsets = text_bytes(pa.array(texts, pa.string()))
    return encode(data, offsets)


@given(st.lists(odd, max_size=12))
@settings(max_examples=1500, deadline=None)
def test_ids_of_any_text(texts):
    texts = [*texts, "a <|endoftext|>b<|startoftext|>.<|ENDOFTEXT|> it's .'s 's'S 'll'"]
    ids, at = ids_of(ENCODE, texts)
    for k, t in enumerate(texts):
        assert ids[at[k] : at[k + 1]].tolist() == ENCODE.model.encode(t, add_special_tokens=False).ids


def test_forgetting_changes_nothing(documents):
    texts = [r.text for r in documents.limit(50).collect()]
    whole, _ = ids_of(PartIds(PATH), texts)
    encode = PartIds(PATH, known=100)
    parts = [ids_of(encode, texts[k : k + 5])[0] for k in range(0, 50, 5)]
    assert np.array_equal(np.concatenate(parts), whole)


@given(st.sets(st.integers(1, 60)), st.integers(1, 60))
@settings(max_examples=200, deadline=None)
def test_segment_tree(capacities, need):
    tree = Capacities(60)
    for c in capacities:
        tree.open(c, c, 1)
    assert tree.tightest(need) == min((c for c in capacities if c >= need), default=-1)
    for c in sorted(capacities)[::2]:
        tree.take(c)
    assert tree.tightest(need) == min((c for c in sorted(capacities)[1::2] if c >= need), default=-1)


@given(st.lists(st.integers(1, 40), max_size=120))
@settings(max_examples=300, deadline=None)
def test_plan_is_best_fit_decreasing(lengths):
    counts = Counter(lengths)
    plan, made = best_fit(counts, 40)
    assert made == one_by_one(lengths, 40)
    length = np.array(sorted(lengths), np.int64)
    rank = np.array([k for n in sorted(counts) for k in range(counts[n])], np.int64)
    sequence, offset = placed(plan, length, rank) if lengths else ([], [])
    used = defaultdict(list)
    for s, o, n in zip(sequence, offset, length, strict=True):
        used[int(s)].append((int(o), int(n)))
    assert len(used) == made
    for spans in used.values():
        spans.sort()
        assert spans[0][0] == 0
        assert all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:], strict=False))
        assert sum(spans[-1]) <= 40


def test_plan_of_many_pieces_is_small():
    rng = random.Random(3)
    counts = {n: rng.randrange(1, 10**9) for n in range(1, 4097)}
    plan, made = best_fit(counts)
    total = sum(n * c for n, c in counts.items())
    assert -(-total // 4096) <= made <= 1.25 * total / 4096
    assert len(plan) < 200_000


def expected(rows, library):
    out = Counter()
    for doc_id, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start : start + 4096]
            out[doc_id, piece, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    return out


def test_query(documents, library):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = op11_best_fit_packing(documents, PATH).collect()
    want = expected(rows, library)
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    assert check_gapless(got) == one_by_one([k[3] for k in want.elements()], 4096)


def test_odd_texts(texts, odd_texts, library):
    got = op11_best_fit_packing(texts(odd_texts), PATH).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == expected(odd_texts, library)
    check_gapless(got)
    assert op11_best_fit_packing(texts([]), PATH).count() == 0


def test_places_depend_on_rows_alone(documents):
    def rows(docs):
        return sorted(tuple(r) for r in op11_best_fit_packing(docs, PATH).collect())

    assert rows(documents.repartition(5)) == rows(documents.coalesce(1))


def test_one_length_and_one_id_may_hold_most_rows(spark):
    rows = [(7 if k % 3 else k, "same words") for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = op11_best_fit_packing(docs, PATH).collect()
    assert len(got) == 3000 and len({(r.sequence_id, r.offset) for r in got}) == 3000
    assert check_gapless(got) == -(-3000 // (4096 // 3))


def test_text_ids_and_sequences_with_ids(spark, library):
    rows = [(f"d{k}", "word " * (k * 37 % 900)) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    found = packed(pieces(docs, PATH, size=512), size=512)
    whole = {r.sequence_id: np.frombuffer(r.ids, "<u4") for r in sequences(found).collect()}
    texts = defaultdict(list)
    for r in sorted(found.collect(), key=lambda r: (r.doc_id, r.piece)):
        texts[r.doc_id] += whole[r.sequence_id][r.offset : r.offset + r.length].tolist()
    for doc_id, text in rows:
        assert texts[doc_id] == [*library.encode(text, add_special_tokens=False).ids, 1]
    assert all(len(ids) <= 512 for ids in whole.values())
