from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from ridelake.llm.common import Words, chunks, codepoints, pieces_of, span_hashes, text_bytes

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab é中\U0001f600\t\n\r\x0b\x0c\x85 .", max_size=30)), max_size=8)


@given(TEXTS)
@settings(max_examples=200, deadline=None)
def test_words_are_those_of_the_pattern(texts):
    data, offsets = text_bytes(pa.array(texts, pa.string()))
    words = Words(data, offsets)
    found = [data[a:b].tobytes().decode() for a, b in zip(words.starts, words.ends, strict=True)]
    assert found == [w for t in texts for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
    assert words.counts.tolist() == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]


@given(TEXTS)
@settings(max_examples=100, deadline=None)
def test_code_points(texts):
    data, _ = text_bytes(pa.array(texts, pa.string()))
    assert codepoints(data)[0].tolist() == [ord(c) for t in texts for c in t or ""]


def test_equal_words_have_equal_hashes_and_others_do_not():
    words = ["a", "b", "ab", "ba", "A", "a" * 5000, "a" * 5001, "", "a"]
    data = np.frombuffer("".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    hashes = span_hashes(data, ends - [len(w) for w in words], ends)
    assert hashes[0] == hashes[-1] and len(set(hashes.tolist())) == len(words) - 1
    lowered = span_hashes(data, ends - [len(w) for w in words], ends, lower=True)
    assert lowered[4] == lowered[0] == hashes[0]


def test_chunks_hold_whole_rows():
    offsets = np.array([0, 3, 3, 20, 21, 22])
    assert list(chunks(offsets, 5)) == [(0, 2), (2, 3), (3, 5)]
    assert list(chunks(np.zeros(1, np.int64))) == []


def test_slices_of_arrays_and_nulls():
    column = pa.array(["skip", "a", None, "b"]).slice(1)
    assert [d.tobytes() for _, _, d, _ in pieces_of(column)] == [b"ab"]
    assert text_bytes(pa.array([None, None], pa.string()))[1].tolist() == [0, 0, 0]
