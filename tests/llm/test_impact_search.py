from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ridelake.llm import impact_search
from ridelake.llm.common import text_bytes
from ridelake.llm.impact_search import CAP, IMPACT, WIDTH, Best, op12_ranked_search, search, summands, terms

SMALL = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def expected(docs, items, top=10):
    """Sorted (item_id, rank, doc_id, score), by sums over dictionaries."""
    found = [(i, Counter(terms_of(t))) for i, t in docs if terms_of(t)]
    number, length = len(found), sum(c.total() for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item_id, text in set(items):
        best = []
        for doc_id, c in found:
            m = 25 + 75 * c.total() * number // length
            score = sum(
                math.floor(1000 * math.log((2 * number + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in terms_of(text)
                if c[t]
            )
            if score > 0:
                best.append((-score, doc_id is None, doc_id or 0 if not isinstance(doc_id, str) else doc_id, doc_id))
        best.sort(key=lambda b: b[:3])
        out += [(item_id, k + 1, b[3], -b[0]) for k, b in enumerate(best[:top])]
    return sorted(out, key=repr)


def rows(df):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()), key=repr)


@given(st.lists(st.text(alphabet="aBé中 0_-\x00\x7f\x80'ÀZ", max_size=30), max_size=8))
@settings(max_examples=300, deadline=None)
def test_terms_of_any_text(texts):
    hashes, row, number = terms(*text_bytes(pa.array([*texts, "a B"], pa.string())))
    want = [terms_of(t) for t in [*texts, "a B"]]
    assert number.tolist() == [len(w) for w in want]
    flat = [t for w in want for t in w]
    assert len(flat) == len(hashes) and len(set(flat)) == len(set(hashes.tolist()))
    assert row.tolist() == [k for k, w in enumerate(want) for _ in w]


@given(st.lists(st.integers(0, 10 * CAP), min_size=1, max_size=9))
def test_summands_keep_partial_sums_exact(weights):
    weights = np.array(weights, np.int64)
    parts = summands(weights)
    assert (sum(p.astype(np.int64) for p in parts) == weights).all()
    assert max(p.max() for p in parts) * IMPACT * WIDTH < 2**53


@given(st.lists(st.lists(st.integers(0, 4), min_size=7, max_size=7), min_size=1, max_size=9), st.integers(1, 4))
@settings(max_examples=200, deadline=None)
def test_best_keeps_ties_by_id(tiles, top):
    best, every = Best(1, top), []
    for k, tile in enumerate(tiles):
        ids = [(37 * (7 * k + j)) % 101 for j in range(7)]
        every += [(-s, i) for s, i in zip(tile, ids, strict=True) if s > 0]
        best.add(np.array([tile], np.int64), pa.array(ids), 0)
    got = [] if best.table is None else [(-r["score"], r["doc_id"]) for r in best.table.to_pylist()]
    assert got == sorted(every)[:top]


def test_query(spark, documents):
    benchmark = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    items = [(r.item_id, r.text) for r in benchmark.collect()]
    assert rows(op12_ranked_search(documents, benchmark)) == expected(docs, items)


ITEMS = [(1, "a b c one"), (1, "a b c one"), (1, "line x"), (2, None), (3, ""), (4, " -- "), (5, "ONE Row é中"), (6, "a " * 3000)]


def test_odd_rows_in_several_passes_and_tiles(spark, texts, odd_texts, monkeypatch):
    benchmark = spark.createDataFrame([(i, t, 5, 6) for i, t in ITEMS], "item_id int, text string, doc_id long, rank int")
    docs = [*odd_texts, *((100 + k % 7, "one a " * (k % 5)) for k in range(60))]
    want = expected(docs, [i for i in ITEMS if i[1]])
    for tile, width, block, size in ((512, 1024, 256, 1 << 22), (3, 2, 2, 1 << 22), (4, 3, 1, 3000)):
        for name, v in (("TILE", tile), ("WIDTH", width), ("BLOCK", block)):
            monkeypatch.setattr(impact_search, name, v)
        assert rows(search(texts(docs).repartition(3), benchmark, size=size)) == want


def test_empty_tables(spark, texts, odd_texts):
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    assert search(texts([]), items).count() == 0
    assert search(texts(odd_texts), items.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]
    assert search(texts(odd_texts), items.limit(0)).count() == 0
    assert search(texts([(1, None), (2, " ")]), items).count() == 0


def test_copies_and_text_ids(spark):
    docs = [(f"d{k:03}", "the same words here" if k % 3 else f"other words {k}") for k in range(300)]
    table = spark.createDataFrame(docs, "doc_id string, text string").repartition(5)
    items = [("x", "same words"), ("y", "other 17 words")]
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    assert rows(search(table, benchmark)) == expected(docs, items)


def test_oracle(spark, documents):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    found = con.execute(impact_search.ORACLE).fetchall()
    benchmark = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    assert sorted(found, key=repr) == rows(op12_ranked_search(documents, benchmark))
