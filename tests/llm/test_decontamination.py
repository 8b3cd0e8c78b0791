from __future__ import annotations

import random

import numpy as np
import pytest

from ridelake.llm import decontamination
from ridelake.llm.decontamination import distance, matches, op4_decontamination, without_items


def table_distance(pattern, text):
    row = [0] * (len(text) + 1)
    for a in range(1, len(pattern) + 1):
        new = [a]
        for b in range(1, len(text) + 1):
            new.append(min(row[b] + 1, new[-1] + 1, row[b - 1] + (pattern[a - 1] != text[b - 1])))
        row = new
    return min(row), row.index(min(row))


def test_distance_against_dynamic_programming():
    rng = random.Random(1)
    for _ in range(300):
        pattern = "".join(rng.choice("abé") for _ in range(rng.randrange(1, 90)))
        text = "".join(rng.choice("abé") for _ in range(rng.randrange(0, 120)))
        assert distance(pattern, text, 0) == table_distance(pattern, text) or distance(pattern, text, 0)[0] == 0 == table_distance(pattern, text)[0]


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")


def fold(text):
    return " ".join((text or "").lower().split())


def test_exact_passages_are_found_and_nothing_else(documents, benchmark):
    items = [(r.item_id, fold(r.text)) for r in benchmark.collect()]
    want = {(r.doc_id, i) for r in documents.collect() for i, t in items if t in fold(r.text)}
    got = op4_decontamination(documents, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want)
    texts = {r.doc_id: r.text for r in documents.collect()}
    for r in got:
        assert r.edit_distance == 0
        words = fold(texts[r.doc_id]).split(" ")[r.first_word : r.first_word + r.n_words]
        assert dict(items)[r.item_id] in " ".join(words)


@pytest.mark.parametrize(("rate", "least"), [(0.0, 1.0), (0.02, 1.0), (0.05, 0.99), (0.1, 0.95)])
def test_recall_against_exact_edit_distance(texts, benchmark, rate, least):
    rng = random.Random(7)
    items = [(r.item_id, r.text) for r in benchmark.collect()]
    filler = "quite other words stand before and behind the passage that is looked for here"
    rows, due = [], set()
    for n, (item_id, text) in enumerate(items):
        edited = "".join(rng.choice(["", "q", c + "z"]) if rng.random() < rate else c for c in text)
        rows.append((n, f"{filler} {edited.upper() if n % 3 == 0 else edited}\n {filler}"))
        if table_distance(fold(text), fold(rows[-1][1]))[0] <= int(0.2 * len(fold(text))):
            due.add((n, item_id))
    got = {(r.doc_id, r.item_id) for r in matches(texts(rows), benchmark).collect()}
    assert got <= due and len(got) >= least * len(due)


@pytest.mark.parametrize("rate", [0.12, 0.15, 0.18, 0.2])
@pytest.mark.parametrize("size", [44, 64, 120, 400])
def test_recall_up_to_the_accepted_distance_by_length(benchmark, size, rate):
    rng = random.Random(size)
    letters = "abcdefghijklmnopqrstuvwxyz"
    items = [fold(r.text[:size]) for r in benchmark.collect()]
    index = decontamination.Index.of(list(range(len(items))), items)
    rows, due = [], set()
    for n in range(160):
        item = items[n % len(items)]
        edited = "".join(rng.choice(["", rng.choice(letters), c + rng.choice(letters)]) if rng.random() < rate else c for c in item)
        rows.append(fold(f"some words before {edited} and some words behind").encode())
        if len(item) >= 40 and distance(item, rows[-1].decode(), 0)[0] <= int(0.2 * len(item)):
            due.add((n, n % len(items)))
    offsets = np.cumsum([0, *map(len, rows)])
    got = {found[:2] for found in index.held(np.frombuffer(b"".join(rows), np.uint8), offsets)}
    assert len(due) >= 50 and len(got & due) >= 0.97 * len(due)


def every(k):
    return lambda t, rng: "".join(rng.choice("bcdfgklmnp") if n % k == k - 1 else c for n, c in enumerate(t))


EDITS = {
    "no blanks": lambda t, rng: t.replace(" ", ""),
    "signs for blanks": lambda t, rng: t.replace(" ", "_"),
    "every 8th": every(8),
    "every 7th": every(7),
    "every 6th": every(6),
    "every 5th": every(5),
}


@pytest.mark.parametrize("edit", EDITS)
@pytest.mark.parametrize(("size", "least"), [(400, 0.95), (100, 0.9), (64, 0.9)])
def test_recall_of_regular_edits(benchmark, size, least, edit):
    rng = random.Random(size)
    items = [fold(r.text[:size]) for r in benchmark.collect()]
    items = [i for i in items if len(i) >= min(size, 80)]
    index = decontamination.Index.of(list(range(len(items))), items)
    rows = [fold(f"some words before {EDITS[edit](i, rng)} and some words behind").encode() for i in items]
    due = {(n, n) for n, i in enumerate(items) if distance(i, rows[n].decode(), 0)[0] <= int(0.2 * len(i))}
    offsets = np.cumsum([0, *map(len, rows)])
    got = {found[:2] for found in index.held(np.frombuffer(b"".join(rows), np.uint8), offsets)}
    assert len(due) >= 20 and len(got & due) >= least * len(due)


def test_walks_step_by_step():
    rng = np.random.default_rng(4)
    data = rng.integers(97, 105, 500).astype(np.uint8)
    padded = np.append(data, np.full(20, 0x20, np.uint8))
    for table, (_, sampled) in enumerate(decontamination.TABLES):
        want = []
        for start in range(len(data)):
            at, seen = start, []
            for step in range(decontamination.STEPS):
                if step in sampled:
                    seen.append(int(decontamination.CODES[step][padded[at]]))
                at += int(decontamination.MOVES[table][step][padded[at]])
            total = 0
            for code in reversed(seen):
                total = (total * int(decontamination.FACTOR) + code) % (1 << 32)
            want.append(total)
        assert decontamination.walks(data, table).tolist() == want


def test_limits_are_arguments(spark, texts):
    items = spark.createDataFrame([(1, "thirty characters of one item"), (2, "twelve of it")], "item_id long, text string")
    rows = [(1, "x thirty charakters off one item y"), (2, "x twelve off it y"), (3, "x twelve of it y")]

    def found(limits):
        return sorted((r.doc_id, r.item_id) for r in matches(texts(rows), items, limits=limits).collect())

    assert found(decontamination.Limits()) == [(3, 2)]
    assert found(decontamination.Limits(shortest=25, whole=5)) == [(1, 1), (2, 2), (3, 2)]
    assert found(decontamination.Limits(most=0.05, shortest=25, whole=20)) == [(3, 2)]


def test_copies_of_short_and_blank_free_items(spark, texts):
    chinese = "请问下列哪一项不是光合作用的产物以及它在植物体内的作用是什么请说明理由并举出至少两个例子加以解释"
    items = [
        (1, "What is 2+2?"),
        (2, "Who wrote Hamlet and when was it?"),
        (3, "水的沸点是多少"),
        (4, chinese),
        (5, "https://example.org/a/very/long/path/that/has/no/blank?query=1&other=2"),
        (6, "art"),
        (7, "é"),
        (8, "pneumonoultramicroscopicsilicovolcanoconiosisesare words"),
        (9, "  "),
        (10, None),
    ]
    rows = [
        (1, "They asked:  what is\n2+2? And so on"),
        (2, "it said (who wrote hamlet and when was it?) there"),
        (3, "it said who wrote hamlt and when was it? there"),
        (4, "it said who wrote hamlt and when is it? there"),
        (5, "我想知道水的沸点是多少度"),
        (6, "前面还有别的文字" + chinese + "后面也还有别的文字"),
        (7, "前面还有别的文字" + chinese.replace("植物", "动物") + "后面也还有别的文字"),
        (8, "see(https://example.org/a/very/long/path/that/has/no/blank?query=1&other=2)there"),
        (9, "the start of a party, artful"),
        (10, "the start of a party: Art!"),
        (11, "café"),
        (12, "x é"),
        (13, "xxpneumonoultramicroscopicsilicovolcanoconiosisesare wordsyy"),
        (14, "what is 2+22?"),
        (15, "art"),
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.edit_distance, r.first_word, r.n_words) for r in matches(texts(rows), benchmark).collect()}
    assert got == {
        (1, 1): (0, 2, 3),
        (2, 2): (0, 2, 7),
        (3, 2): (1, 2, 7),
        (5, 3): (0, 0, 1),
        (6, 4): (0, 0, 1),
        (7, 4): (1, 0, 1),
        (8, 5): (0, 0, 1),
        (10, 6): (0, 5, 1),
        (12, 7): (0, 1, 1),
        (13, 8): (0, 0, 2),
        (15, 6): (0, 0, 1),
    }
    assert sorted(r.doc_id for r in without_items(texts(rows), benchmark).collect()) == [4, 9, 11, 14]


def test_an_edit_in_short_items_is_found_wherever_it_is():
    rng = random.Random(9)
    for size in range(1, 40):
        item = "".join(rng.choice("abcdeé中") for _ in range(size))
        index = decontamination.Index.of([1], [item])
        edits = [item]
        if size >= 20:
            edits += [item[:k] + change + item[k + 1 :] for k in range(size) for change in ("", "z", item[k] + "z")]
        rows = [f"some {e} text".encode() for e in edits]
        held = list(index.held(np.frombuffer(b"".join(rows), np.uint8), np.cumsum([0, *map(len, rows)])))
        assert [h[0] for h in held] == list(range(len(rows)))
        assert all(h[2] <= 1 and h[3:] == (1, 1) for h in held)


def test_a_repeated_item_is_sent_once(spark, texts, benchmark, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK", 2000)
    item = benchmark.first()
    repeated = spark.createDataFrame([(item.item_id, item.text)] * 300 + [(-1, item.text)], "item_id long, text string")
    sent = list(decontamination.indexes(repeated, "item_id", "text"))
    assert sorted(i for index in sent for i in index.ids) == [-1, item.item_id]
    got = [r.item_id for r in matches(texts([(1, f"x {item.text} y"), (2, "z")]), repeated).collect()]
    assert sorted(got) == [-1] + [item.item_id] * 300


def test_lower_bound_is_one(benchmark):
    rng = random.Random(3)
    items = [fold(r.text) for r in benchmark.collect()]
    index = decontamination.Index.of(list(range(len(items))), items)
    text = " ".join(fold(r) for r in rng.sample(items, 10))
    kinds = np.frombuffer(text.encode("utf-32-le"), np.uint32) % decontamination.KINDS
    for _ in range(20):
        item = np.array([rng.randrange(len(items)) for _ in range(5)])
        low = np.array([rng.randrange(len(text) // 2) for _ in range(5)])
        high = low + [rng.randrange(1, len(text) // 2) for _ in range(5)]
        least = index.least(item, low, high, kinds)
        for i, a, b, bound in zip(item, low, high, least, strict=True):
            assert bound <= distance(items[i], text[a:b], 0)[0]
            merged = [ord(c) % decontamination.KINDS for c in items[i]]
            assert bound == sum(table_distance(merged[k : k + 64], kinds[a:b])[0] for k in range(0, len(merged), 64))


def test_odd_rows(spark, texts, odd_texts, benchmark):
    item = benchmark.first().text
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "short"), (4, item), (4, item), (5, "  ".join(item.split()))], "item_id long, text string")
    rows = [*odd_texts, (50, item), (50, item), (51, "x " * 3000 + item + " y" * 3000)]
    got = sorted((r.doc_id, r.item_id) for r in matches(texts(rows), odd).collect())
    assert got == sorted([(50, 4)] * 4 + [(50, 5)] * 2 + [(51, 4)] * 2 + [(51, 5)])
    clean = without_items(texts(rows), odd)
    assert clean.columns == texts([]).columns
    assert sorted(repr(r.doc_id) for r in clean.collect()) == sorted(repr(i) for i, _ in odd_texts)


def test_empty_tables(texts, odd_texts, benchmark):
    assert matches(texts([]), benchmark).count() == 0
    assert matches(texts(odd_texts), benchmark.limit(0)).count() == 0
    assert without_items(texts(odd_texts), benchmark.limit(0)).count() == len(odd_texts)


def test_blocks_of_items(documents, benchmark, monkeypatch):
    want = sorted(map(tuple, matches(documents, benchmark).collect()))
    monkeypatch.setattr(decontamination, "BLOCK", 2000)
    assert sorted(map(tuple, matches(documents, benchmark).collect())) == want
