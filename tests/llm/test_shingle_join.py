from __future__ import annotations

import random
import re

import numpy as np
import pytest

from ridelake.llm import shingle_join
from ridelake.llm.components import components
from ridelake.llm.shingle_join import links_in, one_of_each, op3_ngram_jaccard, prefix_tree, traversed


def shingles(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def brute(rows):
    """(doc_id, n_shingles, component_id) by comparing all pairs."""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            one, two = sets[a][1], sets[b][1]
            if one and two and 100 * len(one & two) >= 75 * len(one | two):
                parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return sorted((repr(i), len(s), repr(least.get(root(k)))) for k, (i, s) in enumerate(sets))


def found(df):
    return sorted((repr(r.doc_id), r.n_shingles, repr(r.component_id)) for r in op3_ngram_jaccard(df).collect())


def variants(rng, count):
    """Groups of near copies around the threshold, sharing passages across groups."""
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    passage = [word() for _ in range(60)]
    rows = []
    for _ in range(count):
        base = [word() for _ in range(rng.randrange(3, 120))]
        if rng.random() < 0.5:
            base = passage + base[: rng.randrange(1, 40)]
        for _ in range(rng.randrange(1, 6)):
            own = list(base)
            for _ in range(rng.randrange(0, 4)):
                own[rng.randrange(len(own))] = word()
            text = " ".join(own)
            rows.append((len(rows) + 1, text.upper() if rng.random() < 0.2 else text))
    return rows


@pytest.mark.parametrize(("block", "group", "wide"), [(1 << 20, 1024, 8), (300, 3, 8), (300, 3, 0)])
def test_against_all_pairs(texts, monkeypatch, block, group, wide):
    monkeypatch.setattr(shingle_join, "WIDE", wide)
    monkeypatch.setattr(shingle_join, "BLOCK", block)
    monkeypatch.setattr(shingle_join, "GROUP", group)
    monkeypatch.setattr(shingle_join, "RANGE", 2000)
    rows = variants(random.Random(block), 60)
    assert found(texts(rows).repartition(4)) == brute(rows)


def test_on_documents(documents):
    assert found(documents) == brute([(r.doc_id, r.text) for r in documents.collect()])


def test_odd_texts(texts, odd_texts):
    assert found(texts(odd_texts)) == brute(odd_texts)


def test_empty_table(texts):
    assert found(texts([])) == []
    assert one_of_each(texts([])).count() == 0


def test_one_of_each(texts, odd_texts):
    rows = [*odd_texts, (20, "p q r s t u v w"), (19, "P q r s t u v w"), (21, None)]
    df = texts(rows)
    kept = one_of_each(df)
    assert kept.columns == df.columns
    got = sorted(repr(r.doc_id) for r in kept.collect())
    # 5 repeats 4 (and itself), 20 repeats 19; rows without id or words stay.
    assert got == sorted(map(repr, [1, 2, 3, 4, None, 6, 7, 8, 9, 10, 19, 21]))


def test_one_of_each_goes_by_texts(texts):
    def text(word):
        return " ".join(f"{word}{k}" for k in range(40))

    near = text("a").replace("a39", "other")
    rows = [
        (3, text("a")),
        (5, text("b")),
        (5, text("b")),
        (5, near),
        (5, text("c")),
        (6, text("c")),
        (None, text("d")),
        (None, text("d").upper()),
        (None, text("a")),
        (None, text("e")),
        (7, text("e")),
        (7, ""),
        (7, ""),
        (7, None),
        (None, ""),
        (None, ""),
    ]
    got = sorted(((r.doc_id, (r.text or repr(r.text)).lower()) for r in one_of_each(texts(rows).repartition(3)).collect()), key=repr)
    want = [(3, text("a")), (5, text("b")), (5, text("c")), (None, text("d")), (7, text("e")), (7, "''"), (7, "none"), (None, "''"), (None, "''")]
    assert got == sorted(want, key=repr)


def test_columns_keep_their_values_whatever_their_names(spark):
    names = ["__text", "__id", "__n", "__own", "__named", "row", "text_", "n", "f1", "f2", "id", "own", "named", "stays", "component"]
    rows = [(k, f"one two three four five {k // 2}", *(f"{n} {k}" for n in names)) for k in range(6)]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, {', '.join(f'`{n}` string' for n in names)}")
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect())) == [r for r in rows if r[0] % 2 == 0]


def test_one_id_on_many_texts(texts):
    rows = [(1 if n % 3 else n, f"{n} one text with words of its own {n * 7} and {n * n}") for n in range(90)]
    assert one_of_each(texts(rows)).count() == 90


def test_tree_traversal_gives_all_partners():
    rng = np.random.default_rng(2)
    pool = np.sort(rng.integers(0, 1 << 60, 400).astype(np.uint64))
    sets = [np.sort(rng.choice(pool[:80], rng.integers(1, 60), replace=False)) for _ in range(60)]
    sets += [s.copy() for s in sets[:5]] + [np.sort(np.append(s, pool[100 + k])) for k, s in enumerate(sets[:20])]
    sizes = [len(s) + int(rng.integers(0, 5)) for s in sets]
    root = prefix_tree(sets, sizes)
    for k, own in enumerate(sets):
        got = {j for j, overlap in traversed(root, own, sizes[k]) if 7 * overlap >= 3 * (sizes[k] + sizes[j])}
        want = {
            j for j in range(len(sets)) if 7 * len(np.intersect1d(own, sets[j])) >= 3 * (sizes[k] + sizes[j])
        }
        assert got == want


def test_links_connect_what_is_linked():
    rng = np.random.default_rng(4)
    base = np.arange(100, dtype=np.uint64)
    sets = [np.sort(rng.choice(base, 90, replace=False)) for _ in range(30)] + [np.arange(200, 300, dtype=np.uint64)]
    sizes = [len(s) for s in sets]
    got = links_in(sets, sizes, np.arange(len(sets)))
    assert len(got) == 29 and all(30 not in pair for pair in got)
    assert links_in(sets, sizes, np.zeros(len(sets), int)) == []


def test_components_of_long_chains_and_hubs(spark):
    edges = [(k, k + 1) for k in range(100, 160)] + [(1, k) for k in range(2, 30)] + [(7, 7), (500, 499)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.id: r.component for r in components(df).collect()}
    want = {k: 100 for k in range(100, 161)} | {k: 1 for k in range(1, 30)} | {499: 499, 500: 499}
    assert got == want


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
