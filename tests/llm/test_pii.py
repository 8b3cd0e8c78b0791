from __future__ import annotations

import hashlib
import random
import re
import time

import numpy as np
import pytest

from ridelake.llm.pii_crf import (
    KINDS,
    LABELS,
    added_spans,
    base_spans,
    find,
    fit,
    graphs,
    in_order,
    known,
    luhn,
    mask,
    masked,
    op6_pii,
    untrained,
)

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [("email", m.start(), m.end()) for m in EMAIL.finditer(text)]
    out += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", m.start(), m.end()) for m in CARD.finditer(text) if 12 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]
    return in_order(out)


def test_base_spans_are_those_of_the_patterns():
    rng = random.Random(4)
    for _ in range(15000):
        text = "".join(rng.choice("aé@@..-+ 123456789  ()%\n") for _ in range(rng.randrange(0, 60)))
        assert base_spans(text) == plain(text), text


@pytest.mark.parametrize("text", ["1" * 100000, "a" * 100000 + "@", "1." * 50000, "+1" + " " * 100000, "a@" * 50000, "1 " * 50000])
def test_long_runs_take_little_time(text):
    begin = time.monotonic()
    base_spans(text)
    assert time.monotonic() - begin < 5


def test_zeros_before_the_parts_of_an_address():
    for part, fine in (("0" * 450 + "1", True), ("0" * 450, True), ("0" * 5000 + "255", True), ("0" * 450 + "256", False)):
        for text in (f"{part}.2.3.4", f"1.{part}.3.4", f"1.2.3.{part}"):
            assert base_spans(text) == ([("ip", 0, len(text))] if fine else [])


def test_query_against_the_patterns(documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    rows = op6_pii(documents).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = plain(texts[r.doc_id])
        assert [r[f"n_{k}"] for k in KINDS] == [sum(s[0] == k for s in want) for k in KINDS]
        joined = [f"{k}:{a}:{b}" for k, a, b in want]
        assert r.base_sha256 == hashlib.sha256(",".join(joined).encode()).hexdigest()
        assert set(joined) <= set(r.spans.split(",")) and r.n_added == len(set(r.spans.split(",")) - {""}) - len(set(joined))


@pytest.fixture(scope="module")
def model(spark):
    return fit(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))


def of(text, model):
    data = np.frombuffer(text.encode(), np.uint8)
    found = [g for _, g in graphs(data, np.array([0, len(data)]))]
    return added_spans(found[0], known(model, found)) if found else []


def test_similar_tokens_take_the_label_of_a_base_span(model):
    text = "Mail john.doe@host.org today. " + "Words in between. " * 20 + "Or john.doe@localhost, if that fails."
    assert [(k, text[a:b]) for k, a, b in of(text, model)] == [("email", "john.doe@localhost")]


def test_skip_links_are_what_makes_them_consistent(model):
    text = "Call +1 (974) 555-3436 now. " + "Words in between. " * 20 + "Number 555-3436 again."
    data = np.frombuffer(text.encode(), np.uint8)
    graph = next(g for _, g in graphs(data, np.array([0, len(data)])))
    linked = known(model, [graph])[-1, 1 + KINDS.index("phone")]
    graph.skips = []
    alone = known(model, [graph])[-1, 1 + KINDS.index("phone")]
    assert linked > alone


def test_messages_give_exact_marginals_on_a_chain(model):
    text = "say 555-1234 10.0.0.1 4111 here"
    data = np.frombuffer(text.encode(), np.uint8)
    graph = next(g for _, g in graphs(data, np.array([0, len(data)])))
    graph.labels, graph.skips = [0] * len(graph.labels), []
    score = model.weights[np.array(graph.features)].sum(axis=1)
    total = np.zeros((3, LABELS))
    for a in range(LABELS):
        for b in range(LABELS):
            for c in range(LABELS):
                path = [0, a, b, c, 0]
                weight = sum(model.chain[x, y] for x, y in zip(path, path[1:], strict=False))
                weight += score[0, a] + score[1, b] + score[2, c]
                for k, y in enumerate((a, b, c)):
                    total[k, y] += np.exp(weight)
    assert np.allclose(model.marginals([graph]), total / total.sum(axis=1, keepdims=True), atol=1e-3)


def test_clean_documents_get_few_spans(documents, model):
    rows = find(documents, model).collect()
    assert sum(r.n_added for r in rows) <= 0.02 * len(rows)


def test_odd_texts(texts, odd_texts):
    rows = [*odd_texts, (30, "a@b.c"), (31, "1 " * 5000 + "a@b.co"), (32, "\U0001f600 a@b.co")]
    got = {repr(r.doc_id): r for r in op6_pii(texts(rows)).collect()}
    assert got["1"].spans == "" and got["1"].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert "email:0:5" in got["30"].spans and "email:2:8" in got["32"].spans and got["31"].n_email == 1
    assert op6_pii(texts([])).count() == 0


def test_masking(texts, model):
    rows = [(1, "write to a.b@c.org or 10.1.2.3 ok"), (2, None), (3, "nothing"), (None, "x@y.zz")]
    df = texts(rows)
    got = mask(df, untrained())
    assert got.columns == df.columns
    assert {r.doc_id: r.text for r in got.collect()} == {1: "write to [email] or [ip] ok", 2: None, 3: "nothing", None: "[email]"}
    assert masked("abcdef", [("email", 0, 3), ("card", 2, 4)]) == "[email]ef"


def test_sample_of_the_fit_is_bounded_by_rows(texts, monkeypatch):
    from ridelake.llm import pii_crf

    given = []
    monkeypatch.setattr(pii_crf, "fitted", lambda packed, train: given.append(sorted(r.key for r in packed.collect())))
    rows = [(1, f"mail {n}@example.org or call 12345{n}") for n in range(200)] + [(n, f"{n}@example.org") for n in range(2, 10)]
    fit(texts(rows), 9)
    assert len(given[0]) == len(set(given[0])) == 9
