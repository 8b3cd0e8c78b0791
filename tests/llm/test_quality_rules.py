from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest

from ridelake.llm.quality_rules import fit, op5_quality_rules, weak_quality


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    twice = {w for w, n in Counter(windows).items() if n > 1}
    cover = {k + j for k, w in enumerate(windows) if w in twice for j in range(3)}
    seen, repeats = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeats += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(cover) > 50 * len(words)
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        repeats,
        len(cover),
        failed,
    )


def check(df, rows):
    got = sorted(
        (repr(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        for r in op5_quality_rules(df).collect()
    )
    assert got == sorted((repr(i), *brute(t)) for i, t in rows)


def test_figures_against_brute_force(documents):
    check(documents, [(r.doc_id, r.text) for r in documents.collect()])


def test_odd_texts(texts, odd_texts):
    check(texts(odd_texts), odd_texts)


def test_base_failures_are_never_kept(documents):
    rows = op5_quality_rules(documents).collect()
    assert not any(r.kept and r.base_failed for r in rows) and any(r.kept for r in rows)


def test_bad_texts_are_found(documents, labels):
    found = {r.doc_id: r.kept for r in op5_quality_rules(documents).collect()}
    quality = {r.doc_id: r.quality for r in labels.collect()}
    bad = [found[i] for i, q in quality.items() if q == 0]
    good = [found[i] for i, q in quality.items() if q == 1]
    assert np.mean(bad) < 0.1 and np.mean(good) > 0.85


def test_em_recovers_known_accuracies():
    rng = np.random.default_rng(3)
    good = rng.random(60000) < 0.8
    against = [np.where(good, rng.random(60000) < g, rng.random(60000) < b) for g, b in ((0.01, 0.6), (0.02, 0.5), (0.01, 0.4))]
    for_ = np.where(good, rng.random(60000) < 0.9, rng.random(60000) < 0.2)
    votes = np.stack([-a.astype(int) for a in against] + [for_.astype(int)], axis=1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = fit(patterns, counts.astype(float))
    sure = model.log_odds(votes) > 0
    assert (sure == good).mean() > 0.85


def test_model_without_rows(texts):
    judged, model = weak_quality(texts([]))
    assert judged.count() == 0 and 0 < model.prior < 1


def test_posterior_is_one_number_for_one_pattern(documents):
    judged, _ = weak_quality(documents)
    votes = [c for c in judged.columns if c.startswith("vote_")]
    assert judged.groupBy(*votes).agg({"posterior": "min"}).count() == judged.select(*votes, "posterior").distinct().count()


@pytest.mark.parametrize("threshold", [0.0, 1.1])
def test_threshold(documents, threshold):
    judged, _ = weak_quality(documents, threshold=threshold)
    assert {r.good for r in judged.select("good").distinct().collect()} == {threshold == 0.0}
