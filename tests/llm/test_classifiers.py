from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ridelake.llm import quality_nbsvm, toxicity_cnn
from ridelake.llm.common import held_out, pieces_of
from ridelake.llm.quality_nbsvm import op1_quality_classifier
from ridelake.llm.supervised import labelled_sample, platt, sigmoid
from ridelake.llm.toxicity_cnn import Model, buckets, op9_toxicity, padded, without_toxic

QUERIES = [(op1_quality_classifier, "quality", 5, 0), (op9_toxicity, "toxic", 3, 1)]


def held(doc_id, parts, rest):
    import zlib

    return zlib.crc32(str(doc_id).encode()) % parts == rest


@pytest.fixture(scope="module")
def larger(spark):
    folder = "/root/testdata/sf0.1"
    return spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")


@pytest.mark.parametrize(("query", "label", "parts", "rest"), QUERIES)
def test_held_out_accuracy(larger, query, label, parts, rest):
    docs, labels = larger
    rows = query(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == held(r.doc_id, parts, rest) and 0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == int(r.score >= (0.3 if label == "quality" else 0.7)) for r in rows)
    truth = {r.doc_id: r[label] for r in labels.collect()}
    own = [(truth[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean([t == p for t, p in own]) > 0.95


@pytest.mark.parametrize(("query", "label", "parts", "rest"), QUERIES)
def test_held_out_labels_do_not_matter(spark, documents, labels, query, label, parts, rest):
    rows = [tuple(r) for r in labels.collect()]
    at = labels.columns.index(label)
    turned = [(*r[:at], 1 - r[at], *r[at + 1 :]) if held(r[0], parts, rest) else r for r in rows]
    one, two = (
        {r.doc_id: r.score for r in query(documents, spark.createDataFrame(x, labels.schema)).collect()} for x in (rows, turned)
    )
    assert one == two


@pytest.mark.parametrize(("query", "label", "parts", "rest"), QUERIES)
def test_odd_rows(spark, texts, odd_texts, documents, labels, query, label, parts, rest):
    shared = texts(odd_texts)
    few = spark.createDataFrame([(i, i % 2, i % 2) for i in [1, 2, 3, 4, 4, 5, 6, 8, 9, 10]] + [(None, 1, 1), (7, None, None)], labels.schema)
    rows = query(shared, few).collect()
    assert len(rows) == len(odd_texts) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1 or label == "toxic"
    assert len({r.score for r in rows if r.doc_id in (4, 5)}) == 1
    none = query(shared, few.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert query(texts([]), labels).count() == 0
    # One class alone: the smoothed share of label 1.
    same = query(shared, spark.createDataFrame([(i, 1, 1) for i in range(1, 11)], labels.schema)).collect()
    assert len({r.score for r in same}) == 1 and same[0].score > 0.5


def test_indicators_are_distinct_by_text():
    texts = ["a b a b", "", "x", "a a a a"]
    for _, _, data, offsets in pieces_of(pa.array(texts)):
        row, feature = quality_nbsvm.indicators(data, offsets)
    by_text = [feature[row == k].tolist() for k in range(4)]
    assert all(len(set(f)) == len(f) for f in by_text) and not by_text[1]
    # Words a, b; pairs ab, ba; trigrams of the bytes.
    assert len([f for f in by_text[0] if f < 1 << quality_nbsvm.WORD_BITS]) == 4


def test_dual_descent_reaches_the_optimum():
    rng = np.random.default_rng(1)
    texts = [np.unique(rng.integers(0, 40, 12)).astype(np.int32) for _ in range(120)]
    positive = np.array([(t < 15).sum() > 4 for t in texts])
    scale = np.ones(quality_nbsvm.SIZE, np.float32)
    w = quality_nbsvm.dual_descent(texts, positive, scale, rounds=400)

    def loss(w):
        y = np.where(positive, 1, -1)
        cost = 0.5 / np.where(positive, positive.mean(), 1 - positive.mean())
        x = np.array([w[t].sum() / np.sqrt(len(t)) for t in texts])
        return 0.5 * float(w @ w) + float((cost * np.maximum(0, 1 - y * x)).sum())

    best = loss(w)
    for _ in range(200):
        other = w.copy()
        other[:40] += rng.normal(0, 0.02, 40).astype(np.float32)
        assert loss(other) > best - 1e-3


def test_platt_fits_a_logistic_curve():
    rng = np.random.default_rng(2)
    margin = rng.normal(0, 2, 20000)
    slope, intercept = platt(margin, rng.random(20000) < sigmoid(1.5 * margin - 0.7))
    assert abs(slope - 1.5) < 0.1 and abs(intercept + 0.7) < 0.1


def test_pooling_against_loops():
    rng = np.random.default_rng(3)
    size = toxicity_cnn.FILTERS
    filters = {w: rng.normal(size=(w, toxicity_cnn.DIMENSIONS, size)).astype(np.float32) for w in toxicity_cnn.WIDTHS}
    vectors = rng.normal(size=(7, toxicity_cnn.DIMENSIONS)).astype(np.float32)
    vectors[0] = 0
    model = Model(np.arange(5), vectors, filters, np.zeros(3 * size), np.zeros(3 * size), 0.0)
    model.rows(np.zeros(0, np.int64))
    lists = [[3], [], [2, 4, 5, 6, 1], [1, 1]]
    at = np.concatenate(([0], np.cumsum([len(x) for x in lists])))
    got = model.pooled(*padded(np.array(sum(lists, []), np.int32), at))
    for k, own in enumerate(lists):
        full = [0, *own, 0, 0]
        want = [
            np.max([sum(vectors[full[p + j]] @ filters[w][j] for j in range(w)) for p in range(len(own) + 1)], axis=0)
            for w in toxicity_cnn.WIDTHS
        ]
        assert np.allclose(got[k], np.concatenate(want), atol=1e-5)


def test_punctuation_and_case_do_not_make_other_words():
    for _, _, data, offsets in pieces_of(pa.array(["Word word, \"WORD!\" (word) wor.d !!! ???"])):
        ids, _ = buckets(data, offsets)
    assert len(set(ids[:4].tolist())) == 1 and ids[4] != ids[0] and ids[5] == ids[6]


def test_stage_keeps_columns(texts, odd_texts, larger):
    docs, labels = larger
    model = toxicity_cnn.fit(docs, labels, "toxic", held_out(labels.doc_id, 3, 1))
    df = texts([*odd_texts, (60, "you are an idiot, a stupid loser, worthless and pathetic scum, a disgusting clown")])
    kept = without_toxic(df, model)
    assert kept.columns == df.columns
    assert sorted(repr(r.doc_id) for r in kept.collect()) == sorted(repr(i) for i, _ in odd_texts)


def test_sample_is_bounded_by_rows(spark, texts):
    rows = [(1, f"text {n}") for n in range(200)] + [(n, "other") for n in range(2, 12)] + [(12, None), (12, None)]
    labels = spark.createDataFrame([(n, n % 2) for n in range(1, 13)], "doc_id long, good int")
    got = labelled_sample(texts(rows), labels, "good", F.lit(False), 12).collect()
    assert len(got) == 12 and len({r.key for r in got}) == 12
    assert [r.text for r in labelled_sample(texts(rows[::-1]), labels, "good", F.lit(False), 12).orderBy("key").collect()] == [
        r.text for r in sorted(got, key=lambda r: r.key)
    ]


def test_all_labelled_texts_are_trained_on(spark, texts):
    marks = [f"mark{n}" for n in range(20)]
    rows = [(n, f"plain words {marks[n % 20]} {'vile' if n % 5 == 0 else 'kind'}") for n in range(400)] + [(401, ""), (402, None), (None, "vile")]
    labels = spark.createDataFrame([(n, int(n % 5 == 0)) for n in range(403)], "doc_id long, toxic int")
    # 400 texts, 30 to a shard; before, 30 texts in all.
    model = toxicity_cnn.fit(texts(rows), labels, "toxic", F.lit(False), 30)
    for _, _, data, offsets in pieces_of(pa.array([" ".join([*marks, "vile", "kind", "plain", "words"])])):
        assert set(buckets(data, offsets)[0].tolist()) == set(model.known.tolist())
    kept = [r.doc_id for r in without_toxic(texts(rows[:400]), model).collect()]
    assert sorted(kept) == [n for n in range(400) if n % 5]
    # Neither the order of rows nor how they are split matters.
    again = toxicity_cnn.fit(texts(rows[::-1]).repartition(7), labels.repartition(3), "toxic", F.lit(False), 30)
    assert np.array_equal(model.vectors, again.vectors) and np.array_equal(model.output, again.output)
    assert (model.slope, model.intercept, model.threshold) == (again.slope, again.intercept, again.threshold)


def test_shards_of_one_class_give_its_share(spark, texts):
    rows = [(n, f"word {n}") for n in range(50)]
    labels = spark.createDataFrame([(n, 1) for n in range(50)], "doc_id long, toxic int")
    model = toxicity_cnn.fit(texts(rows), labels, "toxic", F.lit(False), 10)
    assert not len(model.known) and abs(sigmoid(model.intercept) - 51 / 52) < 1e-9
