from __future__ import annotations

import corpus_pipeline
import pytest

import __spark_entry__
from ridelake.llm.common import ready, stored

SMALL = "/root/testdata/sf0.001"


def test_registered():
    names = set(__spark_entry__.queries())
    assert {f"op{n}_" for n in range(1, 11)} == {n.split("_")[0] + "_" for n in names if n.startswith("op")}
    assert "pipeline" in names
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard", "decontamination", "pii", "sentencepiece"]


@pytest.fixture(scope="module")
def stages(spark):
    """Documents before the first stage and after each."""
    docs = ready(spark).read.parquet(f"{SMALL}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], SMALL)))
    return out


def test_each_stage_keeps_rows_of_the_one_before(stages):
    ids = [{r.doc_id for r in df.select("doc_id").collect()} for df in stages]
    assert all(b <= a for a, b in zip(ids, ids[1:], strict=False)) and ids[-1]
    assert all(df.columns == stages[0].columns for df in stages[:-1])
    assert [df.count() for df in stages[1:]] == [len(i) for i in ids[1:]]


def test_decisions_take_effect(spark, stages):
    from ridelake.llm.decontamination import matches
    from ridelake.llm.pii_crf import op6_pii
    from ridelake.llm.shingle_join import similar_components

    alike = similar_components(stages[2]).collect()
    assert all(r.component_id == r.doc_id for r in alike)
    assert matches(stages[3], spark.read.parquet(f"{SMALL}/benchmark.parquet")).count() == 0
    assert all(r.n_email + r.n_ip + r.n_card + r.n_phone == 0 for r in op6_pii(stages[4]).collect())
    assert all(r.lossless for r in stages[5].collect())


def test_run_is_the_stages_in_turn(spark, stages):
    got = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert got == {r.doc_id: r.ids for r in stages[-1].collect()}


def test_odd_rows_pass_all_stages(spark, texts, odd_texts, tmp_path):
    df = texts(odd_texts)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        df = stored(stage(spark, df, SMALL))
    assert sorted(repr(r.doc_id) for r in df.collect()) == sorted(map(repr, [1, 2, 3, 4, None, 6, 7, 8, 9, 10]))
    empty = texts([])
    for _, stage in corpus_pipeline.STAGES:
        empty = stored(stage(spark, empty, SMALL))
    assert empty.count() == 0
