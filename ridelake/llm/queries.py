"""The registered queries of the operators, and their SQL where SQL can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ridelake.llm import (
    best_fit_packing,
    chat_format,
    decontamination,
    embedding_whitening,
    impact_search,
    pii_crf,
    piece_sampling,
    quality_nbsvm,
    quality_rules,
    shingle_join,
    token_counts,
    token_output,
    toxicity_cnn,
)
from ridelake.llm.common import table


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_nbsvm.op1_quality_classifier(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_sampling.op2_sentencepiece(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.op3_ngram_jaccard(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.op4_decontamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.op5_quality_rules(table(spark, sf_dir, "documents"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_crf.op6_pii(table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.op7_token_counts(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.op8_chat_format(spark, table(spark, sf_dir, "conversations"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_cnn.op9_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.op10_token_output(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing.op11_best_fit_packing(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impact_search.op12_ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_whitening.op13_embedding_whitening(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_classifier,
        op2_sentencepiece,
        op3_ngram_jaccard,
        op4_decontamination,
        op5_quality_rules,
        op6_pii,
        op7_token_counts,
        op8_chat_format,
        op9_toxicity,
        op10_token_output,
        op11_best_fit_packing,
        op12_ranked_search,
        op13_embedding_whitening,
    )
}

ORACLES: dict[str, str] = {"op8_chat_format": chat_format.ORACLE, "op12_ranked_search": impact_search.ORACLE}
