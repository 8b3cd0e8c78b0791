from __future__ import annotations

import pytest

from ridelake.llm.common import ready

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def texts(spark):
    """texts([(doc_id, text), ...]) -> documents, with columns whose names operators use inside."""
    ready(spark)

    def make(rows):
        full = [(i, t, "en", "src", None if t is None else len(t), -1, "x", b"y") for i, t in rows]
        return spark.createDataFrame(
            full,
            "doc_id long, text string, lang string, source string, n_chars long, key long, label string, tokens binary",
        )

    return make


@pytest.fixture(scope="session")
def documents(spark):
    return ready(spark).read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SMALL}/labels.parquet")


@pytest.fixture(scope="session")
def odd_texts():
    """Nulls, empties, blanks, ties, long words and texts, control characters, other scripts."""
    return [
        (1, None),
        (2, ""),
        (3, "  \t\n "),
        (4, "one"),
        (5, "one"),
        (5, "one"),
        (None, "a row without id"),
        (6, "a b c d e " * 400),
        (7, "x" * 30000),
        (8, "é中\U0001f600 ▁▁ \x00 ﬁ <s></s> <|im_end|>"),
        (9, "line\nline\n\nline \r\n line"),
        (10, " " * 5000 + "end"),
    ]
