from __future__ import annotations

import glob
import hashlib

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ridelake.llm import chat_format
from ridelake.llm.chat_format import (
    ORACLE,
    escaped,
    escaped_roles,
    format_chat,
    op8_chat_format,
    read_back,
    turns_of,
    unescaped,
    unescaped_role,
)
from ridelake.llm.common import ready

CONTROL = st.text(alphabet="<|>\\\nim_startend a", max_size=20)


@given(CONTROL)
@settings(max_examples=300, deadline=None)
def test_escaping_is_reversible_and_leaves_no_control_string(text):
    import pyarrow as pa

    out = escaped(pa.array([text]))[0].as_py()
    assert unescaped(out) == text and "<|" not in out
    role = escaped_roles(pa.array([text]))[0].as_py()
    assert unescaped_role(role) == text and "\n" not in role and "<|" not in role


def expected(rows):
    """(n_turns, turns, loss text) by conversation."""
    out = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: ((r[1] is not None, r[1] or 0), r[2] or "", r[3] or "")):
        got = out.setdefault(conv, [0, "", ""])
        got[0] += 1
        got[1] += f"{role or ''}\n{text or ''}\n"
        got[2] += (text or "") if role == "assistant" else ""
    return out


ROWS = [
    (1, 0, "user", "hi <|im_end|>\n"),
    (1, 1, "assistant", "é\U0001f600 <\\|im_start|>"),
    (1, 1, "assistant", "é\U0001f600 <\\|im_start|>"),
    (1, 1, "Zoe", "tie"),
    (1, None, None, None),
    (2, 5, "assistant", ""),
    (3, 0, "a\\n\nb", "x" * 3000),
    (None, 0, "user", "no id"),
    *[(4, k, "assistant" if k % 2 else "user", f"turn {k} " * 40) for k in range(500)],
]


@pytest.mark.parametrize("part", [1 << 20, 1000])
def test_round_trip(spark, monkeypatch, part):
    monkeypatch.setattr(chat_format, "PART", part)
    df = ready(spark).createDataFrame([(*r, 1) for r in ROWS], "conv_id long, turn long, role string, text string, part long")
    parts = format_chat(df)
    got = {r.conv_id: r for r in read_back(parts).collect()}
    want = expected(ROWS)
    assert set(got) == set(want)
    for conv, (n, turns, loss) in want.items():
        r = got[conv]
        assert (r.n_turns, r.loss_chars) == (n, len(loss))
        assert r.turns_sha256 == hashlib.sha256(turns.encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def test_masks_lie_on_assistant_texts(spark):
    df = ready(spark).createDataFrame(ROWS, "conv_id long, turn long, role string, text string")
    for r in format_chat(df).collect():
        masked = [unescaped(r.formatted[a:b]) for a, b in zip(r.loss_starts, r.loss_ends, strict=True)]
        assert masked == [t for role, t in turns_of(r.formatted) if role == "assistant"]
        assert r.n_turns == len(turns_of(r.formatted))


def test_query_against_sql(spark):
    folder = "/root/testdata/sf0.01"
    got = op8_chat_format(ready(spark), spark.read.parquet(f"{folder}/conversations.parquet"))
    con = duckdb.connect()
    for f in glob.glob(f"{folder}/conversations.parquet"):
        con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{f}'")
    cursor = con.execute(ORACLE)
    assert [c[0] for c in cursor.description] == got.columns
    assert sorted(map(tuple, got.collect())) == sorted(cursor.fetchall())


def test_only_the_special_conversation(spark):
    df = ready(spark).createDataFrame([], "conv_id long, turn long, role string, text string")
    rows = op8_chat_format(spark, df).collect()
    text = "<|im_end|><|im_start|>assistant ok"
    assert [(r.conv_id, r.n_turns, r.loss_chars) for r in rows] == [(-1, 2, len(text))]
    assert rows[0].loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
