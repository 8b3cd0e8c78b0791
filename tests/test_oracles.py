"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from ridelake.plans import queries as plans

SF = Path("/root/testdata/sf0.001")
# The text operators have tests of their own.
QUERIES = {name: query for name, query in entry_points.queries().items() if name in plans.QUERIES}
SQL = {name: sql for name, sql in entry_points.oracle_sql().items() if name in plans.QUERIES}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in SF.glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float)):
        return float(value)
    return str(value)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("left", ["nothing", "an empty folder"])
def test_queries_without_the_text_operators(tmp_path, left):
    """What is registered does not depend on the text operators, even if their folder is left over."""
    here = Path(entry_points.__file__).parent
    (tmp_path / "ridelake").mkdir()
    for p in (here / "ridelake").iterdir():
        if p.name != "llm":
            (tmp_path / "ridelake" / p.name).symlink_to(p)
    if left != "nothing":
        (tmp_path / "ridelake/llm/__pycache__").mkdir(parents=True)
    (tmp_path / "entry_copy.py").write_text((here / "__spark_entry__.py").read_text())
    code = "import entry_copy as e; print(len(e.queries()), len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True)
    assert done.stdout.split() == [str(len(plans.QUERIES))] * 2


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, duck, name):
    df = QUERIES[name](spark, str(SF))
    names = sorted(df.columns)
    ours = [tuple(plain(r[c]) for c in names) for r in df.collect()]
    cursor = duck.execute(SQL[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == names
    theirs = [tuple(plain(r[columns.index(c)]) for c in names) for r in cursor.fetchall()]
    assert sorted(ours, key=repr) == sorted(theirs, key=repr)
