"""Corpus queries against their SQL, and what every module must keep to."""

import re
from pathlib import Path

import duckdb
import pytest

import brinefold
from brinefold.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_equals_sql(spark, name):
    database = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        database.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df, found = QUERIES[name](spark, SF), database.execute(ORACLE_SQL[name])
    rows, columns = found.fetchall(), [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(columns)
    order = sorted(columns)
    assert sorted(repr([r[c] for c in order]) for r in df.collect()) == sorted(repr([dict(zip(columns, r))[c] for c in order]) for r in rows)


def test_one_query_for_each_operator():
    assert [int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES] == list(range(1, 11))


def test_nothing_else_imports_the_folder():
    top = Path(brinefold.__file__).parent
    others = [p for p in top.rglob("*.py") if p.parent.name != "llm"]
    assert others and not any(re.search(r"^\s*(from|import)\s.*\bllm\b", p.read_text(), re.M) for p in others)
    assert not any("localCheckpoint(" in p.read_text() for p in top.rglob("*.py"))
