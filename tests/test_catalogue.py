"""Every catalogue query against its SQL, as the driver compares them."""

import duckdb
import pytest

from brinefold.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def database():
    found = duckdb.connect()
    for t in TABLES:
        found.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return found


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_equals_sql(spark, database, name):
    df = catalogue.QUERIES[name](spark, SF)
    found = database.execute(catalogue.ORACLE_SQL[name])
    rows, columns = found.fetchall(), [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(columns)
    order = sorted(columns)
    assert sorted(repr([r[c] for c in order]) for r in df.collect()) == sorted(repr([dict(zip(columns, r))[c] for c in order]) for r in rows)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(catalogue.QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_filters_reach_the_scan(spark):
    text = catalogue.QUERIES["filter_eq"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    pushed = text.split("PushedFilters:")[1].split("\n")[0]
    assert "EqualTo(event_type,click)" in pushed and "ts" in pushed
    assert "props" not in text.split("ReadSchema:")[1].split("\n")[0]
