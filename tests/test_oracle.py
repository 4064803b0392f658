"""Every query against its SQL form in DuckDB, with names, types and values compared."""

from __future__ import annotations

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.conftest import SMALL, plan_of

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return con


def rows(table):
    ordered = table.select(sorted(table.column_names))
    return sorted(tuple(repr(v) for v in row.values()) for row in ordered.to_pylist())


def types(table):
    return {f.name: str(f.type).removeprefix("large_") for f in table.schema}


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, duck, name):
    df = queries()[name](spark, SMALL)
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan
    got = df.toArrow()
    if name not in oracle_sql():
        assert got.num_rows > 0
        return
    want = duck.sql(oracle_sql()[name]).to_arrow_table()
    assert types(got) == types(want)
    assert rows(got) == rows(want)


def test_every_sql_form_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["category", "posts", "mean_popularity", "mean_sentiment", "busiest_author_posts"]
    assert df.count() == 5
