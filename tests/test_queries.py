"""Every registered query against its DuckDB oracle on the smallest provided tables."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


# The training-data operators have their own tests.
NAMES = sorted(set(entry.queries()) - set(entry.LLM_QUERIES))


def test_every_query_has_an_oracle():
    assert set(NAMES) == set(entry.oracle_sql()) - set(entry.LLM_ORACLE)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    s_cols, s_rows = _canon(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(entry.oracle_sql()[name])
    d_cols, d_rows = _canon([c[0] for c in cur.description], cur.fetchall())
    assert s_cols == d_cols
    s_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    d_types = {c[0]: c[1] for c in duck.execute(f"DESCRIBE {entry.oracle_sql()[name]}").fetchall()}
    assert s_types == d_types
    assert sum(s_rows.values()) == sum(d_rows.values())
    assert s_rows == d_rows


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert {"IssueKey", "Open", "InProgress"} <= set(df.columns)
