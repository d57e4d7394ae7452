"""The operators that SQL can express, against DuckDB over the smallest tables."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from issuelens.llm.queries import ORACLE, QUERIES


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


def test_all_operators_and_the_pipeline_are_registered():
    names = entry.queries()
    for n in range(1, 14):
        assert [k for k in names if k.startswith(f"op{n}_")], n
    assert "pipeline" in names


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = QUERIES[name](spark, SF_SMALL)
    cur = con.execute(ORACLE[name])
    want = canon([c[0] for c in cur.description], cur.fetchall())
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == want
