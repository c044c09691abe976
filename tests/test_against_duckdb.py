"""Registered queries against their SQL at the smallest scale."""

import re
import sys
from pathlib import Path

import duckdb
import pandas as pd
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
import __spark_entry__ as entry

# The training-data operators have tests of their own.
OWN = re.compile(r"op\d+_|pipeline$")
QUERIES = {name: query for name, query in entry.queries().items() if not OWN.match(name)}
ORACLE = {name: sql for name, sql in entry.oracle_sql().items() if not OWN.match(name)}


@pytest.fixture(scope="module")
def con(sf):
    con = duckdb.connect()
    for table in ("orders", "customer", "events"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    return con


def normal(df: pd.DataFrame) -> pd.DataFrame:
    out = df[sorted(df.columns)].astype(object).where(df[sorted(df.columns)].notna(), None)
    return out.map(lambda v: v if v is None else str(v)[:40])


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sf, con, name):
    got, want = QUERIES[name](spark, sf).toArrow(), con.sql(ORACLE[name]).to_arrow_table()
    assert sorted(got.column_names) == sorted(want.column_names)
    assert {f.name: str(f.type) for f in got.schema} == {f.name: str(f.type) for f in want.schema}
    left, right = normal(got.to_pandas()), normal(want.to_pandas())
    by = list(left.columns)
    left, right = (d.sort_values(by, key=lambda c: c.fillna("")).reset_index(drop=True) for d in (left, right))
    pd.testing.assert_frame_equal(left, right, check_dtype=False)
