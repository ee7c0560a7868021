"""Driver contract and every registered query against its DuckDB oracle
(brute force on the small table)."""

import os

import duckdb
import pytest

import __spark_entry__ as se
from helpers import SF_SMALL
from tidemark.sources.tables import TABLES


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.columns == ["window_start", "window_end", "rank", "item_id", "pv_count"]
    assert df.count() > 0


def test_every_query_has_oracle():
    assert set(se.QUERIES) == set(se.SQL)
    assert set(se.oracle_sql()) <= set(se.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF_SMALL, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(se.SQL))
def test_query_matches_oracle(spark, duck, name):
    df = se.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    rel = duck.sql(se.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    exp = sorted((tuple(_norm(v) for v in r) for r in rel.select(*[f'"{c}"' for c in cols]).fetchall()), key=repr)
    assert got == exp
