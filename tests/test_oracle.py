"""Every registered query with SQL must give the rows of that SQL in DuckDB."""

from __future__ import annotations

import datetime
import math

import duckdb
import pytest
from tidepanel.plans.registry import ORACLE_SQL, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(sf_dir):
    own = duckdb.connect()
    for t in TABLES:
        own.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return own


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9) + 0.0)
    return v.isoformat() if isinstance(v, (datetime.datetime, datetime.date)) else repr(v)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    rows = sorted([plain(r[c]) for c in columns] for r in df.collect())
    assert rows
    if name in ORACLE_SQL:
        got = con.execute(ORACLE_SQL[name])
        names = [d[0] for d in got.description]
        assert sorted(names) == columns
        at = [names.index(c) for c in columns]
        assert rows == sorted([plain(r[i]) for i in at] for r in got.fetchall())
