"""Registered queries against their DuckDB SQL on the smallest driver tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from loomtext.plans import catalog, files
from loomtext.sources.tables import TABLES

QUERIES = catalog.QUERIES | files.QUERIES  # the training-data operators have tests of their own
SQL = catalog.ORACLE | files.ORACLE
FAST = [n for n in SQL if n not in ("nb_predict", "holdout_metrics", "nb_priors", "nb_theta")]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF_SMALL, f"{t}.parquet")
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def _rows(records):
    return sorted((tuple(_norm(x) for x in r) for r in records), key=repr)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    cols = sorted(sdf.columns)
    got = _rows(tuple(r[c] for c in cols) for r in sdf.collect())
    res = con.execute(SQL[name])
    dcols = [d[0] for d in res.description]
    assert sorted(dcols) == cols
    want = _rows(tuple(r[dcols.index(c)] for c in cols) for r in res.fetchall())
    assert got == want


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"title", "page_id", "url", "category"}
