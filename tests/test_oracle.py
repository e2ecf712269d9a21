"""Every registered query against its DuckDB twin on the smallest driver tables."""

import math

import duckdb
import pytest

from tessera.plans.registry import load_all
from tessera.plans.views import TABLES, Views

from conftest import SF_SMALL

REG = load_all()


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(REG))
def test_query_matches_oracle(spark, con, name):
    q = REG[name]
    df = q.fn(Views(spark, SF_SMALL))
    cols = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    if q.sql is None:
        return
    res = con.execute(q.sql)
    ocols = [d[0] for d in res.description]
    assert sorted(ocols) == cols
    idx = [ocols.index(c) for c in cols]
    exp = sorted((tuple(norm(r[i]) for i in idx) for r in res.fetchall()), key=repr)
    assert got == exp


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() == 1
    assert set(E.oracle_sql()) <= set(E.queries())
