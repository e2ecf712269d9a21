"""The SQL of the registered queries, and what each query returns on whole small tables."""

import glob
import os

import duckdb
import pytest

from tessera.llm.queries import ORACLE_SQL, QUERIES


def tables(sf):
    con = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        src = f + "/*.parquet" if os.path.isdir(f) else f
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{src}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, sf, name):
    got = QUERIES[name](spark, sf).toPandas()
    want = tables(sf).execute(ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(got.columns)
    key = lambda d: sorted(map(tuple, d[cols].astype(object).values.tolist()), key=repr)
    assert key(got) == key(want)


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
