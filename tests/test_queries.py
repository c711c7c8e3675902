"""Queries of the engine against the SQL that they are held against, on the smallest tables."""

import glob
import os

import duckdb
import pytest

from mergeweave import registry, registry_files

NAMES = [n for n, f in registry.QUERIES.items() if f.__module__ == registry_files.__name__]


@pytest.fixture(scope="module")
def tables(data):
    con = duckdb.connect()
    for path in glob.glob(f"{data}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_as_sql(spark, data, tables, name):
    df = registry.QUERIES[name](spark, data)
    result = tables.execute(registry.SQL[name])
    names = [d[0] for d in result.description]
    want = sorted((tuple(r[names.index(c)] for c in sorted(names)) for r in result.fetchall()), key=str)
    assert sorted(df.columns) == sorted(names)
    assert sorted((tuple(r[c] for c in sorted(names)) for r in df.collect()), key=str) == want
    assert want
