"""Every registered query with an oracle gives the rows DuckDB gives on the same tables."""

import glob
import math
import os

import duckdb
import pytest

from workload.catalog import ORACLES, QUERIES


def _norm(v):
    if v is None or isinstance(v, bool):
        return v
    if isinstance(v, (int, float)):
        return "nan" if isinstance(v, float) and math.isnan(v) else float(v)
    return str(v)


def _sorted(rows):
    return sorted((tuple(_norm(v) for v in r) for r in rows), key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for path in glob.glob(f"{small}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, small, duck, name):
    df = QUERIES[name](spark, small)
    cursor = duck.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    expected = [[r[names.index(c)] for c in df.columns] for r in cursor.fetchall()]
    assert _sorted(tuple(r) for r in df.collect()) == _sorted(expected)


def test_every_query_reads_tables():
    assert set(ORACLES) <= set(QUERIES)
    assert len(QUERIES) > 140
