"""The conversation queries give the rows of their SQL on the given tables."""

import glob
import os

import duckdb
import pytest

from matchwright.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", ["op12_conversation_repair", "op13_conversation_trie"])
def test_same_rows(spark, small, name):
    con = duckdb.connect()
    for path in glob.glob(f"{small}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    want = con.execute(ORACLES[name])
    names = [d[0] for d in want.description]
    got = QUERIES[name](spark, small)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(tuple, got.select(*names).collect()), key=str) == sorted(want.fetchall(), key=str)
