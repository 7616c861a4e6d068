"""The registered queries against their SQL on the smallest tables."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

from tierflow.llm import oracle, queries

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DIR).exists(), reason="no test tables")


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    got = queries.QUERIES[name](spark, DIR).toArrow()
    if name in oracle.ORACLE:
        con = duckdb.connect()
        for p in Path(DIR).glob("*.parquet"):
            con.sql(f"create view {p.stem} as select * from '{p}'")
        want = con.sql(oracle.ORACLE[name]).to_arrow_table()
        names = sorted(want.column_names)
        rows = lambda t: Counter(tuple(r[c] for c in names) for r in t.to_pylist())
        assert sorted(got.column_names) == names and rows(got) == rows(want)
