"""Every registered query of the core against its SQL on the smallest tables."""

import math
from collections import Counter
from pathlib import Path

import duckdb
import pyarrow as pa
import pytest

from tierflow.plans import registry

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DIR).exists(), reason="no test tables")


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return tuple(map(plain, v.values())) if isinstance(v, dict) else v


def rows(table: pa.Table) -> Counter:
    names = sorted(table.column_names)
    return Counter(tuple(plain(r[c]) for c in names) for r in table.to_pylist())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(DIR).glob("*.parquet"):
        con.sql(f"create view {p.stem} as select * from '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    got = registry.QUERIES[name](spark, DIR).toArrow()
    if name in registry.ORACLE:
        want = duck.sql(registry.ORACLE[name]).to_arrow_table()
        assert sorted(got.column_names) == sorted(want.column_names)
        assert rows(got) == rows(want)


def test_entry_and_names():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert len(registry.QUERIES) > 80
