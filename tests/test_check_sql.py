"""Every query with check SQL gives the same rows as a second engine on the same tables."""

import math
import os

import pytest

import __spark_entry__ as entry

SF = os.environ.get("RATELENS_TEST_DATA", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
QUERIES, SQL = entry.queries(), entry.oracle_sql()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def ordered(columns, rows):
    at = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(plain(r[i]) for i in at) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = duck.execute(SQL[name])
    columns = [d[0] for d in got.description]
    assert sorted(df.columns) == sorted(columns)
    assert ordered(df.columns, df.collect()) == ordered(columns, got.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry_returns_a_ranking(spark):
    rows = entry.entry(spark).collect()
    assert 0 < len(rows) <= 10
    deltas = [r["manipulation_delta"] for r in rows]
    assert deltas == sorted(deltas, reverse=True)
