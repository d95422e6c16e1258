"""Every registered query against its DuckDB SQL on the smallest driver tables."""

import collections
import datetime
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tallymart.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = collections.Counter(tuple(norm(r[c]) for c in cols) for r in df.collect())
    rel = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in rel.description]
    assert sorted(ocols) == cols
    rows = [dict(zip(ocols, r)) for r in rel.fetchall()]
    want = collections.Counter(tuple(norm(r[c]) for c in cols) for r in rows)
    assert got == want


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["categoria", "id_mesa"]
    assert df.count() > 0
