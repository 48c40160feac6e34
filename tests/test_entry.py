"""Every query against its SQL, on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__
from quirelight import plans

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


def plain(v):
    return None if v is None or (isinstance(v, float) and math.isnan(v)) else round(float(v), 9) if isinstance(v, float) else v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.sql(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    return c


@pytest.mark.parametrize("name", plans.QUERIES)
def test_query(spark, con, name):
    got = plans.QUERIES[name](spark, SF)
    rows = [tuple(plain(x) for x in r) for r in got.collect()]
    if name in plans.ORACLES:
        want = con.sql(plans.ORACLES[name])
        assert sorted(got.columns) == sorted(want.columns)
        at = [want.columns.index(c) for c in got.columns]
        assert sorted(map(str, rows)) == sorted(str(tuple(plain(r[i]) for i in at)) for r in want.fetchall())
    else:
        assert rows


def test_entry(spark):
    assert __spark_entry__.entry(spark).limit(1).count() == 1


def test_oracles_belong_to_queries():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
