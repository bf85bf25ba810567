import os

import duckdb
import pytest

from gristmill.plans import queries

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


def flat(v):
    if isinstance(v, (list, tuple)):
        return tuple(map(flat, v))
    return round(float(v), 6) if isinstance(v, float) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{DATA}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, duck, name):
    df = queries.QUERIES[name](spark, DATA)
    got = df.collect()
    if name in queries.ORACLE_SQL:
        cursor = duck.execute(queries.ORACLE_SQL[name])
        heads = [d[0] for d in cursor.description]
        assert sorted(heads) == sorted(df.columns)
        want = [dict(zip(heads, r, strict=True)) for r in cursor.fetchall()]
        key = lambda r: repr(tuple(flat(r[c]) for c in sorted(heads)))
        assert sorted(map(key, got)) == sorted(map(key, want))
    else:
        assert got


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
