"""Every query of the core against its SQL, and shape checks for those without."""

import datetime
import math
import os
from collections import Counter

import duckdb
import pytest

from rollcall.plans import records, relational, scalar, training

DATA = os.environ.get("ROLLCALL_TEST_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
QUERIES = {**relational.QUERIES, **scalar.QUERIES, **records.QUERIES, **training.QUERIES}
SQL = {**relational.SQL, **scalar.SQL, **records.SQL, **training.SQL}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return str(v) if isinstance(v, (datetime.date, datetime.datetime)) else v


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    rows = Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())
    if name not in SQL:
        assert rows
        return
    cursor = duck.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert rows == Counter(tuple(plain(r[i]) for i in at) for r in cursor.fetchall())
