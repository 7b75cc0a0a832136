"""Every query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

from vigil.plans import checks, operations, review, risk, serving

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events".split()
PLANS = {name: (plan.QUERIES[name], plan.SQL.get(name)) for plan in (risk, serving, checks, review, operations) for name in plan.QUERIES}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def normal(value):
    if value is None or value != value:
        return "null"
    if isinstance(value, float) or type(value).__name__.startswith(("float", "Decimal")):
        return repr(round(float(value), 9))
    return str(value)


def rows(names, records):
    at = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(normal(r[i]) for i in at) for r in records)


@pytest.mark.parametrize("name", sorted(PLANS))
def test_query_equals_sql(spark, duck, name):
    query, sql = PLANS[name]
    df = query(spark, DATA)
    ours = df.collect()
    if sql is None:
        assert ours
        return
    cursor = duck.execute(sql)
    names, theirs = [c[0] for c in cursor.description], cursor.fetchall()
    assert sorted(names) == sorted(df.columns)
    assert rows(df.columns, ours) == rows(names, theirs)
