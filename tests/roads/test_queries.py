"""Every query with SQL gives the rows that the SQL gives, on the smallest tables."""

import datetime
import math

import pytest

from kerbline import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    import duckdb

    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


def plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 6)
    return x.replace(tzinfo=None) if isinstance(x, datetime.datetime) else x


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query(spark, sf, duck, name):
    df = catalog.QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    result = duck.execute(catalog.SQL[name])
    names = [d[0] for d in result.description]
    want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in result.fetchall()), key=str)
    assert sorted(names) == columns and got == want


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_query_without_sql(spark, sf, name):
    assert catalog.QUERIES[name](spark, sf).count() > 0
