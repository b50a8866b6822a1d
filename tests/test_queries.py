"""Every query of the library against its DuckDB form, on the smallest tables."""

import datetime
import decimal
import math

import duckdb
import pytest

from shoal.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, sf, duck, name):
    df = registry.queries()[name](spark, sf)
    columns = sorted(df.columns)
    rows = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    assert rows
    if name in registry.oracle_sql():
        found = duck.execute(registry.oracle_sql()[name])
        names = [x[0] for x in found.description]
        assert sorted(names) == columns
        want = sorted((tuple(plain(dict(zip(names, r, strict=True))[c]) for c in columns) for r in found.fetchall()), key=repr)
        assert rows == want
