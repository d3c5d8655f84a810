"""Every catalogue query against its SQL on the smallest tables; those without SQL run and keep their schema."""

import datetime
import math

import duckdb
import pytest

import __spark_entry__ as entry_points
from contigloom.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def plain(v):
    if v is None or isinstance(v, (bool, str)):
        return v
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    v = float(v)
    return None if math.isnan(v) else v + 0.0


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_matches_sql(spark, sf_dir, duck, name):
    df = catalog.QUERIES[name](spark, sf_dir)
    cur = duck.execute(catalog.ORACLES[name])
    names = [x[0] for x in cur.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted((tuple(map(plain, r)) for r in cur.fetchall()), key=str)
    got = sorted((tuple(plain(r[n]) for n in names) for r in df.collect()), key=str)
    assert got == want


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_solver_query_runs(spark, sf_dir, name):
    df = catalog.QUERIES[name](spark, sf_dir)
    assert df.count() > 0 and len(set(df.columns)) == len(df.columns)


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.count() > 0
    assert set(catalog.ORACLES) <= set(entry_points.queries()) and set(entry_points.oracle_sql()) <= set(entry_points.queries())
