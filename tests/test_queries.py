"""Every query with SQL against DuckDB; the others against plain models elsewhere."""

import datetime
import decimal
import math

import duckdb
import pytest
from tests.conftest import DATA

from strandline.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return ("f", "nan" if math.isnan(v) else float(f"{v:.9g}"))
    if isinstance(v, int):
        return v
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    df = catalogue.queries()[name](spark, DATA)
    r = duck.sql(catalogue.oracle_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(r.columns)
    at = [r.columns.index(c) for c in columns]
    mine = sorted((tuple(plain(x[c]) for c in columns) for x in df.collect()), key=repr)
    theirs = sorted((tuple(plain(x[i]) for i in at) for x in r.fetchall()), key=repr)
    assert mine == theirs


def test_every_sql_has_a_query():
    assert set(catalogue.oracle_sql()) <= set(catalogue.queries())


@pytest.mark.parametrize("name", ["N01_em", "N03_pca", "N04_dbscan", "N05_sex_call", "R24_fnv"])
def test_kernels_give_rows(spark, name):
    assert catalogue.queries()[name](spark, DATA).count() > 0
