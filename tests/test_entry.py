"""Driver contract: entry, queries and oracles agree on the small tables."""

import math
from datetime import datetime

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"nation_key", "customers", "balance", "last_customer"}


OWN = {**E.QUERIES, **E.EDGE_QUERIES, **E.DELIVERY_QUERIES}


def test_every_query_has_an_oracle():
    assert set(OWN) == set(E.oracle_sql()) & set(OWN)


@pytest.mark.parametrize("name", sorted(OWN))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    res = duck.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(res.columns)
    assert _canon(df.columns, got) == _canon(res.columns, res.fetchall())
