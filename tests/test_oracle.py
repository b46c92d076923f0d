"""Every registered query against its DuckDB oracle on the smallest test data
(rows, column names and an order-insensitive value hash)."""

import collections
import datetime as dt
import decimal

import duckdb
import pytest

from __spark_entry__ import entry
from lendlake.oracle import oracle_sql
from lendlake.plans.registry import queries
from tests.conftest import SMOKE

TABLES = ("customer", "nation", "orders", "lineitem", "events")


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return ("D", format(v.normalize(), "f"))
    if isinstance(v, float):
        return ("F", round(v, 9))
    if isinstance(v, dt.datetime):
        return ("T", v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return ("d", v.isoformat())
    return ("X", v)


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return collections.Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    return c


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "loan_health" in df.columns


QS = queries()
SQL = oracle_sql()
CHECKED = sorted(k for k in QS if k in SQL)


def test_every_query_is_registered_with_sql():
    assert set(SQL) == set(QS)


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_oracle(spark, con, name):
    df = QS[name](spark, SMOKE)
    srows = [tuple(r) for r in df.collect()]
    rel = con.sql(SQL[name])
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(srows) == len(drows)
    assert _bag(df.columns, srows) == _bag(rel.columns, drows)
