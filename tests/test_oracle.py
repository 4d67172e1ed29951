"""Every core query against its SQL on the smallest tables, and the driver's contract."""

from __future__ import annotations

import importlib
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from callmill.plans import catalog

DATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for p in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def plain(v):
    return repr(round(v, 6)) if isinstance(v, float) else repr(v)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_same_result(spark, duck, name):
    df = catalog.queries()[name](spark, str(DATA))
    columns = sorted(df.columns)
    found = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    said = duck.execute(catalog.oracle_sql()[name])
    at = [x[0] for x in said.description]
    assert sorted(at) == columns
    assert found == sorted(tuple(plain(r[at.index(c)]) for c in columns) for r in said.fetchall())


def test_contract(spark):
    importlib.reload(entry)
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(catalog.queries()) <= set(entry.queries())
