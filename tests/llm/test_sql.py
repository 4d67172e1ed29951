"""Queries that SQL can say in full, against it on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import pytest

from callmill.llm import catalog

DATA = Path("/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_same_result(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    df = catalog.queries()[name](spark, str(DATA))
    columns = sorted(df.columns)
    said = con.execute(catalog.oracle_sql()[name])
    at = [x[0] for x in said.description]
    assert sorted(at) == columns
    found = sorted(tuple(r[c] for c in columns) for r in df.collect())
    assert found == sorted(tuple(r[at.index(c)] for c in columns) for r in said.fetchall()) and found
