"""The core's queries by name, and their SQL."""

from __future__ import annotations

from callmill.plans import oracle
from callmill.plans import queries as q

FLAGSHIP = "assembled_rows"


def queries() -> dict:
    return dict(q.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(oracle.SQL)
