"""Queries over the driver's tables, and the SQL that gives the same rows."""

from __future__ import annotations

from tickframe.plans import conformance, delivery, ledger, repairs  # noqa: F401  (they register their queries)
from tickframe.plans.timeseries import QUERIES, SQL


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
