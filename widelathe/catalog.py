"""All queries of the library and SQL for the same results."""

from __future__ import annotations

from .plans import queries_io, queries_landing, queries_scalar, queries_wide  # noqa: F401  each lists its queries
from .plans.registry import QUERIES, SQL


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
