"""All queries of the risk-analytics operators with their SQL."""

from __future__ import annotations

from . import decisions, history, lakehouse, learning, monitor, streams  # noqa: F401
from .registry import QUERIES, SQL


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
