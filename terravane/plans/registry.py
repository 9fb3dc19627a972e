"""Where queries and their SQL are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def register(sql: str | None = None):
    """Registers a function under its name, with the SQL that gives the same rows."""

    def of(f: Callable[[SparkSession, str], DataFrame]):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return of


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from . import shape_queries  # noqa: F401  registers its own

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(_SQL)


def rounded(c: Column, digits: int = 6) -> Column:
    return F.round(c, digits) + F.lit(0.0)
