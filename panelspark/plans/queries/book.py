"""The list of registered queries, and small helpers they share."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.plans import standins

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
EXPECTED_SQL: dict[str, str] = {}

DIGITS = 6


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query. Without SQL only tests check its result."""

    def register(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = build
        if sql is not None:
            EXPECTED_SQL[name] = sql
        return build

    return register


def rounded(df: DataFrame, *cols: str, digits: int = DIGITS) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


def source_sql(sql: str) -> str:
    """A stand-in definition over the plain table names."""
    return sql.format(**{t: t for t in standins.TABLES})


def ctes(**parts: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in parts.items())


def date_list(dates: Sequence[str]) -> str:
    return ", ".join(f"(DATE '{d}')" for d in dates)
