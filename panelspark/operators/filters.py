"""Row filters. Each one is a plain predicate on a bare column, so it reaches the file scan."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def on_or_after(df: DataFrame, date_col: str, min_date: str | dt.date) -> DataFrame:
    """Rows dated ``min_date`` or later. The column has to be a DATE."""
    if not isinstance(df.schema[date_col].dataType, T.DateType):
        raise TypeError(f"column {date_col} must be a DATE, not {df.schema[date_col].dataType}")
    if isinstance(min_date, str):
        min_date = dt.date.fromisoformat(min_date)
    return df.filter(F.col(date_col) >= F.lit(min_date))


def labelled(df: DataFrame, outcome_col: str) -> DataFrame:
    return df.filter(F.col(outcome_col).isNotNull())


def role(df: DataFrame, name: str, role_col: str = "set_type") -> DataFrame:
    return df.filter(F.col(role_col) == name)


def without_extreme_rows(df: DataFrame, values_col: str, threshold: float) -> DataFrame:
    """Rows whose array holds no value of magnitude ``threshold`` or more."""
    return df.filter(F.forall(F.col(values_col), lambda x: F.abs(x) < F.lit(threshold)))
