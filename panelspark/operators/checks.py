"""Declarative data checks: one aggregate over the whole table, one result row per check."""

from __future__ import annotations

import json
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.config import Contract


WIDENED = (T.ByteType, T.ShortType, T.IntegerType, T.FloatType)


class CheckSummary(NamedTuple):
    schema_check: bool
    missingness_in_response: bool
    numerical_ranges: bool
    categorical_options: bool


def wrong_types(df: DataFrame, expected: dict[str, str]) -> list[tuple[str, str, str | None]]:
    """(column, expected type, found type) per mismatch. Looks at the schema only.

    A missing column is a mismatch; further columns and their order are not looked at.
    """
    found = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return [(c, t, found.get(c)) for c, t in expected.items() if found.get(c) != t]


def type_check(df: DataFrame, expected: dict[str, str]) -> DataFrame:
    """(column_name, expected, found, passed), one row per expected column."""
    wrong = {c: found for c, _, found in wrong_types(df, expected)}
    rows = [(c, t, wrong.get(c, t), c not in wrong) for c, t in expected.items()]
    return df.sparkSession.createDataFrame(rows, "column_name string, expected string, found string, passed boolean")


def out_of_range(value: Column, low, high) -> Column:
    return ~value.between(F.lit(low), F.lit(high))


def not_allowed(value: Column, allowed: tuple) -> Column:
    """True for a value outside the set. NULL is never counted, listed or not."""
    listed = [v for v in allowed if v is not None]
    return value.isNotNull() & ~value.isin(*listed)


def _row_checks(contract: Contract) -> list[tuple[str, str, Column]]:
    checks = [("not_null", c, F.col(c).isNull()) for c in contract.not_null]
    checks += [("range", c, out_of_range(F.col(c), *bounds)) for c, bounds in contract.ranges.items()]
    checks += [("allowed", c, not_allowed(F.col(c), values)) for c, values in contract.allowed.items()]
    return checks


def run_row_checks(df: DataFrame, contract: Contract, by: tuple[str, ...] = ()) -> DataFrame:
    """(by…, check, column_name, n_rows, n_bad, passed): all row checks in a single scan."""
    checks = _row_checks(contract)
    counted = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(bad).alias(f"_bad{i}") for i, (_, _, bad) in enumerate(checks)],
    )
    rows = F.array(*[
        F.struct(F.lit(kind).alias("check"), F.lit(c).alias("column_name"), F.col(f"_bad{i}").alias("n_bad"))
        for i, (kind, c, _) in enumerate(checks)
    ])
    tidy = counted.select(*by, "n_rows", F.inline(rows))
    return tidy.select(*by, "check", "column_name", "n_rows", "n_bad", (F.col("n_bad") == 0).alias("passed"))


def duplicate_keys(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """(n_keys, n_duplicated): keys in all, and keys held by more than one row."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.count(F.lit(1)).alias("n_keys"), F.count_if(F.col("n") > 1).alias("n_duplicated"))


def validate(df: DataFrame, contract: Contract) -> CheckSummary:
    """Run all checks of a contract and tell which groups of them passed.

    With wrong types the row checks of missing columns cannot run; they count as failed.
    """
    schema_ok = not wrong_types(df, contract.types)
    present = set(df.columns)
    known = Contract(
        not_null=tuple(c for c in contract.not_null if c in present),
        ranges={c: v for c, v in contract.ranges.items() if c in present},
        allowed={c: v for c, v in contract.allowed.items() if c in present},
    )
    failed = {
        "not_null": len(known.not_null) < len(contract.not_null),
        "range": len(known.ranges) < len(contract.ranges),
        "allowed": len(known.allowed) < len(contract.allowed),
    }
    if _row_checks(known):
        for row in run_row_checks(df, known).collect():
            failed[row["check"]] |= not row["passed"]
    if contract.unique_key:
        schema_ok &= duplicate_keys(df, contract.unique_key).first()["n_duplicated"] == 0
    return CheckSummary(schema_ok, not failed["not_null"], not failed["range"], not failed["allowed"])


def schema_signature(df: DataFrame, cols: list[str]) -> str:
    """The schema a model was trained on, as text to store beside it."""
    return df.select(*cols).schema.json()


def enforce_signature(df: DataFrame, signature: str) -> DataFrame:
    """The signature's columns in its order and types. Missing columns are an error.

    A type of which every value is a DOUBLE may widen to it (integers up to INT, FLOAT); any other change of
    type is an error, as BIGINT and DECIMAL could lose digits.
    """
    wanted = T.StructType.fromJson(json.loads(signature))
    found = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in wanted if f.name not in found]
    if missing:
        raise ValueError(f"columns {missing} are missing")
    picked = []
    for f in wanted:
        if found[f.name] != f.dataType:
            if not (isinstance(found[f.name], WIDENED) and isinstance(f.dataType, T.DoubleType)):
                raise ValueError(f"column {f.name} is {found[f.name]}, the model was trained on {f.dataType}")
        picked.append(F.col(f.name).cast(f.dataType).alias(f.name))
    others = [F.col(c) for c in df.columns if c not in {f.name for f in wanted}]
    return df.select(*others, *picked)
