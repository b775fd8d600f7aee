"""Scalar feature rules as column expressions. None of them leaves whole-stage codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper birth year (inclusive) and generation label.
GENERATIONS = (
    (1945, "F Seniors"),
    (1955, "E LeadBoomers"),
    (1964, "D TailBoomers"),
    (1974, "C GenX"),
    (1990, "B Millennial"),
    (2010, "A GenZ"),
)

# Upper birth year (inclusive) and statutory full retirement age.
RETIREMENT_AGES = (
    (1942, 65.0),
    (1954, 66.0),
    (1955, 66.1667),
    (1956, 66.3333),
    (1957, 66.5),
    (1958, 66.6667),
    (1959, 66.8333),
)
RETIREMENT_AGE_LATER = 67.0

DAYS_PER_YEAR = 365.25


def band(value: Column, bounds: Sequence[tuple], otherwise, when_null=None) -> Column:
    """Label of the first band whose inclusive upper bound is not below ``value``."""
    expr = F.when(value.isNull(), F.lit(when_null))
    for upper, label in bounds:
        expr = expr.when(value <= F.lit(upper), F.lit(label))
    return expr.otherwise(F.lit(otherwise))


def generation(birth_date: Column) -> Column:
    return band(F.year(birth_date), GENERATIONS, otherwise="UNKNOWN", when_null="UNKNOWN")


def retirement_age(birth_date: Column) -> Column:
    return band(F.year(birth_date), RETIREMENT_AGES, otherwise=RETIREMENT_AGE_LATER)


def imputed_age(age: Column, member_type: Column, adult_age: int, juvenile_age: int) -> Column:
    return F.coalesce(age, F.when(member_type == "JUV", juvenile_age).otherwise(adult_age))


def clamped(value: Column, low, high) -> Column:
    """``value`` moved into [low, high]. A NULL value becomes ``high``, as NULLs are skipped."""
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def capped(value: Column, high, null_policy: str = "cap") -> Column:
    """``min(value, high)``. With ``null_policy='cap'`` NULL becomes ``high``; ``'keep'`` keeps it."""
    limit = F.least(F.lit(high), value)
    if null_policy == "cap":
        return limit
    if null_policy == "keep":
        return F.when(value.isNotNull(), limit)
    raise ValueError(f"null_policy must be 'cap' or 'keep', not {null_policy!r}")


def capped_share(part: Column, total: Column, null_policy: str = "cap") -> Column:
    """0 where the total is missing or below 1, else ``min(1, part / total)``."""
    share = capped(part.cast("double") / total.cast("double"), 1.0, null_policy)
    return F.when(F.coalesce(total, F.lit(0)) < 1, F.lit(0.0)).otherwise(share)


def face_amount(trad: Column, ul: Column, vul: Column, mode: str = "reference") -> Column:
    """The cash-value part of a face amount.

    ``reference`` uses the traditional amount alone whenever it is present and the two universal
    amounts only otherwise; ``sum`` adds all three.
    """
    universal = F.coalesce(ul, F.lit(0)) + F.coalesce(vul, F.lit(0))
    if mode == "reference":
        return F.coalesce(trad, universal)
    if mode == "sum":
        return F.coalesce(trad, F.lit(0)) + universal
    raise ValueError(f"mode must be 'reference' or 'sum', not {mode!r}")


def positive_flag(value: Column, null_is_zero: bool = False) -> Column:
    """1 where the value is above zero, else 0. NULL stays NULL unless ``null_is_zero``."""
    known = F.coalesce(value, F.lit(0)) if null_is_zero else value
    return (known > 0).cast("int")


def imputed_tenure(years: Column, years_since_purchase: Column, default: int, max_years: int) -> Column:
    fallback = F.when(years_since_purchase > 0, years_since_purchase).otherwise(F.lit(default))
    return F.least(F.lit(max_years), F.coalesce(years, fallback))


def exact_tenure(as_of: Column, member_since: Column, fallback: Column) -> Column:
    """Years of membership with decimals where the joining date is known, else ``fallback``."""
    years = F.greatest(F.lit(0.0), F.datediff(as_of, member_since) / F.lit(DAYS_PER_YEAR))
    return F.when(member_since.isNotNull(), years).otherwise(fallback.cast("double"))


def assets_per_tenure_year(assets: Column, years: Column) -> Column:
    per_year = assets.cast("double") / F.greatest(F.lit(0.5), years.cast("double"))
    return F.when(years.isNull(), F.lit(0.0)).otherwise(per_year)


def clean_level(value: Column) -> Column:
    """Stripped of outer white space, runs outside ``[A-Za-z0-9_]`` made ``_``, lower case."""
    stripped = F.regexp_replace(value, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")
    return F.lower(F.regexp_replace(stripped, "[^A-Za-z0-9_]+", "_"))


def null_if(value: Column, *sentinels: str) -> Column:
    """NULL where the value is one of the sentinels."""
    return F.when(~value.isin(*sentinels), value)
