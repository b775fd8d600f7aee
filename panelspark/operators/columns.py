"""Column names, recodes, casts and projections."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.config import ModelConfig

MAX_LITERAL_MAP = 200


def sql_name(name: str) -> str:
    """A name of ASCII letters, digits and ``_``; case is kept."""
    return re.sub("[^A-Za-z0-9_]+", "_", name).strip()


def snake_name(name: str) -> str:
    """A lower-case name with runs of non-word characters as one ``_``."""
    return re.sub(r"\W+", "_", name.lower())


NAME_RULES = {"snake": snake_name, "sql": sql_name}


def normalise_names(df: DataFrame, rule: str = "snake") -> DataFrame:
    """Rename every column by one rule. Two columns ending up with one name is an error."""
    new_names = [NAME_RULES[rule](c) for c in df.columns]
    clashes = [n for n, count in Counter(n.lower() for n in new_names).items() if count > 1]
    if clashes:
        raise ValueError(f"several columns would be named {sorted(clashes)}")
    return df.toDF(*new_names)


def recode(df: DataFrame, col: str, mapping: Mapping, new_col: str | None = None) -> DataFrame:
    """Replace values by ``mapping``; what it does not list becomes NULL.

    Short mappings are a literal in the plan, longer ones a joined table of the same types.
    """
    target = new_col or col
    if not mapping:
        return df.withColumn(target, F.lit(None).cast("string"))
    if len(mapping) <= MAX_LITERAL_MAP:
        pairs = [F.lit(x) for pair in mapping.items() for x in pair]
        return df.withColumn(target, F.create_map(*pairs)[F.col(col)])
    table = _mapping_table(df, mapping)
    return recode_by_table(df, col, table, "_from", "_to", target)


def _mapping_table(df: DataFrame, mapping: Mapping) -> DataFrame:
    """(_from, _to) with the types that a literal of the mapping has: one value of each Python type decides, and of
    decimals one of each length and scale."""

    def kind(x) -> tuple:
        return (type(x), len(x.as_tuple().digits), x.as_tuple().exponent) if isinstance(x, Decimal) else (type(x),)

    some = [list({kind(x): x for x in side if x is not None}.values()) for side in (mapping.keys(), mapping.values())]
    one = df.sparkSession.range(1).select(*(F.array(*map(F.lit, x)).alias(c) for c, x in zip(("_from", "_to"), some)))
    kinds = [f.dataType.elementType for f in one.schema.fields]
    plain = [float if isinstance(k, (T.DoubleType, T.FloatType)) else lambda x: x for k in kinds]
    rows = [tuple(None if x is None else f(x) for f, x in zip(plain, pair)) for pair in mapping.items()]
    return df.sparkSession.createDataFrame(rows, T.StructType([T.StructField(c, k) for c, k in zip(("_from", "_to"), kinds)]))


def recode_by_table(df: DataFrame, col: str, table: DataFrame, from_col: str, to_col: str,
                    new_col: str | None = None) -> DataFrame:
    """The same recode with the mapping in a table of one row per value. Spark picks the join."""
    lookup = table.select(F.col(from_col).alias("_recode_from"), F.col(to_col).alias("_recode_to"))
    target = new_col or col
    columns = [c for c in df.columns if c != target]
    joined = df.join(lookup, F.col(col) == F.col("_recode_from"), "left")
    order = df.columns if target in df.columns else [*df.columns, target]
    picked = joined.select(*columns, F.col("_recode_to").alias(target))
    return picked.select(*order)


def normalise_id(df: DataFrame, source: str, target: str) -> DataFrame:
    """The id as trimmed text, under the one name all tables join on."""
    return df.withColumn(target, F.trim(F.col(source).cast("string")))


def to_date(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("date") for c in cols})


def _cast_all(df: DataFrame, kind: type, keep: Sequence[str]) -> DataFrame:
    kept = {c.lower() for c in keep}
    casts = {
        f.name: F.col(f"`{f.name}`").cast("double")
        for f in df.schema.fields
        if isinstance(f.dataType, kind) and f.name.lower() not in kept
    }
    return df.withColumns(casts) if casts else df


def decimals_to_double(df: DataFrame, keep: Sequence[str] = (ModelConfig.outcome_col,)) -> DataFrame:
    """Every DECIMAL column as DOUBLE, but for the ones to keep (the outcome)."""
    return _cast_all(df, T.DecimalType, keep)


def integers_to_double(df: DataFrame, keep: Sequence[str] = (ModelConfig.outcome_col,)) -> DataFrame:
    """Every INT column as DOUBLE, so that later NULLs do not change the schema. BIGINT stays."""
    return _cast_all(df, T.IntegerType, keep)


def split_by_kind(df: DataFrame, exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """(numeric columns, text columns) in table order."""
    left_out = set(exclude)
    fields = [f for f in df.schema.fields if f.name not in left_out]
    numeric = [f.name for f in fields if isinstance(f.dataType, T.NumericType)]
    text = [f.name for f in fields if isinstance(f.dataType, T.StringType)]
    return numeric, text


def gold_projection(df: DataFrame, serving: bool = False, model: ModelConfig = ModelConfig()) -> DataFrame:
    """Id, features, outcome, wave and role; a serving panel has neither outcome nor role."""
    outcome = [] if serving else [model.outcome_col]
    role = [] if serving else [model.role_col]
    columns = [model.id_col, *model.features, *outcome, model.wave_col, *role]
    return df.select(*[F.col(c).alias(c.lower()) for c in columns])
