import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from panelspark.operators import columns, filters


@pytest.mark.parametrize("given, wanted", [
    (["plain", "two words"], ["plain", "two_words"]),
    (["a.b-c", "x\t\ty"], ["a_b_c", "x_y"]),
    (["ALL CAPS", "Älter-Wert"], ["all_caps", "älter_wert"]),
    (["$start", "end%"], ["_start", "end_"]),
])
def test_snake_names(spark, given, wanted):
    schema = T.StructType([T.StructField(c, T.StringType()) for c in given])
    assert columns.normalise_names(spark.createDataFrame([], schema)).columns == wanted


def test_sql_names_keep_case(spark):
    df = spark.createDataFrame([], "`A-b` string, `c d` string")
    assert columns.normalise_names(df, "sql").columns == ["A_b", "c_d"]


def test_name_clash_is_an_error(spark):
    with pytest.raises(ValueError, match="a_b"):
        columns.normalise_names(spark.createDataFrame([], "`a b` string, `a-b` string"))


SIZES = {"S": "small", "M": "medium", "XL": "large"}


@pytest.mark.parametrize("new_col", [None, "size", "garment"])
@pytest.mark.parametrize("listed", [["S", "M", "XL"], ["M"], ["none of these"], []])
def test_recode(spark, listed, new_col):
    given = ["XL", "S", None, "M", "unlisted", "S"]
    df = spark.createDataFrame([(i, g) for i, g in enumerate(given)], "id int, size string")
    mapping = {g: SIZES.get(g, "other") for g in listed}
    found = {r["id"]: r[new_col or "size"] for r in columns.recode(df, "size", mapping, new_col).collect()}
    assert found == {i: mapping.get(g) for i, g in enumerate(given)}


def numbered(kind, i):
    return {
        "text": str(i), "int": i, "double": i / 4, "date": dt.date(2000, 1, 1) + dt.timedelta(i), "decimal": Decimal(i) / 100,
        "mixed": i / 4 if i % 2 else i, "none": None if i % 3 == 0 else i,
    }[kind]


@pytest.mark.parametrize("kind", ["text", "int", "double", "date", "decimal", "mixed", "none"])
def test_short_and_long_recodes_are_alike(spark, kind):
    df = spark.range(500).selectExpr("cast(id as string) as c")
    mapping = {str(i): numbered(kind, i) for i in range(columns.MAX_LITERAL_MAP + 1)}
    short = dict(list(mapping.items())[: columns.MAX_LITERAL_MAP])
    tables = [columns.recode(df, "c", m, "d") for m in (short, mapping)]
    assert tables[0].schema["d"].dataType == tables[1].schema["d"].dataType
    found = [{r["c"]: r["d"] for r in t.collect()} for t in tables]
    assert all(found[0][c] == found[1][c] == v for c, v in short.items())
    last = str(columns.MAX_LITERAL_MAP)
    assert found[0][last] is None and found[1][last] == mapping[last] and len(found[1]) == 500


def test_recode_of_numbers(spark):
    df = spark.range(400).selectExpr("cast(id as int) as c")
    found = columns.recode(df, "c", {i: i * 2 for i in range(300)})
    assert found.schema["c"].dataType == T.IntegerType()
    assert sorted(r["c"] for r in found.collect() if r["c"] is not None) == [i * 2 for i in range(300)]


def test_normalise_id(spark):
    df = spark.createDataFrame([(" 7 ",), (None,)], "customer string")
    assert [r.id for r in columns.normalise_id(df, "customer", "id").collect()] == ["7", None]
    assert columns.normalise_id(spark.range(1), "id", "key").schema["key"].dataType == T.StringType()


def test_casts_keep_the_outcome(spark):
    rows = [(Decimal("1.0"), Decimal("1.1"), 3, 4, 5), (Decimal("2.0"), None, None, 5, 6)]
    df = spark.createDataFrame(rows, "a decimal(10,1), b decimal(10,2), i int, big bigint, long_term_care_responder int")
    found = columns.integers_to_double(columns.decimals_to_double(df))
    kinds = {f.name: f.dataType.simpleString() for f in found.schema}
    assert kinds == {"a": "double", "b": "double", "i": "double", "big": "bigint", "long_term_care_responder": "int"}
    assert [tuple(r) for r in found.collect()] == [(1.0, 1.1, 3.0, 4, 5), (2.0, None, None, 5, 6)]


def test_split_by_kind(spark):
    df = spark.createDataFrame([], "a int, b string, c double, d date, e decimal(3,1)")
    assert columns.split_by_kind(df, exclude=["c"]) == (["a", "e"], ["b"])


def test_gold_projection(spark):
    from panelspark.config import SELECTED_FEATURES, ModelConfig

    model = ModelConfig()
    cols = [model.id_col, "extra", *[f.upper() for f in SELECTED_FEATURES], model.outcome_col, model.wave_col, model.role_col]
    df = spark.createDataFrame([], ", ".join(f"{c} string" for c in cols))
    assert len(columns.gold_projection(df).columns) == 30
    serving = columns.gold_projection(df, serving=True).columns
    assert len(serving) == 28 and model.outcome_col not in serving and "segment" in serving


def test_on_or_after(spark):
    import datetime as dt

    df = spark.createDataFrame([(str(i), dt.date(2023, i, 1)) for i in range(1, 5)], "id string, d date")
    assert [r.id for r in filters.on_or_after(df, "d", "2023-02-01").collect()] == ["2", "3", "4"]
    assert filters.on_or_after(df, "d", dt.date(2023, 1, 1)).count() == 4
    assert filters.on_or_after(df, "d", "2023-05-01").count() == 0
    with pytest.raises(TypeError):
        filters.on_or_after(df.withColumn("d", df.d.cast("string")), "d", "2023-01-01")


def test_date_filter_reaches_the_files(spark, tmp_path):
    import datetime as dt

    path = str(tmp_path / "t")
    spark.createDataFrame([("1", dt.date(2023, 1, 1))], "id string, d date").write.parquet(path)
    plan = filters.on_or_after(spark.read.parquet(path), "d", "2023-02-01")._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(d,2023-02-01)" in plan


def test_without_extreme_rows(spark):
    df = spark.createDataFrame([(1, [0.5, -4.9]), (2, [5.0, 0.0]), (3, [-6.0]), (4, [])], "id int, shap array<double>")
    assert {r.id for r in filters.without_extreme_rows(df, "shap", 5.0).collect()} == {1, 4}
