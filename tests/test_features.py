import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelspark.functions import features as rules
from panelspark.operators import levels, member_features as mf

D = dt.date


def values(df, col):
    return [r[col] for r in df.collect()]


def test_age(spark):
    rows = [(None, "JUV", D(2001, 1, 1)), (None, "ADT", D(1945, 12, 31)), (-5, "ADT", D(1946, 1, 1)), (150, "JUV", None),
            (30, None, D(2011, 1, 1)), (None, None, D(1990, 5, 5))]
    found = mf.add_age_features(spark.createDataFrame(rows, "custage int, embrtyp string, birthdte date"))
    assert values(found, "custage") == [10, 40, -5, 150, 30, 40]
    assert values(found, "age_cust") == [10, 40, 0, 99, 30, 40]
    assert values(found, "age_segment") == ["A GenZ", "F Seniors", "E LeadBoomers", "UNKNOWN", "UNKNOWN", "B Millennial"]


def test_retirement_age(spark):
    """Both sides of each step, and far out."""
    steps = {1942: 65.0, 1943: 66.0, 1954: 66.0, 1955: 66.1667, 1956: 66.3333, 1957: 66.5, 1958: 66.6667, 1959: 66.8333, 1960: 67.0}
    wanted = {1880: 65.0, **steps, 2024: 67.0}
    days = [D(y, month, day) for y in wanted for month, day in ((1, 1), (12, 31))]
    found = mf.add_retirement_age(spark.createDataFrame([(d,) for d in [*days, None]], "birthdte date"))
    assert {r.birthdte: r.socsec_full_retire_age for r in found.collect()} == {**{d: wanted[d.year] for d in days}, None: None}


SHARES = "totprem int, tradprem int, ulprem int, vulprem int, totsa int, tradsa int, ulsa int, vulsa int"


def test_shares(spark):
    rows = [
        (10, 1, 2, 2, 40, 10, 5, 5),        # the universal amounts are not added
        (0, 1, 1, 1, 0, 1, 1, 1),           # no total
        (None, 1, 1, 1, None, 1, 1, 1),     # unknown total
        (10, None, 2, 2, 40, None, 5, None),
        (2, 5, 5, 5, 10, 100, None, None),  # capped
    ]
    df = spark.createDataFrame(rows, SHARES)
    found = mf.add_share_features(df)
    assert values(found, "pct_cvlprem_totprem") == [0.5, 0.0, 0.0, 1.0, 1.0]
    assert values(found, "pct_cvlsa_totsa") == [0.25, 0.0, 0.0, 0.125, 1.0]
    summed = mf.add_share_features(df, face_mode="sum", null_policy="keep")
    assert values(summed, "pct_cvlprem_totprem") == [0.5, 0.0, 0.0, None, 1.0]
    assert values(summed, "pct_cvlsa_totsa") == [0.5, 0.0, 0.0, 0.125, 1.0]
    with pytest.raises(ValueError):
        mf.add_share_features(df, face_mode="other")


def test_household(spark):
    df = spark.createDataFrame([(5.0, 1), (0.0, 0), (None, None), (2e6, -1)], "hhaua double, hhwrapown int")
    found = mf.add_household_features(df)
    assert values(found, "hh_aua") == [1, 0, None, 1]
    assert values(found, "hhaua") == [5.0, 0.0, 1e6, 1e6]
    assert values(found, "hh_own_wrap") == [1, 0, 0, 0]
    assert values(mf.add_household_features(df, null_policy="keep"), "hhaua") == [5.0, 0.0, None, 1e6]


def test_tenure(spark):
    df = spark.createDataFrame([(None, 100), (None, -100), (200, 13), (None, None)], "yearsmember int, yrspurch int")
    assert values(mf.impute_tenure(df, 20, 99), "yearsmember") == [99, 20, 99, 20]


def test_assets_per_year(spark):
    df = spark.createDataFrame([(None, 13.0), (1.0, 13.0), (0.25, 13.0), (2.0, None)], "yearsmember double, propassets double")
    assert values(mf.add_assets_per_tenure_year(df), "tot_aum_per_yrmbr") == [0.0, 13.0, 26.0, None]


def test_exact_tenure(spark):
    rows = [(10, 1, 100.0, D(2024, 1, 1), D(2020, 1, 1)), (None, None, 100.0, D(2024, 1, 1), None), (3, 1, 9.0, D(2020, 1, 1), D(2024, 1, 1))]
    df = spark.createDataFrame(rows, "yearsmember int, yrspurch int, propassets double, eff_beg_dt date, mbrdt date")
    found = mf.add_tenure_features(df)
    assert values(found, "mbr_yrs") == [1461 / 365.25, 25.0, 0.0]
    assert values(found, "yearsmember") == [10, 25, 3]
    assert values(found, "tot_aum_per_yrmbr") == [10.0, 4.0, 3.0]


def test_unknown_levels(spark):
    df = spark.createDataFrame([("AGE UNKNOWN", "UNKNOWN"), ("X", "A GenZ"), (None, None)], "segment string, age_segment string")
    assert [tuple(r) for r in mf.drop_unknown_levels(df).collect()] == [(None, None), ("X", "A GenZ"), (None, None)]


def test_clean_levels(spark):
    df = spark.createDataFrame([("  A--b c! ",), ("\tx y\n",), ("",), (None,), ("é1_",)], "c string")
    assert values(df.select(rules.clean_level(df.c).alias("c")), "c") == ["a_b_c_", "x_y", "", None, "_1_"]


LEVELS = ["A"] * 2 + ["B"] * 3 + ["C"] + ["D"] * 4


def test_rare_levels(spark):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(LEVELS)], "id int, c string")
    found = levels.combine_rare_levels(df, ["c"], 20.0)
    assert values(found.orderBy("id"), "c") == ["Others" if c == "C" else c for c in LEVELS]


def test_rare_levels_count_rows_without_level(spark):
    rows = [("A", "x")] * 19 + [(None, "y")] * 81
    df = spark.createDataFrame(rows, "c string, d string")
    found = levels.combine_rare_levels(df, ["c", "d"], 20.0)
    assert {tuple(r) for r in found.collect()} == {("Others", "Others"), (None, "y")}


def test_rare_levels_as_table_and_frozen(spark):
    df = spark.createDataFrame([(c,) for c in LEVELS + [None]], "c string")
    as_table = levels.lump_levels(df, levels.frequent_levels(df, ["c"], 15.0), ["c"])
    as_literals = levels.lump_levels(df, levels.fit_levels(df, ["c"], 15.0), ["c"])
    assert sorted(values(as_table, "c"), key=str) == sorted(values(as_literals, "c"), key=str)
    new = spark.createDataFrame([("A",), ("Z",), (None,)], "c string")
    assert values(levels.combine_rare_levels(new, ["c"], 15.0, fit_on=df), "c") == ["A", "Others", None]
    assert isinstance(levels.fit_levels(df, ["c"], 0.01), type(df))


def test_frequent_levels_are_salted(spark, monkeypatch):
    """One level and the missing ones hold a third of the rows each; repeated rows keep their number."""
    monkeypatch.setattr(levels, "HOT_ROWS", 10)
    df = spark.range(900).selectExpr("CASE id % 3 WHEN 0 THEN 7 WHEN 1 THEN CAST(sqrt(id % 150) AS INT) + 100 END AS c", "id % 5 AS other")
    kept = levels.frequent_levels(df, ["c"], 1.0)
    text = df.withColumn("c", F.col("c").cast("string"))
    counts = df.groupBy("c").count().collect()
    frequent = {str(r["c"]) for r in counts if r["c"] is not None and 100.0 * r["count"] / 900 >= 1.0}
    found = levels.lump_levels(text, kept, ["c"])
    want = [(c if c is None or c in frequent else "Others", o) for c, o in text.collect()]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str) and 1 < len(frequent) < len(counts) - 1
