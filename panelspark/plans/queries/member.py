"""Feature rules over the whole members table."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.functions.features import clean_level
from panelspark.operators import levels, member_features
from panelspark.plans import standins
from panelspark.plans.queries.book import ctes, query, rounded, source_sql
from panelspark.plans.standins import load

MEMBERS = source_sql(standins.MEMBERS_SQL)
KEY = ["cifidnbr", "eff_beg_dt"]
KEY_SQL = "trim(cifidnbr) AS cifidnbr, eff_beg_dt"

# expressions over the members table, shared by the expected results
GENERATION = """CASE WHEN birthdte IS NULL THEN 'UNKNOWN' WHEN year(birthdte) <= 1945 THEN 'F Seniors'
  WHEN year(birthdte) <= 1955 THEN 'E LeadBoomers' WHEN year(birthdte) <= 1964 THEN 'D TailBoomers'
  WHEN year(birthdte) <= 1974 THEN 'C GenX' WHEN year(birthdte) <= 1990 THEN 'B Millennial'
  WHEN year(birthdte) <= 2010 THEN 'A GenZ' ELSE 'UNKNOWN' END"""
AGE = "coalesce(custage, CASE WHEN embrtyp = 'JUV' THEN 10 ELSE 40 END)"
TENURE = "least(99, coalesce(yearsmember, CASE WHEN yrspurch > 0 THEN yrspurch ELSE 25 END))"
FACE_SHARE = """CASE WHEN coalesce(totsa, 0) < 1 THEN 0.0
  ELSE least(1.0, coalesce(tradsa, coalesce(ulsa, 0) + coalesce(vulsa, 0))::DOUBLE / totsa) END"""
ASSETS_PER_YEAR = f"propassets / greatest(0.5, {TENURE})"


def _members(spark, sf):
    return standins.members(spark, sf).withColumn("cifidnbr", F.trim("cifidnbr"))


@query("age_features", ctes(m=MEMBERS) + f"""
SELECT {KEY_SQL}, {AGE} AS custage, greatest(0, least(99, {AGE})) AS age_cust, {GENERATION} AS age_segment FROM m
""")
def age_features(spark, sf):
    return _members(spark, sf).transform(member_features.add_age_features).select(
        *KEY, "custage", "age_cust", "age_segment")


@query("retirement_age", ctes(m=MEMBERS) + f"""
SELECT {KEY_SQL}, CAST(CASE WHEN birthdte IS NULL THEN NULL WHEN year(birthdte) <= 1942 THEN 65.0
  WHEN year(birthdte) <= 1954 THEN 66.0 WHEN year(birthdte) = 1955 THEN 66.1667 WHEN year(birthdte) = 1956 THEN 66.3333
  WHEN year(birthdte) = 1957 THEN 66.5 WHEN year(birthdte) = 1958 THEN 66.6667 WHEN year(birthdte) = 1959 THEN 66.8333
  ELSE 67.0 END AS DOUBLE) AS socsec_full_retire_age FROM m
""")
def retirement_age(spark, sf):
    return _members(spark, sf).transform(member_features.add_retirement_age).select(*KEY, "socsec_full_retire_age")


PREMIUM_SHARE = """CASE WHEN coalesce(totprem, 0) < 1 THEN 0.0
  ELSE least(1.0, (tradprem + ulprem + vulprem)::DOUBLE / totprem) END"""


@query("share_features", ctes(m=MEMBERS) + f"""
SELECT {KEY_SQL}, round({PREMIUM_SHARE}, 6) AS pct_cvlprem_totprem, round({FACE_SHARE}, 6) AS pct_cvlsa_totsa FROM m
""")
def share_features(spark, sf):
    df = _members(spark, sf).transform(member_features.add_share_features)
    return rounded(df.select(*KEY, "pct_cvlprem_totprem", "pct_cvlsa_totsa"), "pct_cvlprem_totprem", "pct_cvlsa_totsa")


@query("share_features_summed", ctes(m=MEMBERS) + f"""
SELECT {KEY_SQL},
  round(CASE WHEN coalesce(totprem, 0) < 1 THEN 0.0 WHEN tradprem IS NULL THEN NULL
    ELSE least(1.0, (tradprem + ulprem + vulprem)::DOUBLE / totprem) END, 6) AS pct_cvlprem_totprem,
  round(CASE WHEN coalesce(totsa, 0) < 1 THEN 0.0
    ELSE least(1.0, (coalesce(tradsa, 0) + coalesce(ulsa, 0) + coalesce(vulsa, 0))::DOUBLE / totsa) END, 6) AS pct_cvlsa_totsa
FROM m
""")
def share_features_summed(spark, sf):
    df = _members(spark, sf).transform(member_features.add_share_features, "sum", "keep")
    return rounded(df.select(*KEY, "pct_cvlprem_totprem", "pct_cvlsa_totsa"), "pct_cvlprem_totprem", "pct_cvlsa_totsa")


@query("household_features", ctes(m=MEMBERS) + f"""
SELECT {KEY_SQL}, CAST(hhaua > 0 AS INT) AS hh_aua, round(least(1000000, hhaua), 6) AS hhaua,
       CAST(coalesce(hhwrapown, 0) > 0 AS INT) AS hh_own_wrap FROM m
""")
def household_features(spark, sf):
    df = _members(spark, sf).transform(member_features.add_household_features)
    return rounded(df.select(*KEY, "hh_aua", "hhaua", "hh_own_wrap"), "hhaua")


@query("tenure_imputed", ctes(m=MEMBERS) + f" SELECT {KEY_SQL}, {TENURE} AS yearsmember FROM m")
def tenure_imputed(spark, sf):
    return _members(spark, sf).transform(member_features.impute_tenure).select(*KEY, "yearsmember")


@query("assets_per_tenure_year", ctes(m=MEMBERS) + f"""
SELECT {KEY_SQL}, round(CASE WHEN yearsmember IS NULL THEN 0.0
  ELSE propassets / greatest(0.5, yearsmember) END, 6) AS tot_aum_per_yrmbr FROM m
""")
def assets_per_tenure_year(spark, sf):
    df = _members(spark, sf).transform(member_features.add_assets_per_tenure_year)
    return rounded(df.select(*KEY, "tot_aum_per_yrmbr"), "tot_aum_per_yrmbr")


@query("tenure_features", ctes(m=MEMBERS) + f"""
SELECT {KEY_SQL}, {TENURE} AS yearsmember,
  round(CASE WHEN mbrdt IS NOT NULL THEN greatest(0.0, datediff('day', mbrdt, eff_beg_dt) / 365.25::DOUBLE)
        ELSE {TENURE} END, 6) AS mbr_yrs,
  round({ASSETS_PER_YEAR}, 6) AS tot_aum_per_yrmbr FROM m
""")
def tenure_features(spark, sf):
    df = _members(spark, sf).transform(member_features.add_tenure_features)
    return rounded(df.select(*KEY, "yearsmember", "mbr_yrs", "tot_aum_per_yrmbr"), "mbr_yrs", "tot_aum_per_yrmbr")


LUMPED = """CASE WHEN {c} IS NULL THEN NULL
  WHEN 100.0 * count(*) OVER (PARTITION BY {c}) / count(*) OVER () < {pct} THEN 'Others' ELSE {c} END"""


@query("rare_levels", f"""
SELECT p_partkey, {LUMPED.format(c='p_type', pct=20.5)} AS p_type, {LUMPED.format(c='p_brand', pct=4)} AS p_brand
FROM part
""")
def rare_levels(spark, sf):
    df = load(spark, sf, "part").select("p_partkey", "p_type", "p_brand")
    df = levels.combine_rare_levels(df, ["p_type"], 20.5)
    return levels.combine_rare_levels(df, ["p_brand"], 4)


@query("rare_levels_many", f"""
SELECT event_id, {LUMPED.format(c='u', pct=0.05)} AS u FROM (SELECT event_id, CAST(user_id AS VARCHAR) AS u FROM events)
""")
def rare_levels_many(spark, sf):
    df = load(spark, sf, "events").select("event_id", F.col("user_id").cast("string").alias("u"))
    return levels.combine_rare_levels(df, ["u"], 0.05)


@query("rare_levels_frozen", """
WITH e AS (SELECT event_id, event_type, CASE WHEN value > 20 THEN 'train' ELSE 'serving' END AS part FROM events),
k AS (SELECT event_type FROM e WHERE part = 'train' GROUP BY event_type
      HAVING 100.0 * count(*) / (SELECT count(*) FROM e WHERE part = 'train') >= 20)
SELECT event_id, CASE WHEN event_type IN (SELECT event_type FROM k) THEN event_type ELSE 'Others' END AS event_type, part
FROM e
""")
def rare_levels_frozen(spark, sf):
    df = load(spark, sf, "events").select(
        "event_id", "event_type", F.when(F.col("value") > 20, "train").otherwise("serving").alias("part"))
    return levels.combine_rare_levels(df, ["event_type"], 20, fit_on=df.filter("part = 'train'"))


@query("clean_level_values", r"""
SELECT p_partkey, lower(regexp_replace(regexp_replace(v, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g'), '[^A-Za-z0-9_]+', '_', 'g')) AS v
FROM (SELECT p_partkey, concat('  ', p_brand, ' / ', p_name, '! ') AS v FROM part)
""")
def clean_level_values(spark, sf):
    text = F.concat(F.lit("  "), "p_brand", F.lit(" / "), "p_name", F.lit("! "))
    return load(spark, sf, "part").select("p_partkey", clean_level(text).alias("v"))
