"""Silver tables, the gold panel, its joins and its checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.config import NUMERIC_FEATURES, SELECTED_FEATURES, gold_contract
from panelspark.operators import checks, filters, joins
from panelspark.plans import feature_build, standins
from panelspark.plans.queries import member
from panelspark.plans.queries.book import ctes, date_list, query, rounded, source_sql
from panelspark.plans.standins import load

KEY = ["cifidnbr", "adjusted_effective_date"]


def _silver_sql(source: str, date: str, id_col: str, waves: list[str], since: str | None) -> dict[str, str]:
    """CTEs for one source: dated rows, its wave map, and the silver table ``s_<source>``."""
    keep = f"WHERE {date} >= DATE '{since}'" if since else ""
    role = "'serving'" if since is None else "CASE WHEN wave >= DATE '1998-01-01' THEN 'test' ELSE 'train' END"
    return {
        f"d_{source}": f"SELECT * REPLACE (CAST({date} AS DATE) AS {date}) FROM r_{source}",
        f"f_{source}": f"SELECT * FROM d_{source} {keep}",
        f"w_{source}": f"""SELECT CAST(w AS DATE) AS wave,
            arg_min({date}, (abs(datediff('day', {date}, w)), {date})) AS snapshot
            FROM (SELECT DISTINCT {date} FROM f_{source}), (VALUES {date_list(waves)}) t(w) GROUP BY w""",
        f"s_{source}": f"""SELECT f.* EXCLUDE ({id_col}), trim({id_col}) AS cifidnbr,
            strftime(wave, '%Y-%m-%d') AS adjusted_effective_date, {role} AS set_type
            FROM f_{source} f JOIN w_{source} ON snapshot = {date}""",
    }


def silver_ctes(serving: bool) -> dict[str, str]:
    waves = standins.SERVING_WAVES if serving else standins.TRAIN_WAVES + standins.TEST_WAVES
    since = None if serving else waves[0]
    parts = {
        "r_members": source_sql(standins.MEMBERS_SQL),
        "r_attributes": source_sql(standins.ATTRIBUTES_SQL),
        "r_labels": source_sql(standins.LABELS_SQL),
    }
    parts |= _silver_sql("members", "eff_beg_dt", "cifidnbr", waves, since)
    parts |= _silver_sql("attributes", "eff_beg_dt", "cifidnbr", waves, since)
    if not serving:
        parts |= _silver_sql("labels", "purchase_period_begin_timestamp", "customer_id_number", waves, since)
    return parts


def gold_ctes(serving: bool) -> dict[str, str]:
    parts = silver_ctes(serving)
    parts["derived"] = f"""SELECT * REPLACE (
          nullif(segment, 'AGE UNKNOWN') AS segment, {member.TENURE} AS yearsmember),
        nullif({member.GENERATION}, 'UNKNOWN') AS age_segment, CAST(hhaua > 0 AS INT) AS hh_aua,
        {member.FACE_SHARE} AS pct_cvlsa_totsa, {member.ASSETS_PER_YEAR} AS tot_aum_per_yrmbr
        FROM s_members"""
    parts["lumped"] = f"""SELECT * REPLACE (
          {member.LUMPED.format(c='segment', pct=3)} AS segment,
          {member.LUMPED.format(c='age_segment', pct=3)} AS age_segment) FROM derived"""
    picked = ", ".join(
        f"round(CAST({c} AS DOUBLE), 6) AS {c}" if c in NUMERIC_FEATURES else c for c in SELECTED_FEATURES
    )
    if serving:
        parts["gold"] = f"""SELECT cifidnbr, {picked}, adjusted_effective_date
            FROM lumped LEFT JOIN (SELECT * EXCLUDE (eff_beg_dt, set_type) FROM s_attributes) USING (cifidnbr, adjusted_effective_date)"""
        return parts
    parts["gold"] = f"""SELECT cifidnbr, {picked}, long_term_care_responder, adjusted_effective_date, set_type
        FROM lumped LEFT JOIN (SELECT * EXCLUDE (eff_beg_dt, set_type) FROM s_attributes) USING (cifidnbr, adjusted_effective_date)
        JOIN (SELECT cifidnbr, adjusted_effective_date, long_term_care_responder FROM s_labels
              WHERE long_term_care_responder IS NOT NULL) USING (cifidnbr, adjusted_effective_date)"""
    return parts


def silver(spark, sf, source: str, serving: bool = False):
    calendar = standins.serving_calendar() if serving else standins.training_calendar()
    if source == "labels":
        return feature_build.build_silver_labels(standins.labels(spark, sf), calendar)
    return feature_build.build_silver(getattr(standins, source)(spark, sf), calendar)


def gold(spark, sf, serving: bool = False):
    labels = None if serving else silver(spark, sf, "labels")
    return feature_build.build_gold(silver(spark, sf, "members", serving), silver(spark, sf, "attributes", serving), labels)


TRAIN, SERVE = ctes(**gold_ctes(False)), ctes(**gold_ctes(True))


@query("silver_members", TRAIN + "SELECT cifidnbr, eff_beg_dt, segment, adjusted_effective_date, set_type FROM s_members")
def silver_members(spark, sf):
    return silver(spark, sf, "members").select("cifidnbr", "eff_beg_dt", "segment", "adjusted_effective_date", "set_type")


@query("silver_members_serving", SERVE + "SELECT cifidnbr, eff_beg_dt, segment, adjusted_effective_date, set_type FROM s_members")
def silver_members_serving(spark, sf):
    return silver(spark, sf, "members", True).select(
        "cifidnbr", "eff_beg_dt", "segment", "adjusted_effective_date", "set_type")


@query("silver_labels", TRAIN + """
SELECT cifidnbr, purchase_period_begin_timestamp, long_term_care_responder, adjusted_effective_date, set_type FROM s_labels
""")
def silver_labels(spark, sf):
    return silver(spark, sf, "labels").select(
        "cifidnbr", "purchase_period_begin_timestamp", "long_term_care_responder", "adjusted_effective_date", "set_type")


@query("split_by_role", TRAIN + "SELECT cifidnbr, adjusted_effective_date, totsa FROM s_members WHERE set_type = 'test'")
def split_by_role(spark, sf):
    return filters.role(silver(spark, sf, "members"), "test").select("cifidnbr", "adjusted_effective_date", "totsa")


@query("join_attributes", TRAIN + """
SELECT cifidnbr, adjusted_effective_date, m.set_type, totsa, w_census_pct_white_collar
FROM s_members m LEFT JOIN s_attributes a USING (cifidnbr, adjusted_effective_date)
""")
def join_attributes(spark, sf):
    joined = joins.keyed_join(silver(spark, sf, "members"), [(silver(spark, sf, "attributes"), "left")], KEY)
    return joined.select(*KEY, "set_type", "totsa", "w_census_pct_white_collar")


@query("join_labels", TRAIN + """
SELECT cifidnbr, adjusted_effective_date, m.set_type, totsa, long_term_care_responder
FROM s_members m LEFT JOIN s_labels l USING (cifidnbr, adjusted_effective_date)
WHERE long_term_care_responder IS NOT NULL
""")
def join_labels(spark, sf):
    labels = filters.labelled(silver(spark, sf, "labels"), "long_term_care_responder")
    joined = joins.keyed_join(silver(spark, sf, "members"), [(labels, "inner")], KEY)
    return joined.select(*KEY, "set_type", "totsa", "long_term_care_responder")


@query("join_hot_keys", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, s_name, n_name FROM (
  SELECT *, CASE WHEN l_discount < 0.04 THEN CAST(1 AS BIGINT) ELSE l_suppkey END AS k FROM lineitem)
LEFT JOIN supplier ON s_suppkey = k LEFT JOIN nation ON n_nationkey = s_nationkey AND s_suppkey <> 1
""")
def join_hot_keys(spark, sf):
    """Well over a third of the line items share one supplier key, which is found and salted."""
    items = load(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.when(F.col("l_discount") < 0.04, F.lit(1).cast("long")).otherwise(F.col("l_suppkey")).alias("k"))
    suppliers = load(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), "s_name", "s_nationkey")
    nations = load(spark, sf, "nation").join(suppliers, F.col("s_nationkey") == F.col("n_nationkey"))
    named = nations.filter("k <> 1").select("k", "n_name")
    hot = joins.find_hot(items, ["k"], min_share=0.05)
    joined = joins.keyed_join(items, [(suppliers.select("k", "s_name"), "left"), (named, "left")], ["k"], hot)
    return joined.drop("k")


@query("hot_keys", """
SELECT k FROM (SELECT CASE WHEN l_discount < 0.04 THEN CAST(1 AS BIGINT) ELSE l_suppkey END AS k FROM lineitem)
GROUP BY k HAVING count(*) >= 0.01 * (SELECT count(*) FROM lineitem)
""")
def hot_keys(spark, sf):
    items = load(spark, sf, "lineitem").select(
        F.when(F.col("l_discount") < 0.04, F.lit(1).cast("long")).otherwise(F.col("l_suppkey")).alias("k"))
    return joins.hot_keys(items, ["k"], min_share=0.01)


@query("gold_training_panel", TRAIN + "SELECT * FROM gold")
def gold_training_panel(spark, sf):
    return rounded(gold(spark, sf), *NUMERIC_FEATURES)


@query("gold_serving_panel", SERVE + "SELECT * FROM gold")
def gold_serving_panel(spark, sf):
    return rounded(gold(spark, sf, serving=True), *NUMERIC_FEATURES)


@query("gold_summary", TRAIN + """
SELECT set_type, age_segment, count(*) AS n, sum(long_term_care_responder) AS responders FROM gold GROUP BY set_type, age_segment
""")
def gold_summary(spark, sf):
    return gold(spark, sf).groupBy("set_type", "age_segment").agg(
        F.count(F.lit(1)).alias("n"), F.sum("long_term_care_responder").alias("responders"))


def _checks_sql(by: str = "") -> str:
    contract = gold_contract()
    tests = [("not_null", c, f"{c} IS NULL") for c in contract.not_null]
    tests += [("range", c, f"NOT ({c} BETWEEN {a} AND {b})") for c, (a, b) in contract.ranges.items()]
    for c, values in contract.allowed.items():
        listed = ", ".join(f"'{v}'" for v in values if v is not None)
        tests.append(("allowed", c, f"{c} NOT IN ({listed})"))
    return " UNION ALL ".join(
        f"""SELECT '{kind}' AS "check", '{c}' AS column_name, count(*) AS n_rows, count_if({bad}) AS n_bad,
            count_if({bad}) = 0 AS passed FROM gold""" for kind, c, bad in tests
    )


@query("gold_checks", TRAIN + _checks_sql())
def gold_checks(spark, sf):
    return checks.run_row_checks(gold(spark, sf), gold_contract())


@query("range_checks_by_group", """
SELECT grp, 'range' AS "check", c AS column_name, count(*) AS n_rows, count_if(bad) AS n_bad, count_if(bad) = 0 AS passed
FROM (SELECT l_returnflag AS grp, 'l_quantity' AS c, NOT (l_quantity BETWEEN 2 AND 49) AS bad FROM lineitem
      UNION ALL SELECT l_returnflag, 'l_tax', NOT (l_tax BETWEEN 0 AND 0.08) FROM lineitem)
GROUP BY grp, c
""")
def range_checks_by_group(spark, sf):
    from panelspark.config import Contract

    contract = Contract(ranges={"l_quantity": (2, 49), "l_tax": (0, 0.08)})
    df = load(spark, sf, "lineitem").withColumnRenamed("l_returnflag", "grp")
    return checks.run_row_checks(df, contract, by=("grp",))


@query("duplicate_keys", """
SELECT count(*) AS n_keys, count_if(n > 1) AS n_duplicated
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
""")
def duplicate_keys(spark, sf):
    return checks.duplicate_keys(load(spark, sf, "lineitem"), ("l_orderkey", "l_linenumber"))


@query("rows_per_key", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def rows_per_key(spark, sf):
    return joins.rows_per_key(load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("enforced_signature", """
SELECT l_orderkey, l_shipdate, CAST(l_linenumber AS DOUBLE) AS l_linenumber, l_quantity FROM lineitem
""")
def enforced_signature(spark, sf):
    """A model was trained on doubles; whole numbers up to INT widen to them."""
    df = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity")
    trained = checks.schema_signature(df.withColumn("l_linenumber", F.col("l_linenumber").cast("double")), ["l_linenumber", "l_quantity"])
    return checks.enforce_signature(df, trained)


@query("column_type_check", ctes(t="""SELECT * FROM (VALUES ('l_orderkey', 'bigint', 'bigint'), ('l_linenumber', 'double', 'int'),
  ('l_quantity', 'double', 'double'), ('l_colour', 'string', NULL)) t(column_name, expected, found)""") + """
SELECT column_name, expected, found, coalesce(expected = found, false) AS passed FROM t
""")
def column_type_check(spark, sf):
    expected = {"l_orderkey": "bigint", "l_linenumber": "double", "l_quantity": "double", "l_colour": "string"}
    return checks.type_check(load(spark, sf, "lineitem"), expected)
