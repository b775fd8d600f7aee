"""Names, recodes, casts, filters and plain aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.operators import columns, filters, levels, preprocess, sampling, waves
from panelspark.plans import standins
from panelspark.plans.queries.book import ctes, query, rounded, source_sql
from panelspark.plans.standins import load

MEMBERS = source_sql(standins.MEMBERS_SQL)
LABELS = source_sql(standins.LABELS_SQL)


@query("column_names_snake", """
SELECT c_custkey AS c_custkey, c_name AS c_name_full, c_acctbal AS acct_bal_, c_nationkey AS nation_1 FROM customer
""")
def column_names_snake(spark, sf):
    df = load(spark, sf, "customer").select(
        F.col("c_custkey").alias("C Custkey"), F.col("c_name").alias("C--Name  Full"),
        F.col("c_acctbal").alias("ACCT bal ($)"), F.col("c_nationkey").alias("Nation_1"),
    )
    return columns.normalise_names(df)


@query("column_names_sql", """
SELECT c_custkey AS C_Custkey, c_name AS Name_Full, c_acctbal AS ACCT_bal_ FROM customer
""")
def column_names_sql(spark, sf):
    df = load(spark, sf, "customer").select(
        F.col("c_custkey").alias("C Custkey"), F.col("c_name").alias("Name-Full"),
        F.col("c_acctbal").alias("ACCT bal ($)"),
    )
    return columns.normalise_names(df, rule="sql")


@query("recode_literal", """
SELECT event_id, event_type,
       CASE event_type WHEN 'click' THEN 'active' WHEN 'purchase' THEN 'active' WHEN 'view' THEN 'passive' END AS kind
FROM events
""")
def recode_literal(spark, sf):
    mapping = {"click": "active", "purchase": "active", "view": "passive"}
    df = load(spark, sf, "events").select("event_id", "event_type")
    return columns.recode(df, "event_type", mapping, "kind")


@query("recode_by_table", """
SELECT c_custkey, CASE WHEN r_name <> 'ASIA' THEN r_name END AS region
FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey
""")
def recode_by_table(spark, sf):
    regions = load(spark, sf, "region").filter(F.col("r_name") != "ASIA")
    table = load(spark, sf, "nation").join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    df = load(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("region"))
    return columns.recode_by_table(df, "region", table, "n_nationkey", "r_name")


@query("normalise_id", ctes(m=MEMBERS) + " SELECT trim(cifidnbr) AS cifidnbr, eff_beg_dt FROM m")
def normalise_id(spark, sf):
    df = standins.members(spark, sf).select("cifidnbr", "eff_beg_dt")
    return columns.normalise_id(df, "cifidnbr", "cifidnbr")


@query("timestamp_to_date", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders
""")
def timestamp_to_date(spark, sf):
    return columns.to_date(load(spark, sf, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate")


@query("decimals_to_double", """
SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice AS DECIMAL(14, 2)) AS DOUBLE) AS price,
       CAST(CAST(l_tax AS DECIMAL(6, 2)) AS DOUBLE) AS tax, CAST(l_discount AS DECIMAL(6, 2)) AS outcome
FROM lineitem
""")
def decimals_to_double(spark, sf):
    df = load(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_extendedprice").cast("decimal(14,2)").alias("price"),
        F.col("l_tax").cast("decimal(6,2)").alias("tax"), F.col("l_discount").cast("decimal(6,2)").alias("outcome"),
    )
    return columns.decimals_to_double(df, keep=["outcome"])


@query("integers_to_double", """
SELECT p_partkey, CAST(p_size AS DOUBLE) AS p_size, CASE WHEN p_size > 25 THEN 1 ELSE 0 END AS outcome,
       CASE WHEN p_size % 7 <> 0 THEN CAST(p_size AS DOUBLE) END AS with_gaps
FROM part
""")
def integers_to_double(spark, sf):
    df = load(spark, sf, "part").select(
        "p_partkey", "p_size", F.when(F.col("p_size") > 25, 1).otherwise(0).alias("outcome"),
        F.when(F.col("p_size") % 7 != 0, F.col("p_size")).alias("with_gaps"),
    )
    return columns.integers_to_double(df, keep=["outcome"])


@query("sentinel_to_null", ctes(m=MEMBERS) + """
SELECT trim(cifidnbr) AS cifidnbr, eff_beg_dt, CASE WHEN segment <> 'AGE UNKNOWN' THEN segment END AS segment FROM m
""")
def sentinel_to_null(spark, sf):
    from panelspark.functions.features import null_if

    return standins.members(spark, sf).select(
        F.trim("cifidnbr").alias("cifidnbr"), "eff_beg_dt", null_if(F.col("segment"), "AGE UNKNOWN").alias("segment")
    )


@query("rows_from_date", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_day FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '1997-06-15'
""")
def rows_from_date(spark, sf):
    df = load(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("order_day"))
    return filters.on_or_after(df, "order_day", "1997-06-15")


@query("labelled_rows", ctes(l=LABELS) + """
SELECT trim(customer_id_number) AS cifidnbr, CAST(purchase_period_begin_timestamp AS DATE) AS period,
       long_term_care_responder
FROM l WHERE long_term_care_responder IS NOT NULL
""")
def labelled_rows(spark, sf):
    df = standins.labels(spark, sf).select(
        F.trim("customer_id_number").alias("cifidnbr"),
        F.to_date("purchase_period_begin_timestamp").alias("period"), "long_term_care_responder",
    )
    return filters.labelled(df, "long_term_care_responder")


@query("without_extreme_rows", """
SELECT vec_id, label FROM embeddings WHERE list_max([abs(x) FOR x IN embedding]) < 0.3
""")
def without_extreme_rows(spark, sf):
    return filters.without_extreme_rows(load(spark, sf, "embeddings"), "embedding", 0.3).select("vec_id", "label")


@query("class_counts", """
SELECT quality, toxic, count(*) AS n FROM labels GROUP BY quality, toxic
""")
def class_counts(spark, sf):
    return sampling.class_count_table(load(spark, sf, "labels"), "quality", "toxic")


@query("known_values_by_kind", """
SELECT o_orderkey, CAST(o_custkey IS NOT NULL AS INT) + CAST(o_totalprice IS NOT NULL AS INT) AS n_numeric,
       CAST(o_orderstatus <> 'P' AS INT) + CAST(o_orderpriority IS NOT NULL AS INT) AS n_text FROM orders
""")
def known_values_by_kind(spark, sf):
    """The split into numeric and text columns, used to count what each row knows of either."""
    df = load(spark, sf, "orders").withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("P")))
    numeric, text = columns.split_by_kind(df, exclude=["o_orderkey"])

    def known(names):
        return sum((F.col(c).isNotNull().cast("int") for c in names), F.lit(0))

    return df.select("o_orderkey", known(numeric).alias("n_numeric"), known(text).alias("n_text"))


@query("class_balance", ctes(l=LABELS) + """
, c AS (SELECT long_term_care_responder AS y, count(*) AS n FROM l WHERE long_term_care_responder IS NOT NULL GROUP BY 1)
SELECT y, n, round(n / (SELECT sum(n) FROM c), 6) AS share FROM c
""")
def class_balance(spark, sf):
    df = filters.labelled(standins.labels(spark, sf), "long_term_care_responder")
    return rounded(sampling.class_balance(df, "long_term_care_responder").withColumnRenamed(
        "long_term_care_responder", "y"), "share")


@query("level_shares", """
WITH c AS (
  SELECT 'p_brand' AS column_name, p_brand AS level, count(*) AS n FROM part GROUP BY p_brand
  UNION ALL SELECT 'p_type', p_type, count(*) FROM part GROUP BY p_type
  UNION ALL SELECT 'p_size', CAST(p_size AS VARCHAR), count(*) FROM part GROUP BY p_size)
SELECT column_name, level, n, round(100.0 * n / (SELECT count(*) FROM part), 6) AS pct FROM c
""")
def level_shares(spark, sf):
    return rounded(levels.level_shares(load(spark, sf, "part"), ["p_brand", "p_type", "p_size"]), "pct")


@query("distinct_snapshots", """
SELECT DISTINCT o_orderstatus, CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot FROM orders
""")
def distinct_snapshots(spark, sf):
    df = load(spark, sf, "orders").withColumn("month", F.trunc("o_orderdate", "MM"))
    return waves.distinct_snapshots(df, "month", ["o_orderstatus"])


@query("column_statistics", """
SELECT column_name, round(median(v), 6) AS median, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std, count(v) AS n
FROM (SELECT 'l_quantity' AS column_name, l_quantity AS v FROM lineitem
      UNION ALL SELECT 'l_extendedprice', l_extendedprice FROM lineitem
      UNION ALL SELECT 'l_discount', l_discount FROM lineitem
      UNION ALL SELECT 'l_tax', CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_tax END FROM lineitem)
GROUP BY column_name
""")
def column_statistics(spark, sf):
    df = load(spark, sf, "lineitem").withColumn(
        "l_tax", F.when(F.col("l_linenumber") % 3 != 0, F.col("l_tax")))
    stats = preprocess.numeric_statistics(df, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return rounded(stats, "median", "mean", "std")


@query("column_modes", """
WITH c AS (
  SELECT 'event_type' AS column_name, event_type AS level, count(*) AS n FROM events GROUP BY event_type
  UNION ALL SELECT 'user', CASE WHEN user_id % 4 > 0 THEN CAST(user_id AS VARCHAR) END, count(*) FROM events GROUP BY 2)
SELECT column_name, level, n FROM (
  SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY n DESC, level) AS r FROM c WHERE level IS NOT NULL) WHERE r = 1
""")
def column_modes(spark, sf):
    df = load(spark, sf, "events").select(
        "event_type", F.when(F.col("user_id") % 4 > 0, F.col("user_id").cast("string")).alias("user"))
    return preprocess.column_modes(df, ["event_type", "user"])
