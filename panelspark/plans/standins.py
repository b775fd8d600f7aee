"""Panel source tables derived from the given tables.

The definitions use only integer arithmetic and SQL that Spark and other engines read the same
way, so that checks can start from equal inputs. Members are one row per customer and month with
orders; attributes sum up the month's line items; labels tell whether an order was urgent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelspark.operators.waves import WaveCalendar

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

TRAIN_WAVES = ["1996-01-10", "1996-07-10", "1997-01-10", "1997-07-10"]
TEST_WAVES = ["1998-01-10"]
SERVING_WAVES = ["1998-07-10"]

MEMBERS_SQL = """
SELECT concat('  ', CAST(c_custkey AS STRING), ' ') AS cifidnbr,
       eff_beg_dt,
       CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST((c_custkey * 13) % 120 - 5 AS INT) END AS custage,
       CASE WHEN c_custkey % 5 = 0 THEN 'JUV' ELSE 'ADT' END AS embrtyp,
       CASE WHEN c_custkey % 17 = 0 THEN NULL
            ELSE make_date(CAST(1930 + c_custkey % 85 AS INT), CAST(1 + c_custkey % 12 AS INT), 1) END AS birthdte,
       CASE WHEN c_custkey % 11 = 0 THEN NULL
            ELSE make_date(CAST(1960 + c_custkey % 40 AS INT), CAST(1 + c_custkey % 12 AS INT), 15) END AS mbrdt,
       CASE WHEN c_mktsegment = 'BUILDING' AND c_nationkey = 7 THEN 'AFFLUENT RETIRED SINGLES'
            WHEN c_mktsegment = 'AUTOMOBILE' THEN 'AFFLUENT FAMILIES'
            WHEN c_mktsegment = 'BUILDING' THEN 'MIDDLE MARKET FAMILIES'
            WHEN c_mktsegment = 'FURNITURE' THEN 'INSUFFICIENT INCOME'
            WHEN c_mktsegment = 'HOUSEHOLD' THEN 'MIDDLE MARKET PRERETIRED'
            ELSE 'AGE UNKNOWN' END AS segment,
       CAST(c_custkey % 97 AS INT) AS totprem,
       CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE CAST(c_custkey % 23 AS INT) END AS tradprem,
       CAST(c_custkey % 19 AS INT) AS ulprem,
       CAST(c_custkey % 7 AS INT) AS vulprem,
       CAST((c_custkey % 89) * 10 AS INT) AS totsa,
       CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE CAST((c_custkey % 31) * 5 AS INT) END AS tradsa,
       CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE CAST((c_custkey % 29) * 4 AS INT) END AS ulsa,
       CAST(c_custkey % 5 AS INT) AS vulsa,
       CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_acctbal * 300 END AS hhaua,
       CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE CAST(c_custkey % 3 AS INT) END AS hhwrapown,
       CASE WHEN c_custkey % 11 < 2 THEN NULL ELSE CAST(c_custkey % 130 AS INT) END AS yearsmember,
       CAST(c_custkey % 14 - 4 AS INT) AS yrspurch,
       CASE WHEN c_custkey % 15 = 0 THEN NULL ELSE c_acctbal END AS propassets,
       CAST((c_custkey % 53) * 100 AS DECIMAL(12, 2)) AS hhetrs_assets,
       CAST((c_custkey % 47) * 20 AS INT) AS hhsa,
       CAST(n_orders * 10 AS INT) AS hhprem,
       CAST((c_custkey % 59) * 50 AS DECIMAL(12, 2)) AS etrs_assets,
       CAST(c_custkey % 21 AS INT) AS hhyrspurch,
       CAST((c_custkey % 61) * 70 AS DECIMAL(12, 2)) AS hhpropassets,
       CAST((c_custkey % 67) * 90 - 1000 AS DECIMAL(12, 2)) AS netasset
FROM {customer} JOIN (
  SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS eff_beg_dt, count(*) AS n_orders
  FROM {orders} GROUP BY o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE)
) active ON o_custkey = c_custkey
"""

ATTRIBUTES_SQL = """
SELECT concat(CAST(o_custkey AS STRING), '  ') AS cifidnbr, eff_beg_dt,
       CAST(n % 10 AS INT) AS w_hlth_ins_direct_pay_indx,
       CAST(q % 10 AS INT) AS w_ins_medsup_buyer_indx,
       CAST(n_returned % 10 AS INT) AS w_hlth_mng_wearable_indx,
       CAST((n + q) % 10 AS INT) AS w_short_term_loan_indx,
       CAST(q * 1000 AS DECIMAL(14, 2)) AS w_aggrgt_zip4_home_value,
       CAST(q % 101 AS INT) AS w_census_pct_white_collar,
       CAST(q * 10 AS DECIMAL(14, 2)) AS w_census_median_hh_buying_inc,
       CAST(q * 20 AS DECIMAL(14, 2)) AS w_census_median_hh_inc,
       CAST(n * 5000 AS DECIMAL(14, 2)) AS w_census_median_home_value
FROM (
  SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS eff_beg_dt,
         count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS q,
         count_if(l_returnflag = 'R') AS n_returned
  FROM {orders} JOIN {lineitem} ON l_orderkey = o_orderkey
  GROUP BY o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE)
) sums
"""

LABELS_SQL = """
SELECT concat(' ', CAST(o_custkey AS STRING)) AS customer_id_number,
       date_trunc('month', o_orderdate) AS purchase_period_begin_timestamp,
       max(CASE WHEN o_orderstatus = 'P' THEN NULL
                WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS long_term_care_responder
FROM {orders} GROUP BY o_custkey, date_trunc('month', o_orderdate)
"""

RUNS_SQL = """
SELECT concat('run-', CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING), '-', CAST(l_partkey AS STRING)) AS run_id,
       concat('exp-', CAST(l_suppkey AS STRING)) AS experiment_id,
       CASE WHEN l_linenumber = 1 THEN NULL
            ELSE concat('parent-', CAST(l_suppkey AS STRING), '-', CAST(l_linenumber AS STRING)) END AS parent_run_id,
       CASE WHEN l_returnflag = 'R' THEN 'FAILED' ELSE 'FINISHED' END AS status,
       l_shipdate AS start_time,
       CASE WHEN l_linestatus = 'F' THEN 'OK' ELSE 'FAIL' END AS tag_status,
       CASE WHEN l_quantity > 10 THEN 'True' ELSE 'False' END AS tag_resampling,
       l_extendedprice AS loss, l_discount AS roc_auc, l_tax AS lift
FROM {lineitem}
"""


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def derive(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    used = {t: load(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in sql}
    return spark.sql(sql, **used)


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, MEMBERS_SQL)


def attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, ATTRIBUTES_SQL)


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, LABELS_SQL)


def training_calendar() -> WaveCalendar:
    return WaveCalendar.from_args(train=TRAIN_WAVES, test=TEST_WAVES)


def serving_calendar() -> WaveCalendar:
    return WaveCalendar.from_args(serving=SERVING_WAVES)
