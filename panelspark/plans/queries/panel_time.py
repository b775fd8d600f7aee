"""Wave calendars against the snapshot dates in the data."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from panelspark.operators import waves
from panelspark.plans import standins
from panelspark.plans.queries.book import ctes, date_list, query, source_sql
from panelspark.plans.standins import load

MEMBERS = source_sql(standins.MEMBERS_SQL)
LABELS = source_sql(standins.LABELS_SQL)

ALL_WAVES = standins.TRAIN_WAVES + standins.TEST_WAVES

# the snapshot each wave is nearest to; of snapshots equally near the earlier one
NEAREST = """
SELECT CAST(w AS DATE) AS wave, arg_min(snapshot, (abs(datediff('day', snapshot, w)), snapshot)) AS snapshot,
       min(abs(datediff('day', snapshot, w))) AS days
FROM snaps, (VALUES {waves}) t(w) GROUP BY w
"""


def _dates(texts):
    return [dt.date.fromisoformat(t) for t in texts]


@query("nearest_snapshots", ctes(
    snaps="SELECT DISTINCT o_orderpriority AS source, CAST(o_orderdate AS DATE) AS snapshot FROM orders",
) + f"""
SELECT source, CAST(w AS DATE) AS wave, arg_min(snapshot, (abs(datediff('day', snapshot, w)), snapshot)) AS snapshot,
       min(abs(datediff('day', snapshot, w))) AS days
FROM snaps, (VALUES {date_list(ALL_WAVES)}) t(w) GROUP BY source, w
""")
def nearest_snapshots(spark, sf):
    df = load(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("source"), F.to_date("o_orderdate").alias("day"))
    return waves.nearest_snapshots(df, "day", _dates(ALL_WAVES), ["source"])


@query("match_waves", ctes(
    snaps=f"SELECT DISTINCT eff_beg_dt AS snapshot FROM ({MEMBERS}) m",
    nearest=NEAREST.format(waves=date_list(ALL_WAVES)),
) + " SELECT snapshot, wave FROM nearest")
def match_waves(spark, sf):
    return waves.match_waves(standins.members(spark, sf), "eff_beg_dt", _dates(ALL_WAVES))


# six waves within two months compete for few month starts, per order status
CONTESTED = ["1996-03-20", "1996-03-02", "1996-04-01", "1996-02-10", "1996-03-15", "1996-04-20"]
_CHOICE = """(SELECT snapshot FROM snaps s WHERE s.source = c.source AND NOT list_contains(c.used, snapshot)
              ORDER BY abs(datediff('day', snapshot, w.wave)), snapshot LIMIT 1)"""


@query("match_waves_contested", f"""
WITH RECURSIVE snaps AS (
  SELECT DISTINCT o_orderstatus AS source, CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot FROM orders),
w AS (SELECT row_number() OVER () AS pos, wave FROM (VALUES {date_list(CONTESTED)}) t(wave)),
c AS (
  SELECT DISTINCT source, CAST(0 AS BIGINT) AS pos, CAST([] AS DATE[]) AS used, CAST(NULL AS DATE) AS wave FROM snaps
  UNION ALL
  SELECT c.source, w.pos, list_append(c.used, {_CHOICE}), w.wave FROM c JOIN w ON w.pos = c.pos + 1)
SELECT source, used[-1] AS snapshot, wave FROM c WHERE pos > 0
""")
def match_waves_contested(spark, sf):
    df = load(spark, sf, "orders").select(
        F.col("o_orderstatus").alias("source"), F.trunc("o_orderdate", "MM").alias("month"))
    return waves.match_waves(df, "month", _dates(CONTESTED), by=["source"])


ATTACHED = ctes(
    m=MEMBERS,
    snaps="SELECT DISTINCT eff_beg_dt AS snapshot FROM m",
    nearest=NEAREST.format(waves=date_list(ALL_WAVES)),
) + """
SELECT trim(cifidnbr) AS cifidnbr, eff_beg_dt, strftime(wave, '%Y-%m-%d') AS adjusted_effective_date{role}
FROM m JOIN nearest ON snapshot = eff_beg_dt
"""


@query("attach_wave", ATTACHED.format(role=""))
def attach_wave(spark, sf):
    df = standins.members(spark, sf).select(F.trim("cifidnbr").alias("cifidnbr"), "eff_beg_dt")
    return waves.attach_wave(df, "eff_beg_dt", waves.match_waves(df, "eff_beg_dt", _dates(ALL_WAVES)))


@query("attach_wave_and_role", ATTACHED.format(
    role=", CASE WHEN wave >= DATE '1998-01-01' THEN 'test' ELSE 'train' END AS set_type"))
def attach_wave_and_role(spark, sf):
    df = standins.members(spark, sf).select(F.trim("cifidnbr").alias("cifidnbr"), "eff_beg_dt")
    return waves.snap_to_calendar(df, "eff_beg_dt", standins.training_calendar())


@query("split_order_by_group", """
SELECT o_custkey, max(CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) END) AS last_train,
       min(CASE WHEN o_orderstatus <> 'F' THEN CAST(o_orderdate AS DATE) END) AS first_test,
       max(CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) END)
         < min(CASE WHEN o_orderstatus <> 'F' THEN CAST(o_orderdate AS DATE) END) AS in_order
FROM orders GROUP BY o_custkey
""")
def split_order_by_group(spark, sf):
    df = load(spark, sf, "orders").select(
        "o_custkey", F.to_date("o_orderdate").alias("day"),
        F.when(F.col("o_orderstatus") == "F", "train").otherwise("test").alias("role"))
    return waves.split_order(df, "day", "role", ["o_custkey"])


@query("cadence_by_source", """
WITH d AS (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS d FROM orders),
g AS (SELECT o_custkey, d - lag(d) OVER (PARTITION BY o_custkey ORDER BY d) AS gap FROM d)
SELECT o_custkey, count(*) AS n_dates, min(gap) AS min_gap, max(gap) AS max_gap,
       count(*) < 3 OR max(gap) - min(gap) <= 5 AS regular
FROM g GROUP BY o_custkey
""")
def cadence_by_source(spark, sf):
    df = load(spark, sf, "orders").select("o_custkey", F.to_date("o_orderdate").alias("day"))
    return waves.cadence(df, "day", ["o_custkey"])
