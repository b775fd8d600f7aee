"""Seeded samples, splits and folds over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.operators import sampling
from panelspark.plans import standins
from panelspark.plans.queries.book import ctes, query
from panelspark.plans.queries.evaluation import SCORES, scores

KEYS = ["o_orderkey"]


def _hash(seed: int) -> str:
    return f"('0x' || substr(md5('{seed}|' || o_orderkey), 1, 15))::BIGINT"


@query("down_sample_by_share", ctes(s=SCORES, c="SELECT 1.0 * sum(y) / count(*) AS pos FROM s") + f"""
SELECT o_orderkey, y FROM s, c WHERE y = 1 OR {_hash(7)} / 1152921504606846976::DOUBLE < least(1.0, 2 * pos)
""")
def down_sample_by_share(spark, sf):
    return sampling.down_sample_by_share(scores(spark, sf), "y", KEYS, ratio=2, seed=7).select("o_orderkey", "y")


@query("under_sample", ctes(s=SCORES, r=f"SELECT *, row_number() OVER (PARTITION BY y ORDER BY {_hash(42)}, o_orderkey::VARCHAR) AS r FROM s") + """
SELECT o_orderkey, y FROM r WHERE y = 1 OR r <= floor((SELECT sum(y) FROM s) / 0.5)
""")
def under_sample(spark, sf):
    return sampling.under_sample(scores(spark, sf), "y", KEYS, ratio=0.5).select("o_orderkey", "y")


@query("stratified_split", ctes(
    s=SCORES,
    q="SELECT y, count(*) AS n, ceil(0.3 * (SELECT count(*) FROM s)) * count(*) / (SELECT count(*) FROM s) AS quota FROM s GROUP BY y",
    z="""SELECT y, floor(quota) + (row_number() OVER (ORDER BY floor(quota) - quota, y)
         <= ceil(0.3 * (SELECT sum(n) FROM q)) - (SELECT sum(floor(quota)) FROM q))::INT AS size FROM q""",
    r=f"SELECT *, row_number() OVER (PARTITION BY y ORDER BY {_hash(42)}, o_orderkey::VARCHAR) AS r FROM s",
) + " SELECT o_orderkey, y, CASE WHEN r <= size THEN 'calibration' ELSE 'test' END AS part FROM r JOIN z USING (y)")
def stratified_split(spark, sf):
    df = scores(spark, sf).select("o_orderkey", "y")
    return sampling.stratified_split(df, "y", KEYS, share=0.3)


@query("stratified_folds", ctes(s=SCORES) + f"""
SELECT o_orderkey, y, CAST(ntile(5) OVER (PARTITION BY y ORDER BY {_hash(42)}, o_orderkey::VARCHAR) - 1 AS INT) AS fold FROM s
""")
def stratified_folds(spark, sf):
    return sampling.stratified_folds(scores(spark, sf).select("o_orderkey", "y"), "y", KEYS, k=5)


@query("nested_samples", ctes(s=SCORES, r=f"""SELECT *, row_number() OVER (PARTITION BY y ORDER BY {_hash(42)}, o_orderkey::VARCHAR) AS r,
  count(*) OVER (PARTITION BY y) AS n FROM s""") + """
SELECT o_orderkey, y, CASE WHEN r <= round_even(0.2 * n, 0) THEN 0.2::DOUBLE WHEN r <= round_even(0.4 * n, 0) THEN 0.4::DOUBLE
  WHEN r <= round_even(0.6 * n, 0) THEN 0.6::DOUBLE WHEN r <= round_even(0.8 * n, 0) THEN 0.8::DOUBLE ELSE 1.0::DOUBLE END AS first_share FROM r
""")
def nested_samples(spark, sf):
    df = scores(spark, sf).select("o_orderkey", "y")
    return sampling.nested_samples(df, "y", KEYS, [0.2, 0.4, 0.6, 0.8, 1.0])


# lines by the day of shipping, returned ones all in one stratum: thousands of small strata and a large one
DAYS_SQL = """
SELECT l_orderkey, l_linenumber, CAST(CASE WHEN l_returnflag = 'R' THEN 0
       ELSE year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) END AS INT) AS day
FROM {lineitem}
"""
LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_HASH = "('0x' || substr(md5('42|' || l_orderkey || '|' || l_linenumber), 1, 15))::BIGINT"
RANKED_DAYS = {
    "s": DAYS_SQL.format(lineitem="lineitem"),
    "r": f"SELECT *, rank() OVER (PARTITION BY day ORDER BY {LINE_HASH}) AS r, count(*) OVER (PARTITION BY day) AS n FROM s",
}


def line_days(spark, sf):
    return standins.derive(spark, sf, DAYS_SQL)


@query("stratified_folds_of_days", ctes(**RANKED_DAYS) + """
SELECT l_orderkey, l_linenumber, day, CAST((r > n // 4 + least(1, n % 4))::INT + (r > n // 4 * 2 + least(2, n % 4))::INT
       + (r > n // 4 * 3 + least(3, n % 4))::INT AS INT) AS fold FROM r
""")
def stratified_folds_of_days(spark, sf):
    return sampling.stratified_folds(line_days(spark, sf), "day", LINE_KEYS, k=4)


@query("stratified_split_of_days", ctes(
    **RANKED_DAYS,
    t="SELECT count(*)::DOUBLE AS n_rows, ceil(0.3::DOUBLE * count(*)) AS total FROM s",
    q="SELECT day, total * count(*) / n_rows AS quota FROM s, t GROUP BY day, total, n_rows",
    z="""SELECT day, floor(quota) + (row_number() OVER (ORDER BY floor(quota) - quota, day::VARCHAR)
         <= (SELECT total FROM t) - (SELECT sum(floor(quota)) FROM q))::INT AS size FROM q""",
) + " SELECT l_orderkey, l_linenumber, day, CASE WHEN r <= size THEN 'calibration' ELSE 'test' END AS part FROM r JOIN z USING (day)")
def stratified_split_of_days(spark, sf):
    return sampling.stratified_split(line_days(spark, sf), "day", LINE_KEYS, share=0.3)


@query("nested_samples_of_days", ctes(**RANKED_DAYS) + """
SELECT l_orderkey, l_linenumber, day, CASE WHEN r <= round_even(0.25::DOUBLE * n, 0) THEN 0.25::DOUBLE
       WHEN r <= round_even(0.5::DOUBLE * n, 0) THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS first_share FROM r
""")
def nested_samples_of_days(spark, sf):
    return sampling.nested_samples(line_days(spark, sf), "day", LINE_KEYS, [0.25, 0.5, 1.0])


@query("fold_sizes", ctes(s=SCORES, f=f"SELECT y, ntile(5) OVER (PARTITION BY y ORDER BY {_hash(42)}, o_orderkey::VARCHAR) - 1 AS fold FROM s") + """
SELECT CAST(fold AS INT) AS fold, y, count(*) AS n FROM f GROUP BY fold, y
""")
def fold_sizes(spark, sf):
    folds = sampling.stratified_folds(scores(spark, sf), "y", KEYS, k=5)
    return folds.groupBy("fold", "y").agg(F.count(F.lit(1)).alias("n"))
