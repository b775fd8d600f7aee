"""Choosing runs and model versions, over run tables made of line items and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.operators import registry
from panelspark.plans import standins
from panelspark.plans.queries.book import ctes, query, source_sql
from panelspark.plans.standins import load

RUNS = source_sql(standins.RUNS_SQL)


def runs(spark, sf):
    raw = standins.derive(spark, sf, standins.RUNS_SQL)
    return raw.select(
        "run_id", "experiment_id", "parent_run_id", "status", "start_time",
        F.create_map(F.lit("status"), "tag_status", F.lit("use_resampling_in_train_pipeline"), "tag_resampling").alias("tags"),
        F.create_map(F.lit("median_cv_log_loss"), "loss", F.lit("test_log_loss"), "loss",
                     F.lit("test_roc_auc"), "roc_auc", F.lit("test_auprc_lift"), "lift").alias("metrics"),
    )


@query("best_of_latest_parent", ctes(
    r=RUNS,
    l="""SELECT experiment_id, arg_max(coalesce(parent_run_id, run_id), (start_time, run_id)) AS parent_run_id
         FROM r WHERE status = 'FINISHED' AND tag_resampling = 'True' GROUP BY experiment_id""",
) + """
SELECT experiment_id, parent_run_id, arg_min(run_id, (loss, run_id)) AS run_id, min(loss) AS median_cv_log_loss
FROM r JOIN l USING (experiment_id, parent_run_id) WHERE status = 'FINISHED' AND tag_status = 'OK'
GROUP BY experiment_id, parent_run_id
""")
def best_of_latest_parent(spark, sf):
    return registry.best_of_latest_parent(runs(spark, sf), resampling=True)


@query("best_overall", ctes(r=RUNS) + """
SELECT experiment_id, arg_min(run_id, (loss, run_id)) AS run_id, min(loss) AS median_cv_log_loss
FROM r WHERE status = 'FINISHED' AND tag_status = 'OK' AND tag_resampling = 'False' GROUP BY experiment_id
""")
def best_overall(spark, sf):
    return registry.best_overall(runs(spark, sf), resampling=False)


@query("latest_experiment", """
SELECT o_orderpriority AS name, CAST(arg_max(o_orderkey, (o_orderdate, CAST(o_orderkey AS VARCHAR))) AS VARCHAR) AS experiment_id,
       max(o_orderdate) AS last_update_time FROM orders GROUP BY o_orderpriority
""")
def latest_experiment(spark, sf):
    experiments = load(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("name"), F.col("o_orderkey").cast("string").alias("experiment_id"),
        F.col("o_orderdate").alias("last_update_time"))
    return registry.latest_experiment(experiments)


@query("comparison_metrics", ctes(r=RUNS) + """
SELECT run_id, 'test_log_loss' AS metric_name, -loss AS value FROM r
UNION ALL SELECT run_id, 'test_roc_auc', roc_auc FROM r UNION ALL SELECT run_id, 'test_auprc_lift', lift FROM r
""")
def comparison_metrics(spark, sf):
    return registry.comparison_metrics(runs(spark, sf))


# per part: its first shipment's figures against its last one's; parts shipped once have no champion
COMPARED = ctes(
    f="""SELECT l_partkey AS model, l_extendedprice AS loss, l_discount AS auc, l_tax * 40 AS lift,
         row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber) AS a,
         row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) AS b FROM lineitem""",
    t="""SELECT model, a, b, 'test_log_loss' AS metric_name, -loss AS value FROM f
         UNION ALL SELECT model, a, b, 'test_roc_auc', auc FROM f UNION ALL SELECT model, a, b, 'test_auprc_lift', lift FROM f""",
    c="""SELECT x.model, x.metric_name, x.value AS challenger, y.value AS champion, x.value > y.value AS better
         FROM (SELECT * FROM t WHERE b = 1) x LEFT JOIN (SELECT * FROM t WHERE a = 1 AND b > 25) y USING (model, metric_name)""",
)


def _compared(spark, sf):
    figures = F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_tax")
    firsts = load(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("model")).agg(
        F.min(figures).alias("first"), F.max(figures).alias("last"), F.count(F.lit(1)).alias("n"))

    def metrics_of(which):
        return firsts.select("model", "n", F.create_map(
            F.lit("test_log_loss"), F.col(f"{which}.l_extendedprice"), F.lit("test_roc_auc"), F.col(f"{which}.l_discount"),
            F.lit("test_auprc_lift"), F.col(f"{which}.l_tax") * 40).alias("metrics"))

    challenger = registry.comparison_metrics(metrics_of("last"), id_col="model")
    champion = registry.comparison_metrics(metrics_of("first").filter("n > 25"), id_col="model")
    return registry.compare_metrics(challenger, champion, by=["model"])


@query("compare_metrics", COMPARED + "SELECT model, metric_name, challenger, champion, better FROM c")
def compare_metrics(spark, sf):
    return _compared(spark, sf)


@query("promotion_decision", COMPARED + """
SELECT model, bool_or(champion IS NOT NULL) AS has_champion,
       CASE WHEN bool_or(champion IS NOT NULL) THEN bool_and(coalesce(better, false))
            ELSE bool_or((metric_name = 'test_roc_auc' AND challenger >= 0.07) OR (metric_name = 'test_auprc_lift' AND challenger >= 2)) END AS promote
FROM c GROUP BY model
""")
def promotion_decision(spark, sf):
    return registry.promotion_decision(_compared(spark, sf), "enabled", min_roc_auc=0.07, by=["model"])


# one event per order: a customer is a model, its order count within a status the version
EVENTS = """SELECT concat('model-', CAST(o_custkey AS STRING)) AS name, CAST(o_orderkey % 4 + 1 AS INT) AS version, o_orderkey AS seq,
  CASE WHEN o_orderstatus = 'F' THEN 'Staging' WHEN o_orderstatus = 'O' THEN 'None' ELSE 'Production' END AS stage,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'Champion' WHEN o_orderpriority = '5-LOW' THEN 'Challenger' END AS alias,
  concat('run-', CAST(o_orderkey AS STRING)) AS run_id FROM {orders}"""
STATES = {
    "e": EVENTS.format(orders="orders"),
    "v": "SELECT name, version, max(seq) AS seq, arg_max(stage, seq) AS stage, arg_max(run_id, seq) AS run_id FROM e GROUP BY name, version",
    "va": "SELECT v.*, e.alias FROM v JOIN e USING (name, version, seq)",
    "latest": """SELECT name, stage, version, alias, run_id FROM (
        SELECT *, row_number() OVER (PARTITION BY name, stage ORDER BY version DESC) AS r FROM va) WHERE r = 1""",
}


def _events(spark, sf):
    return standins.derive(spark, sf, EVENTS)


@query("model_versions", ctes(**STATES) + "SELECT name, version, seq, stage, alias, run_id FROM va")
def model_versions(spark, sf):
    return registry.model_versions(_events(spark, sf))


@query("latest_versions", ctes(**STATES) + "SELECT name, stage, version, alias, run_id FROM latest")
def latest_versions(spark, sf):
    return registry.latest_versions(_events(spark, sf))


@query("champions_in_staging", ctes(**STATES) + """
SELECT name, stage, version, alias, run_id FROM latest WHERE stage = 'Staging' AND alias = 'Champion'
""")
def champions_in_staging(spark, sf):
    return registry.versions_by_stage_and_alias(_events(spark, sf), "Staging", "Champion")


@query("transition_versions", ctes(**STATES) + """
, m AS (SELECT name, version AS target FROM latest WHERE stage = 'None'),
s AS (SELECT va.*, m.target, max(seq) OVER (PARTITION BY name) AS top FROM va JOIN m USING (name))
SELECT name, version, top + 1 AS seq, CASE WHEN version = target THEN 'Staging' ELSE 'Archived' END AS stage,
       CASE WHEN version = target THEN 'Champion' WHEN alias <> 'Champion' THEN alias END AS alias, run_id
FROM s WHERE version = target OR stage = 'Staging'
""")
def transition_versions(spark, sf):
    events = _events(spark, sf)
    return registry.transition(events, registry.versions_by_stage_and_alias(events, "None"))


@query("versions_by_alias", ctes(**STATES) + """
SELECT name, version, stage, run_id FROM (
  SELECT *, row_number() OVER (PARTITION BY name ORDER BY version DESC) AS r FROM va WHERE alias = 'Champion') WHERE r = 1
""")
def versions_by_alias(spark, sf):
    return registry.versions_by_alias(_events(spark, sf), "Champion")


@query("move_alias", ctes(**STATES) + """
, m AS (SELECT name, version AS target FROM latest WHERE stage = 'None'),
s AS (SELECT va.*, m.target, max(seq) OVER (PARTITION BY name) AS top FROM va JOIN m USING (name)),
c AS (SELECT * FROM s WHERE (version = target) IS DISTINCT FROM (alias IS NOT DISTINCT FROM 'Champion'))
SELECT name, version, top + row_number() OVER (PARTITION BY name ORDER BY version) AS seq, stage,
       CASE WHEN version = target THEN 'Champion' END AS alias, run_id FROM c
""")
def move_alias(spark, sf):
    events = _events(spark, sf)
    return registry.move_alias(events, registry.versions_by_stage_and_alias(events, "None"), "Champion")


# every customer's model gets a run of its own
NEW = "SELECT concat('model-', CAST(c_custkey AS STRING)) AS name, concat('new-', CAST(c_custkey AS STRING)) AS run_id FROM {customer}"


@query("registrations", ctes(**STATES, n=NEW.format(customer="customer")) + """
SELECT name, CAST(coalesce(max(version), 0) + 1 AS INT) AS version, coalesce(max(seq), 0) + 1 AS seq, 'None' AS stage,
       'Challenger' AS alias, n.run_id FROM n LEFT JOIN (SELECT name, version, seq FROM e) USING (name) GROUP BY name, n.run_id
""")
def registrations(spark, sf):
    return registry.registrations(_events(spark, sf), standins.derive(spark, sf, NEW))
