"""Raw tables to silver tables on the wave calendar, and silver tables to one checked gold panel."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.config import CATEGORICAL_FEATURES, ModelConfig, ProcessingConfig, gold_contract
from panelspark.operators import checks, columns, filters, joins, levels, member_features, sampling, waves
from panelspark.operators.waves import WaveCalendar
from panelspark.sources import tables
from panelspark.sources.layers import LayerNames

# Columns of the raw tables.
SNAPSHOT_COL = "eff_beg_dt"
LABEL_DATE_COL = "purchase_period_begin_timestamp"
LABEL_ID_COL = "customer_id_number"


@dataclass(frozen=True)
class RawTables:
    members: str = "members_monthly"
    attributes: str = "attributes"
    labels: str = "product_purchased"


def build_silver(raw: DataFrame, calendar: WaveCalendar, date_col: str = SNAPSHOT_COL,
                 source_id: str = ModelConfig.id_col, model: ModelConfig = ModelConfig(),
                 pinned: bool = True) -> DataFrame:
    """One raw table with plain names, trimmed id, wave and role; rows off the calendar dropped.

    In feature mode rows before the first wave cannot be a snapshot of any wave.
    """
    df = columns.normalise_names(raw)
    df = columns.to_date(df, date_col)
    if calendar.mode == "feature":
        df = filters.on_or_after(df, date_col, calendar.first)
    df = columns.normalise_id(df, source_id, model.id_col)
    return waves.snap_to_calendar(df, date_col, calendar, pinned)


def build_silver_labels(raw: DataFrame, calendar: WaveCalendar, settings: ProcessingConfig = ProcessingConfig(),
                        model: ModelConfig = ModelConfig(), pinned: bool = True) -> DataFrame:
    """The label table; negatives thinned out first where the settings ask for it."""
    df = build_silver(raw, calendar, LABEL_DATE_COL, LABEL_ID_COL, model, pinned)
    if not settings.perform_initial_downsampling:
        return df
    return sampling.down_sample_by_share(df, model.outcome_col, model.key, settings.non_response_ratio)


def derive_members(silver_members: DataFrame, settings: ProcessingConfig = ProcessingConfig(),
                   kept_levels: dict | None = None) -> DataFrame:
    """All derived features. ``kept_levels`` of the training panel may be passed in for serving."""
    df = member_features.derive_member_features(silver_members, settings)
    cats = list(CATEGORICAL_FEATURES)
    if kept_levels is None:
        kept_levels = levels.fit_levels(df, cats, settings.rare_level_min_pct)
    return levels.lump_levels(df, kept_levels, cats)


def build_gold(silver_members: DataFrame, silver_attributes: DataFrame, silver_labels: DataFrame | None,
               settings: ProcessingConfig = ProcessingConfig(), model: ModelConfig = ModelConfig(),
               kept_levels: dict | None = None, hot_keys: list[tuple] | None = None) -> DataFrame:
    """The panel: members with attributes, and in feature mode only labelled rows.

    Members keep rows without attributes. A row without a label would be dropped anyway, so the
    label join is an inner one. Both joins use the same keys and share one shuffle of the members.
    """
    serving = silver_labels is None
    members = derive_members(silver_members, settings, kept_levels)
    wanted = [c for c in model.features if c in silver_attributes.columns and c not in members.columns]
    rights = [(silver_attributes.select(*model.key, *wanted), "left")]
    if not serving:
        outcome = filters.labelled(silver_labels, model.outcome_col)
        rights.append((outcome.select(*model.key, model.outcome_col), "inner"))
    panel = joins.keyed_join(members, rights, model.key, hot_keys)
    gold = columns.gold_projection(panel, serving, model)
    return gold.transform(columns.decimals_to_double, [model.outcome_col]).transform(
        columns.integers_to_double, [model.outcome_col]
    )


def assert_valid(gold: DataFrame, serving: bool = False, model: ModelConfig = ModelConfig()) -> checks.CheckSummary:
    found = checks.validate(gold, gold_contract(serving, model))
    for name, passed in found._asdict().items():
        if not passed:
            raise AssertionError(f"gold validation failed: {name}")
    return found


def run_feature_build(spark: SparkSession, names: LayerNames, calendar: WaveCalendar,
                      raw: RawTables = RawTables(), settings: ProcessingConfig = ProcessingConfig(),
                      model: ModelConfig = ModelConfig(), fmt: str = "parquet",
                      kept_levels: dict | None = None) -> str:
    """Bronze tables to the gold table of one mode. Each layer is written before the next reads it.

    Returns the full name of the gold table.
    """
    serving = calendar.mode == "inference"
    bronze, silver, gold = (names.schema(layer) for layer in ("bronze", "silver", "gold"))
    sources = {"members": raw.members, "attributes": raw.attributes}
    for source, table in sources.items():
        df = build_silver(tables.read_table(spark, bronze, table), calendar, model=model)
        tables.overwrite_table(df, silver, names.silver_table(source, serving), names.path("silver"), fmt,
                               partition_by=[model.wave_col])
    if not serving:
        df = build_silver_labels(tables.read_table(spark, bronze, raw.labels), calendar, settings, model)
        tables.overwrite_table(df, silver, names.silver_table("labels"), names.path("silver"), fmt)

    def read(source):
        df = tables.read_table(spark, silver, names.silver_table(source, serving))
        return df.withColumn(model.wave_col, F.col(model.wave_col).cast("string"))

    members = read("members")
    hot = joins.find_hot(members, model.key, fraction=0.01, min_rows=1000)
    panel = build_gold(members, read("attributes"), None if serving else read("labels"),
                       settings, model, kept_levels, hot)
    if names.env == "test":
        assert_valid(panel, serving, model)
    tables.overwrite_table(panel, gold, names.gold_table(serving), names.path("gold"), fmt)
    return f"{gold}.{names.gold_table(serving)}"


def reprocess_labels(spark: SparkSession, names: LayerNames, calendar: WaveCalendar,
                     raw: RawTables = RawTables(), settings: ProcessingConfig = ProcessingConfig(),
                     model: ModelConfig = ModelConfig(), fmt: str = "parquet") -> str:
    """Outcome labels of a serving wave, once they are known, into a table of their own."""
    df = build_silver_labels(tables.read_table(spark, names.schema("bronze"), raw.labels), calendar, settings, model)
    target = names.silver_table("labels", serving=True)
    tables.overwrite_table(df, names.schema("silver"), target, names.path("silver"), fmt)
    return f"{names.schema('silver')}.{target}"
