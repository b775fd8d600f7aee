"""The feature rules applied to a members table. Lower-case column names throughout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.config import ProcessingConfig
from panelspark.functions import features as rules

DEFAULTS = ProcessingConfig()


def add_age_features(df: DataFrame, impute_custage: int = DEFAULTS.impute_custage,
                     max_age: int = DEFAULTS.max_age) -> DataFrame:
    """Imputed ``custage``, ``age_cust`` within [0, max_age], generation as ``age_segment``."""
    age = rules.imputed_age(F.col("custage"), F.col("embrtyp"), impute_custage, DEFAULTS.impute_juvenile_age)
    return df.withColumns({
        "custage": age,
        "age_cust": rules.clamped(age, 0, max_age),
        "age_segment": rules.generation(F.col("birthdte")),
    })


def add_retirement_age(df: DataFrame) -> DataFrame:
    return df.withColumn("socsec_full_retire_age", rules.retirement_age(F.col("birthdte")))


def add_share_features(df: DataFrame, face_mode: str = "reference", null_policy: str = "cap") -> DataFrame:
    """Cash-value share of premium and of face amount, both in [0, 1]."""
    premium = F.col("tradprem") + F.col("ulprem") + F.col("vulprem")
    face = rules.face_amount(F.col("tradsa"), F.col("ulsa"), F.col("vulsa"), face_mode)
    return df.withColumns({
        "pct_cvlprem_totprem": rules.capped_share(premium, F.col("totprem"), null_policy),
        "pct_cvlsa_totsa": rules.capped_share(face, F.col("totsa"), null_policy),
    })


def add_household_features(df: DataFrame, max_assets: int = DEFAULTS.max_assets,
                           null_policy: str = "cap") -> DataFrame:
    """``hh_aua`` and ``hh_own_wrap`` flags; ``hhaua`` capped after the flag was taken."""
    return df.withColumns({
        "hh_aua": rules.positive_flag(F.col("hhaua")),
        "hhaua": rules.capped(F.col("hhaua"), max_assets, null_policy),
        "hh_own_wrap": rules.positive_flag(F.col("hhwrapown"), null_is_zero=True),
    })


def _tenure(impute_yearsmember: int, max_age: int):
    return rules.imputed_tenure(F.col("yearsmember"), F.col("yrspurch"), impute_yearsmember, max_age)


def impute_tenure(df: DataFrame, impute_yearsmember: int = DEFAULTS.impute_yearsmember,
                  max_age: int = DEFAULTS.max_age) -> DataFrame:
    return df.withColumn("yearsmember", _tenure(impute_yearsmember, max_age))


def add_assets_per_tenure_year(df: DataFrame) -> DataFrame:
    value = rules.assets_per_tenure_year(F.col("propassets"), F.col("yearsmember"))
    return df.withColumn("tot_aum_per_yrmbr", value)


def add_tenure_features(df: DataFrame, impute_yearsmember: int = DEFAULTS.impute_yearsmember,
                        max_age: int = DEFAULTS.max_age, as_of: str = "eff_beg_dt") -> DataFrame:
    """Imputed ``yearsmember``, exact ``mbr_yrs`` and ``tot_aum_per_yrmbr``."""
    years = _tenure(impute_yearsmember, max_age)
    return df.withColumns({
        "yearsmember": years,
        "mbr_yrs": rules.exact_tenure(F.col(as_of), F.col("mbrdt"), years),
        "tot_aum_per_yrmbr": rules.assets_per_tenure_year(F.col("propassets"), years),
    })


def drop_unknown_levels(df: DataFrame) -> DataFrame:
    """The spellings of 'unknown' become NULL."""
    return df.withColumns({
        "segment": rules.null_if(F.col("segment"), "AGE UNKNOWN"),
        "age_segment": rules.null_if(F.col("age_segment"), "UNKNOWN"),
    })


def derive_member_features(df: DataFrame, settings: ProcessingConfig = DEFAULTS) -> DataFrame:
    """All feature rules, short of the lumping of rare levels."""
    return (
        df.transform(add_age_features, settings.impute_custage, settings.max_age)
        .transform(add_retirement_age)
        .transform(add_share_features)
        .transform(add_household_features, settings.max_assets)
        .transform(add_tenure_features, settings.impute_yearsmember, settings.max_age)
        .transform(drop_unknown_levels)
    )
