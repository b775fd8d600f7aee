"""Settings that change results, as frozen dataclasses with their default values."""

from __future__ import annotations

from dataclasses import dataclass, field

# The columns a gold panel carries, in order.
SELECTED_FEATURES = (
    "segment",
    "w_hlth_ins_direct_pay_indx",
    "hhetrs_assets",
    "age_segment",
    "w_ins_medsup_buyer_indx",
    "hh_aua",
    "w_hlth_mng_wearable_indx",
    "hhsa",
    "hhprem",
    "etrs_assets",
    "totprem",
    "totsa",
    "w_short_term_loan_indx",
    "ulprem",
    "hhyrspurch",
    "w_aggrgt_zip4_home_value",
    "hhpropassets",
    "w_census_pct_white_collar",
    "pct_cvlsa_totsa",
    "w_census_median_hh_buying_inc",
    "w_census_median_hh_inc",
    "w_census_median_home_value",
    "yearsmember",
    "propassets",
    "netasset",
    "tot_aum_per_yrmbr",
)

CATEGORICAL_FEATURES = ("segment", "age_segment")
NUMERIC_FEATURES = tuple(f for f in SELECTED_FEATURES if f not in CATEGORICAL_FEATURES)

# The classifiers and oversamplers a search may draw from.
MODELS_TO_TRY = (
    "GaussianNB",
    "DecisionTreeClassifier",
    "LogisticRegression",
    "RandomForestClassifier",
    "XGBClassifier",
    "LGBMClassifier",
)
SAMPLERS_TO_TRY = ("SMOTE", "BorderlineSMOTE", "ADASYN")


@dataclass(frozen=True)
class ProcessingConfig:
    impute_custage: int = 40
    impute_juvenile_age: int = 10
    max_age: int = 99
    max_assets: int = 1_000_000
    impute_yearsmember: int = 25
    non_response_ratio: int = 4
    perform_initial_downsampling: bool = False
    rare_level_min_pct: float = 3.0
    under_sampling_ratio: float = 0.5
    over_sampling_ratio: float = 0.1
    cadence_tolerance_days: int = 5


@dataclass(frozen=True)
class ModelConfig:
    name: str = "propensity"
    id_col: str = "cifidnbr"
    outcome_col: str = "long_term_care_responder"
    wave_col: str = "adjusted_effective_date"
    role_col: str = "set_type"
    features: tuple[str, ...] = SELECTED_FEATURES
    models_to_try: tuple[str, ...] = MODELS_TO_TRY
    samplers_to_try: tuple[str, ...] = SAMPLERS_TO_TRY
    random_state: int = 42
    parallelism: int = 10
    n_folds: int = 2
    n_iter: int = 100
    use_resampling: bool = True
    calibration_size: float = 0.5
    perform_calibration: bool = True
    calibration_method: str = "sigmoid"
    learning_curves: bool = True
    shap_values: bool = True
    shap_threshold: float = 5.0
    select_from_latest_runs: bool = True
    min_test_roc_auc: float = 0.7
    min_test_auprc_lift: float = 2.0

    @property
    def key(self) -> list[str]:
        return [self.id_col, self.wave_col]


# The contract a gold panel is checked against.
GOLD_NUMERIC_RANGES = {
    "w_hlth_ins_direct_pay_indx": (0, 9),
    "w_ins_medsup_buyer_indx": (0, 9),
    "hh_aua": (0, 1),
    "w_hlth_mng_wearable_indx": (0, 9),
    "w_short_term_loan_indx": (0, 9),
    "w_census_pct_white_collar": (0, 100),
    "pct_cvlsa_totsa": (0, 1),
    "yearsmember": (0, 100),
}
GOLD_SEGMENTS = (
    "MIDDLE MARKET PRERETIRED",
    "Others",
    "INSUFFICIENT INCOME",
    "MIDDLE MARKET RETIRED COUPLES",
    "AFFLUENT FAMILIES",
    "MIDDLE MARKET FAMILIES",
    "MIDDLE MARKET RETIRED SINGLES",
    "AFFLUENT PRERETIRED",
    "AFFLUENT RETIRED SINGLES",
    "MIDDLE MARKET SINGLES AND COUP",
    "AFFLUENT RETIRED COUPLES",
    None,
)
GOLD_AGE_SEGMENTS = (
    "E LeadBoomers",
    "B Millennial",
    "D TailBoomers",
    "F Seniors",
    "A GenZ",
    "C GenX",
    None,
)


@dataclass(frozen=True)
class Contract:
    """What a table has to look like: column types, non-null columns, ranges, allowed values."""

    types: dict[str, str] = field(default_factory=dict)
    not_null: tuple[str, ...] = ()
    ranges: dict[str, tuple[float, float]] = field(default_factory=dict)
    allowed: dict[str, tuple] = field(default_factory=dict)
    unique_key: tuple[str, ...] = ()


def gold_contract(serving: bool = False, model: ModelConfig = ModelConfig()) -> Contract:
    """The contract of a training panel, or of a serving panel (no outcome, no role)."""
    types = {model.id_col: "string"}
    types |= {f: "string" if f in CATEGORICAL_FEATURES else "double" for f in model.features}
    ranges = dict(GOLD_NUMERIC_RANGES)
    allowed = {"segment": GOLD_SEGMENTS, "age_segment": GOLD_AGE_SEGMENTS}
    if serving:
        types[model.wave_col] = "string"
        return Contract(types=types, ranges=ranges, allowed=allowed)
    types |= {model.outcome_col: "int", model.wave_col: "string", model.role_col: "string"}
    ranges[model.outcome_col] = (0, 1)
    allowed[model.role_col] = ("train", "test")
    return Contract(types=types, not_null=(model.outcome_col,), ranges=ranges, allowed=allowed)
