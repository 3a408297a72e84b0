"""Domain constants and tunable thresholds.

Everything in the "fixed values" block is data that decides results (names,
ranges, codes, cut points); operators take it as a default argument, so a caller
can pass other rules.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values: column groups and rules, equal to the specification ---------

REQUIRED_COLUMNS = ["systolic_bp", "diastolic_bp", "bmi"]

# inclusive [low, high] per measurement
CLINICAL_RANGES = {
    "systolic_bp": (60.0, 300.0),
    "diastolic_bp": (30.0, 200.0),
    "bmi": (10.0, 80.0),
    "age": (0.0, 120.0),
    "fasting_glucose": (2.0, 40.0),
    "total_cholesterol": (1.0, 20.0),
    "hdl": (0.1, 5.0),
    "estimated_ldl": (0.1, 15.0),
    "weight_kg": (2.0, 300.0),
    "height_m": (0.3, 2.5),
    "abdominal_circ_cm": (40.0, 200.0),
}

NUMERIC_COLUMNS = [
    "age", "weight_kg", "height_m", "bmi", "abdominal_circ_cm",
    "systolic_bp", "diastolic_bp", "total_cholesterol", "hdl",
    "estimated_ldl", "fasting_glucose", "cvd_risk_score",
]
MEDIAN_COLUMNS = NUMERIC_COLUMNS + [
    "bp_pulse_pressure", "chol_hdl_ratio", "metabolic_syndrome_score", "bp_stage",
]
MODE_COLUMNS = [
    "sex_enc", "smoking_enc", "activity_enc", "diabetes_enc",
    "bmi_category_enc", "glucose_category_enc", "bp_hypertension_flag",
]
ID_COLUMNS = ["patient_id", "source", "country_iso3", "year"]
INDIVIDUAL_DEDUP_KEYS = ["patient_id", "systolic_bp", "diastolic_bp", "bmi"]

SEX_CODES = {"male": 0, "m": 0, "female": 1, "f": 1, "both": 2, "other": 2}
SMOKING_CODES = {"non-smoker": 0, "former": 1, "smoker": 2}
ACTIVITY_CODES = {"low": 0, "moderate": 1, "high": 2}
DIABETES_CODES = {"no": 0, "yes": 1}
RISK_CODES = {"low": 0, "moderate": 1, "high": 2, "very high": 3}

AGE_EDGES = [0, 15, 30, 45, 60, 75, 120]
AGE_LABELS = ["0-14", "15-29", "30-44", "45-59", "60-74", "75+"]
AGE_RISK_MULTIPLIER = {
    "0-14": 0.05, "15-29": 0.20, "30-44": 1.00, "45-59": 2.80,
    "60-74": 5.50, "75+": 8.20, "All ages": 1.00,
}

SOURCE_PRIORITY = {
    "who_gho": 1, "ihme_gbd": 2, "worldbank": 3, "cdc_cdi": 4, "cdc_brfss": 5,
}
SOURCE_PRIORITY_DEFAULT = 99

INDICATOR_FEATURES = {
    "NCD_HYP_PREVALENCE_A": "pop_bp_prevalence",
    "NCD_GLUC_04": "pop_diabetes_prevalence",
    "NCD_BMI_30C": "pop_obesity_prevalence",
    "NCD_CHOL_MEANC": "pop_mean_cholesterol",
    "NCD_PAC_PREVALENCE": "pop_physical_inactivity",
    "M_Est_smk_curr_std": "pop_tobacco_prevalence",
    "SH.STA.DIAB.ZS": "wb_diabetes_prevalence",
    "SH.DTH.NCOM.ZS": "wb_ncd_death_share",
    "SH.XPD.CHEX.GD.ZS": "wb_health_expenditure_gdp",
    "SP.URB.TOTL.IN.ZS": "wb_urban_pct",
    "SH.STA.OWAD.ZS": "wb_obesity_prevalence",
    "pop_bp_prevalence": "pop_bp_prevalence",
    "wb_urban_pct": "wb_urban_pct",
}
POPULATION_FEATURES = sorted(set(INDICATOR_FEATURES.values()))
POPULATION_PREFIXES = ("pop_", "wb_", "gbd_", "cdc_")
FILL_PREFIXES = ("pop_", "wb_", "gbd_", "cdc_", "pm", "no2", "o3", "env_")
BURDEN_PREFIXES = ("pop_", "wb_obesity", "wb_diabetes")
POPULATION_DEDUP_KEYS = [
    "source", "country_iso3", "year", "indicator_code", "sex", "age_group",
]
# also tell apart rows of sources without a country or indicator code
POPULATION_DEDUP_KEYS_WIDE = POPULATION_DEDUP_KEYS + [
    "country_name", "region", "indicator_name", "metric_type", "unit",
]
ENVIRONMENT_KEYS = ["location_id", "parameter", "measured_at"]
ENVIRONMENT_PARAMETERS = ["pm25", "pm10", "no2", "o3"]
ENVIRONMENT_RENAMES = {"pm25": "pm25_latest", "pm10": "pm10_latest", "no2": "no2_latest"}
YEAR_RANGE = (1990, 2024)
TIER2_SEXES = ["Both", "Both sexes"]
TIER2_BANDS = ["All ages", "nan"]

BRANCH_A_FEATURES = [
    "age", "sex_enc",
    "systolic_bp", "diastolic_bp", "bp_pulse_pressure",
    "bmi", "bmi_category_enc",
    "fasting_glucose", "glucose_category_enc",
    "total_cholesterol", "hdl", "estimated_ldl", "chol_hdl_ratio",
    "abdominal_circ_cm",
    "smoking_enc", "diabetes_enc", "activity_enc",
    "family_history_cvd", "bp_hypertension_flag",
    "metabolic_syndrome_score",
]
BRANCH_B_FEATURES = [
    "age", "sex_enc",
    "smoking_enc", "activity_enc",
    "bmi", "abdominal_circ_cm",
    "pop_bp_prevalence", "wb_urban_pct",
    "age_group_risk_multiplier",
]
BRANCH_LABELS = {
    "A": "Branch A — Bodily Similarity",
    "B": "Branch B — Lifestyle/Environment",
}
TARGET = "target"
CLASS_NAMES = ["low", "moderate", "high"]
CV_FOLDS = 5

ENSEMBLE_WEIGHTS = {"a": 0.60, "b": 0.40}
SIGNAL_MARGIN = 0.15
# (low, high, level, label, message), low <= score < high
WARNING_GATES = [
    (0.00, 0.25, 1, "low", "No immediate concern. Routine monitoring advised."),
    (0.25, 0.45, 2, "moderate", "Elevated risk. Lifestyle review recommended."),
    (0.45, 0.65, 3, "high", "High risk. Clinical referral recommended."),
    (0.65, 1.01, 4, "critical", "Critical risk. Immediate clinical intervention advised."),
]
RESULT_COLUMNS = [
    "patient_id", "country_iso3", "age_group_bin", "sex",
    "prob_low", "prob_moderate", "prob_high",
    "ensemble_risk_score", "predicted_class", "predicted_label",
    "warning_level", "warning_label", "warning_message",
    "branch_a_score", "branch_b_score", "signal_type", "scored_at",
]

MONITORED_FEATURES = [
    "systolic_bp", "diastolic_bp", "bmi", "fasting_glucose",
    "total_cholesterol", "hdl", "age", "metabolic_syndrome_score",
    "pop_bp_prevalence", "wb_urban_pct",
]
HEATMAP_INDICATORS = [
    "pop_bp_prevalence", "pop_diabetes_prevalence",
    "pop_obesity_prevalence", "wb_urban_pct",
]
CLINICAL_GROUPS = {
    "blood_pressure": ["systolic_bp", "diastolic_bp", "bp_pulse_pressure",
                       "bp_stage", "bp_hypertension_flag", "bp_category_enc"],
    "metabolic": ["bmi", "bmi_category_enc", "abdominal_circ_cm",
                  "metabolic_syndrome_score", "weight_kg"],
    "glucose": ["fasting_glucose", "glucose_category_enc", "diabetes_enc"],
    "lipids": ["total_cholesterol", "hdl", "estimated_ldl", "chol_hdl_ratio"],
    "lifestyle": ["smoking_enc", "activity_enc", "family_history_cvd"],
    "demographics": ["age", "sex_enc", "age_group_risk_multiplier"],
    "population": ["pop_bp_prevalence", "pop_diabetes_prevalence",
                   "pop_obesity_prevalence", "pop_physical_inactivity",
                   "pop_tobacco_prevalence", "wb_urban_pct",
                   "wb_health_expenditure_gdp", "wb_diabetes_prevalence"],
    "environment": ["pm25_latest", "pm10_latest", "no2_latest", "o3_latest"],
}

WHO_INDICATORS = {
    "BP_PREVALENCE": "NCD_HYP_PREVALENCE_A",
    "DIABETES_PREVALENCE": "NCD_GLUC_04",
    "OBESITY_BMI": "NCD_BMI_30C",
    "CHOLESTEROL": "NCD_CHOL_MEANC",
    "PHYSICAL_INACTIVITY": "NCD_PAC_PREVALENCE",
    "TOBACCO_USE": "M_Est_smk_curr_std",
}
WHO_SEX = {"BTSX": "Both", "MLE": "Male", "FMLE": "Female"}
WORLDBANK_INDICATORS = {
    "DIABETES_PREVALENCE": "SH.STA.DIAB.ZS",
    "HYPERTENSION_MORT": "SH.DTH.NCOM.ZS",
    "HEALTH_EXPENDITURE": "SH.XPD.CHEX.GD.ZS",
    "URBAN_POPULATION": "SP.URB.TOTL.IN.ZS",
    "OBESITY_PREVALENCE": "SH.STA.OWAD.ZS",
}
WORLDBANK_COUNTRIES = [
    "BGD", "CHN", "IDN", "KHM", "LAO", "MMR",
    "MNG", "MYS", "PHL", "THA", "TLS", "VNM",
]
# ISO 3166 alpha-2 codes of the countries above, for readings keyed by alpha-2
ISO2_TO_ISO3 = {
    "BD": "BGD", "CN": "CHN", "ID": "IDN", "KH": "KHM", "LA": "LAO", "MM": "MMR",
    "MN": "MNG", "MY": "MYS", "PH": "PHL", "TH": "THA", "TL": "TLS", "VN": "VNM",
    "US": "USA",
}
CDI_TOPICS = [
    "Cardiovascular Disease", "Diabetes", "Obesity",
    "Chronic Obstructive Pulmonary Disease", "Chronic Kidney Disease",
]
BRFSS_CLASSES = [
    "Chronic Health Indicators", "Tobacco Use", "Physical Activity",
    "Overweight and Obesity", "Diabetes",
]
GBD_CAUSES = [
    "Ischemic heart disease", "Stroke", "Diabetes mellitus type 2",
    "Chronic obstructive pulmonary disease", "Hypertensive heart disease",
    "Chronic kidney disease",
]
GBD_REQUIRED = [
    "measure_name", "location_name", "sex_name", "age_name", "cause_name",
    "metric_name", "year", "val", "upper", "lower",
]
SMOKING_SYNONYMS = {
    "yes": "smoker", "1": "smoker", "current": "smoker",
    "no": "non-smoker", "0": "non-smoker", "never": "non-smoker", "former": "former",
}
ACTIVITY_SYNONYMS = {
    "low": "low", "1": "low", "inactive": "low",
    "moderate": "moderate", "2": "moderate",
    "high": "high", "3": "high", "very active": "high",
}
# canonical field -> accepted registry headers, first non-null wins
REGISTRY_ALIASES = {
    "age": ["Age", "age"],
    "sex": ["Sex", "sex", "Gender", "gender"],
    "weight_kg": ["Weight (kg)", "Weight"],
    "height_m": ["Height (m)", "Height_m"],
    "bmi": ["BMI", "bmi"],
    "abdominal_circ_cm": ["Abdominal Circumference (cm)"],
    "systolic_bp": ["Systolic BP", "Systolic"],
    "diastolic_bp": ["Diastolic BP", "Diastolic"],
    "total_cholesterol": ["Total Cholesterol"],
    "hdl": ["HDL", "hdl"],
    "estimated_ldl": ["Estimated LDL"],
    "fasting_glucose": ["Fasting Blood Sugar", "FBS"],
    "smoking_status": ["Smoking Status", "Smoking"],
    "diabetes_status": ["Diabetes Status", "Diabetes"],
    "physical_activity": ["Physical Activity Level"],
    "family_history_cvd": ["Family History of CVD"],
    "bp_category": ["Blood Pressure Category"],
    "cvd_risk_level": ["CVD Risk Level"],
    "cvd_risk_score": ["CVD Risk Score"],
}
FEMALE_WORDS = ["f", "female", "women", "woman"]
MALE_WORDS = ["m", "male", "men", "man"]
YES_WORDS = ["yes", "1", "true", "positive"]
NO_WORDS = ["no", "0", "false", "negative"]

# --- end of fixed values --------------------------------------------------------


@dataclass(frozen=True)
class DriftRules:
    """Thresholds of the drift status and of the retraining decision."""

    psi_warn: float = 0.10
    psi_alert: float = 0.25
    ks_pvalue: float = 0.05
    f1_drop: float = 0.10
    max_warn_features: int = 3
    min_baseline: int = 10
    min_current: int = 20
    min_edges: int = 3
    divergence_warn: float = 0.30


@dataclass(frozen=True)
class ForestParams:
    """Random-forest settings; the defaults are the production size."""

    num_trees: int = 300
    max_depth: int = 12
    min_instances: int = 2
    subset: str = "sqrt"
    seed: int = 42


@dataclass(frozen=True)
class KernelParams:
    """Random-feature approximation of an RBF kernel classifier."""

    n_components: int = 256
    reg: float = 1e-3
    max_iter: int = 100
    seed: int = 42
