"""Patient records: registry CSV and device biometrics to canonical rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohort_risk import config as C
from cohort_risk import schemas
from cohort_risk.functions import scalars as S
from cohort_risk.sources.population import canonical

_NUMBERS = [
    "age", "weight_kg", "height_m", "bmi", "abdominal_circ_cm", "systolic_bp", "diastolic_bp",
    "total_cholesterol", "hdl", "estimated_ldl", "fasting_glucose", "cvd_risk_score",
]


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """Registry CSV as text columns, white space around the header names removed."""
    raw = spark.read.option("header", True).csv(path)
    return raw.toDF(*[c.strip() for c in raw.columns])


def registry_records(rows: DataFrame, row_key: str | None = None,
                     country: str = "BGD", region: str = "Jamalpur",
                     ingested_at: Column | None = None) -> DataFrame:
    """Registry rows with plausible blood pressure and body-mass index.

    The id comes from ``row_key``, a column that tells rows apart; without one it is a
    digest of the row. A position in the file would depend on how the file is split.
    """
    raw: Mapping[str, Column] = {
        field: S.first_present(rows, names) for field, names in C.REGISTRY_ALIASES.items()}
    if row_key:
        key = F.lpad(F.col(row_key).cast("string"), 5, "0")
        key = F.when(F.length(F.col(row_key).cast("string")) > 5,
                     F.col(row_key).cast("string")).otherwise(key)
    else:
        key = F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns])))
    columns = {
        "source": F.lit("mendeley_cair_cvd"),
        "record_type": F.lit("individual"),
        "patient_id": F.concat(F.lit("cair_"), key),
        "country_iso3": F.lit(country),
        "region": F.lit(region),
        "sex": S.normal_sex(F.coalesce(raw["sex"], F.lit(""))),
        "smoking_status": S.synonym(raw["smoking_status"], C.SMOKING_SYNONYMS),
        "diabetes_status": S.yes_no(raw["diabetes_status"]),
        "physical_activity": S.synonym(raw["physical_activity"], C.ACTIVITY_SYNONYMS),
        "family_history_cvd": S.yes_no_flag(raw["family_history_cvd"]),
        "bp_category": F.coalesce(raw["bp_category"], F.lit("")),
        "cvd_risk_level": F.lower(F.coalesce(raw["cvd_risk_level"], F.lit(""))),
        **{c: S.text_to_double(raw[c]) for c in _NUMBERS},
    }
    out = canonical(rows, schemas.INDIVIDUAL, columns, ingested_at)
    for c in C.REQUIRED_COLUMNS:
        out = out.filter(F.col(c).between(*C.CLINICAL_RANGES[c]))
    return out


def biometric_records(items: DataFrame, patient_id: str | None = None,
                      ingested_at: Column | None = None) -> DataFrame:
    """Device payload items; a 0 or missing reading falls through to the second field."""

    def either(first: str, second: str) -> Column:
        a = F.col(first)
        # a numeric zero falls through, as an empty text does
        usable = F.when((a != "") & F.coalesce(S.text_to_double(a) != 0, F.lit(True)), a)
        return S.text_to_double(F.coalesce(usable, F.col(second)))

    given = F.lit(patient_id) if patient_id else S.null("string")
    user = F.coalesce(given, F.nullif(F.col("user_id"), F.lit("")),
                      F.nullif(F.col("uid"), F.lit("")))
    return canonical(items, schemas.INDIVIDUAL, {
        "source": F.lit("validic"),
        "record_type": F.lit("individual"),
        "patient_id": user,
        "systolic_bp": either("systolic", "blood_pressure_systolic"),
        "diastolic_bp": either("diastolic", "blood_pressure_diastolic"),
        "weight_kg": S.text_to_double("weight"),
        "bmi": S.text_to_double("bmi"),
        "fasting_glucose": either("blood_glucose", "glucose"),
    }, ingested_at)


def biometric_items(payloads: DataFrame) -> DataFrame:
    """One row per element of ``biometrics[]``."""
    return payloads.select(F.inline("biometrics"))
