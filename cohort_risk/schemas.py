"""Canonical table schemas. Column comments travel with the Parquet metadata."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType, str]) -> T.StructType:
    return T.StructType(
        [T.StructField(name, dtype, True, {"comment": text}) for name, dtype, text in fields]
    )


S, D, I, L = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType()
B, TS = T.BooleanType(), T.TimestampType()

INDIVIDUAL = _struct(
    ("source", S, "origin of the record"),
    ("record_type", S, "always individual"),
    ("patient_id", S, "pseudonymous patient key"),
    ("age", D, "years"),
    ("sex", S, "Male, Female or Both"),
    ("country_iso3", S, "ISO 3166 alpha-3"),
    ("region", S, "sub-national region"),
    ("systolic_bp", D, "mmHg"),
    ("diastolic_bp", D, "mmHg"),
    ("bmi", D, "kg/m2"),
    ("weight_kg", D, "kg"),
    ("height_m", D, "m"),
    ("abdominal_circ_cm", D, "cm"),
    ("fasting_glucose", D, "mmol/L"),
    ("total_cholesterol", D, "mmol/L"),
    ("hdl", D, "mmol/L"),
    ("estimated_ldl", D, "mmol/L"),
    ("smoking_status", S, "smoker, former, non-smoker"),
    ("diabetes_status", S, "yes or no"),
    ("physical_activity", S, "low, moderate, high"),
    ("family_history_cvd", B, "family history of cardiovascular disease"),
    ("bp_category", S, "blood pressure category as reported"),
    ("cvd_risk_level", S, "reported risk level, training target"),
    ("cvd_risk_score", D, "reported risk score"),
    ("ingested_at", TS, "load time, UTC"),
)

POPULATION = _struct(
    ("source", S, "origin of the record"),
    ("record_type", S, "always population"),
    ("country_iso3", S, "ISO 3166 alpha-3"),
    ("country_name", S, "country name"),
    ("region", S, "state or location"),
    ("year", I, "reference year"),
    ("age_group", S, "age group as reported"),
    ("sex", S, "Male, Female or Both"),
    ("indicator_code", S, "publisher code"),
    ("indicator_name", S, "publisher name"),
    ("feature_name", S, "feature the indicator feeds"),
    ("metric_type", S, "prevalence, deaths, ..."),
    ("value", D, "indicator value"),
    ("lower_ci", D, "lower confidence limit"),
    ("upper_ci", D, "upper confidence limit"),
    ("unit", S, "unit of value"),
    ("ingested_at", TS, "load time, UTC"),
)

ENVIRONMENT = _struct(
    ("source", S, "origin of the record"),
    ("record_type", S, "always environment"),
    ("location_id", S, "station"),
    ("city", S, "station name"),
    ("country_iso3", S, "ISO 3166 alpha-3"),
    ("latitude", D, "degrees"),
    ("longitude", D, "degrees"),
    ("parameter", S, "pm25, pm10, no2, o3"),
    ("value", D, "reading"),
    ("unit", S, "unit of value"),
    ("measured_at", TS, "time of reading, UTC"),
    ("ingested_at", TS, "load time, UTC"),
)

SCORED = _struct(
    ("patient_id", S, "pseudonymous patient key"),
    ("country_iso3", S, "ISO 3166 alpha-3"),
    ("age_group_bin", S, "age band"),
    ("sex", S, "sex as recorded"),
    ("prob_low", D, "ensemble probability of class low"),
    ("prob_moderate", D, "ensemble probability of class moderate"),
    ("prob_high", D, "ensemble probability of class high"),
    ("ensemble_risk_score", D, "probability of class high"),
    ("predicted_class", I, "0 low, 1 moderate, 2 high"),
    ("predicted_label", S, "name of the predicted class"),
    ("warning_level", I, "1 to 4"),
    ("warning_label", S, "low, moderate, high, critical"),
    ("warning_message", S, "advice"),
    ("branch_a_score", D, "branch A probability of class high"),
    ("branch_b_score", D, "branch B probability of class high"),
    ("signal_type", S, "both, current_disease, future_risk"),
    ("scored_at", TS, "scoring time, UTC"),
)

# --- landed payloads --------------------------------------------------------------

# Values arrive as numbers or strings depending on the publisher; a string field
# accepts both, and the lenient casts do the rest.
WHO_PAYLOAD = T.StructType().add("value", T.ArrayType(
    T.StructType().add("SpatialDim", S).add("SpatialDimType", S).add("TimeDim", S)
    .add("Dim1", S).add("Dim2", S).add("NumericValue", S).add("Low", S).add("High", S)))

CDI_ROW = T.StructType()
for _name in ["topic", "yearstart", "yearend", "locationdesc", "stratificationcategory1",
              "stratification1", "questionid", "question", "datavaluetype", "datavalue",
              "lowconfidencelimit", "highconfidencelimit"]:
    CDI_ROW = CDI_ROW.add(_name, S)

BRFSS_ROW = T.StructType()
for _name in ["class", "year", "locationdesc", "break_out_category", "break_out", "questionid",
              "question", "data_value_type", "data_value", "confidence_limit_low",
              "confidence_limit_high"]:
    BRFSS_ROW = BRFSS_ROW.add(_name, S)

WORLDBANK_ROWS = T.ArrayType(
    T.StructType().add("countryiso3code", S)
    .add("country", T.StructType().add("id", S).add("value", S))
    .add("date", S).add("value", S))

AIR_PAYLOAD = T.StructType().add("results", T.ArrayType(
    T.StructType().add("locationId", S).add("location", S)
    .add("coordinates", T.StructType().add("latitude", S).add("longitude", S))
    .add("parameter", S).add("value", S).add("unit", S)
    .add("date", T.StructType().add("utc", S))))

BIOMETRIC_ITEM = T.StructType()
for _name in ["user_id", "uid", "systolic", "blood_pressure_systolic", "diastolic",
              "blood_pressure_diastolic", "weight", "bmi", "blood_glucose", "glucose"]:
    BIOMETRIC_ITEM = BIOMETRIC_ITEM.add(_name, S)
BIOMETRIC_PAYLOAD = T.StructType().add("biometrics", T.ArrayType(BIOMETRIC_ITEM))
