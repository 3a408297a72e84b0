"""Individual features: encode, derive, impute."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohort_risk import config as C
from cohort_risk.functions import scalars as S
from cohort_risk.operators.ranks import exact_quantiles, value_counts, value_modes


def coerce(df: DataFrame, as_of_year: int) -> DataFrame:
    """Numeric columns to double; a missing or unparsable year becomes ``as_of_year``."""
    year = S.lenient_int(df, "year") if "year" in df.columns else S.null("int")
    return df.withColumns({
        **{c: S.lenient_double(df, c) for c in C.NUMERIC_COLUMNS if c in df.columns},
        "year": F.coalesce(year, F.lit(as_of_year)),
    })


def encode(df: DataFrame) -> DataFrame:
    """Category codes with a default for unknown and missing words."""
    out = {}
    for column, target, codes, default in [
        ("sex", "sex_enc", C.SEX_CODES, 2),
        ("smoking_status", "smoking_enc", C.SMOKING_CODES, 0),
        ("physical_activity", "activity_enc", C.ACTIVITY_CODES, 1),
        ("diabetes_status", "diabetes_enc", C.DIABETES_CODES, 0),
    ]:
        if column in df.columns:
            out[target] = S.lookup(S.folded(column), codes, default)
    if "family_history_cvd" in df.columns:
        known = F.col("family_history_cvd")
        if isinstance(df.schema["family_history_cvd"].dataType, T.BooleanType):
            out["family_history_cvd"] = S.truth(known)
        else:
            out["family_history_cvd"] = S.truth(S.lenient_double(df, "family_history_cvd") == 1)
    return df.withColumns(out)


def encode_target(df: DataFrame, clamp: bool = True) -> DataFrame:
    """Class of the reported risk level; unknown levels stay NULL.

    There are three class names, so "very high" is counted as "high" unless
    ``clamp`` is off.
    """
    if "cvd_risk_level" not in df.columns:
        return df
    code = S.lookup(S.folded("cvd_risk_level"), C.RISK_CODES)
    if clamp:
        code = F.when(code.isNotNull(), F.least(code, F.lit(len(C.CLASS_NAMES) - 1)))
    return df.withColumn(C.TARGET, code)


def derive(df: DataFrame) -> DataFrame:
    """Clinical scores from whichever measurements the table has."""
    has = set(df.columns)
    first = {}
    if {"systolic_bp", "diastolic_bp"} <= has:
        first["bp_pulse_pressure"] = F.col("systolic_bp") - F.col("diastolic_bp")
        first["bp_stage"] = S.bp_stage("systolic_bp", "diastolic_bp")
    if "bmi" in has:
        first["bmi_category_enc"] = S.bmi_category("bmi")
    if "fasting_glucose" in has:
        first["glucose_category_enc"] = S.glucose_category("fasting_glucose")
    if {"total_cholesterol", "hdl"} <= has:
        first["chol_hdl_ratio"] = F.try_divide(F.col("total_cholesterol"), F.col("hdl"))
    df = df.withColumns(first)
    if "bp_stage" in first:
        df = df.withColumn("bp_hypertension_flag", S.truth(F.col("bp_stage") >= 2))
    parts = [S.truth(cond) for column, cond in [
        ("abdominal_circ_cm", F.col("abdominal_circ_cm") > 94),
        ("bp_hypertension_flag", F.col("bp_hypertension_flag") == 1),
        ("glucose_category_enc", F.col("glucose_category_enc") >= 1),
        ("hdl", F.col("hdl") < 1.0),
        ("bmi_category_enc", F.col("bmi_category_enc") >= 3),
    ] if column in df.columns]
    if parts:
        df = df.withColumn("metabolic_syndrome_score", sum(parts[1:], parts[0]))
    return df


def prepare(df: DataFrame, as_of_year: int) -> DataFrame:
    return derive(encode(coerce(df, as_of_year)))


def imputer_stats(df: DataFrame,
                  medians: list[str] = C.MEDIAN_COLUMNS,
                  modes: list[str] = C.MODE_COLUMNS) -> DataFrame:
    """Fill value per column: ``(feature, stat, value)``; wholly null columns are left out.

    One pass turns the table into distinct values with counts; exact medians come
    from :func:`exact_quantiles`.
    """
    medians = [c for c in medians if c in df.columns]
    modes = [c for c in modes if c in df.columns]
    long = df.select(*[F.col(c).cast("double").alias(c) for c in medians + modes]).unpivot(
        [], medians + modes, "feature", "value")
    counts = value_counts(long, ["feature"])
    # no filter by feature before this point: both branches then share one shuffle
    both = exact_quantiles(counts, ["feature"], {"median": 0.5}).join(
        value_modes(counts, ["feature"]), "feature")
    is_mode = F.col("feature").isin(modes) if modes else F.lit(False)
    return both.select(
        "feature", F.when(is_mode, "mode").otherwise("median").alias("stat"),
        F.when(is_mode, F.col("mode")).otherwise(F.col("median")).alias("value"))


def stats_dict(stats: DataFrame) -> dict[str, float]:
    """Collect a stats table; it has one row per feature."""
    return {r["feature"]: r["value"] for r in stats.select("feature", "value").collect()}


def impute(df: DataFrame, fills: Mapping[str, float]) -> DataFrame:
    """Replace NULL by the fitted value; integer codes stay integers."""
    out = {}
    for c, value in fills.items():
        if c in df.columns:
            dtype = df.schema[c].dataType
            lit = F.lit(float(value))
            if isinstance(dtype, (T.IntegerType, T.LongType)) and float(value).is_integer():
                lit = F.lit(int(value)).cast(dtype)
            out[c] = F.coalesce(F.col(c), lit)
    return df.withColumns(out) if out else df


def add_age_band(df: DataFrame) -> DataFrame:
    if "age" not in df.columns:
        return df
    return df.withColumn("age_group_bin", S.age_band("age"))
