"""Building blocks of the comparison SQL."""

from __future__ import annotations

from collections.abc import Mapping

from cohort_risk import config as C


def rnd(expr: str, digits: int) -> str:
    """Decimal half-up rounding of a double, as Spark's ``round`` does it."""
    return (f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)")


def fold(c: str) -> str:
    return f"lower(trim({c}))"


def case_map(c: str, mapping: Mapping, default: str = "NULL") -> str:
    def lit(x):
        return f"'{x}'" if isinstance(x, str) else str(x)

    whens = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in mapping.items())
    return f"(CASE {c} {whens} ELSE {default} END)"


def truth(cond: str) -> str:
    return f"CAST(coalesce({cond}, FALSE) AS INT)"


def with_ctes(ctes: Mapping[str, str], final: str) -> str:
    body = ",\n".join(f"{name} AS ({sql})" for name, sql in ctes.items())
    return f"WITH {body}\n{final}"


REASONS = {
    **{f"null_{c}": f"{c} IS NULL" for c in C.REQUIRED_COLUMNS},
    **{f"range_{c}": f"coalesce({c} < {lo} OR {c} > {hi}, FALSE)"
       for c, (lo, hi) in C.CLINICAL_RANGES.items()},
}
REJECT = "concat_ws('; ', " + ", ".join(
    f"CASE WHEN {cond} THEN '{name}' END" for name, cond in REASONS.items()) + ")"

DEDUPED = ("SELECT * FROM ind QUALIFY row_number() OVER (PARTITION BY "
           + ", ".join(C.INDIVIDUAL_DEDUP_KEYS) + " ORDER BY seq) = 1")
TAGGED = f"SELECT *, {REJECT} AS _reject FROM deduped"
CLEAN = "SELECT * EXCLUDE (_reject) FROM tagged WHERE _reject = ''"


def validated(individual: str) -> dict[str, str]:
    return {"ind": individual, "deduped": DEDUPED, "tagged": TAGGED, "clean": CLEAN}


def prepared(as_of_year: int, source: str = "clean") -> dict[str, str]:
    """Coerce, encode and derive, in three steps."""
    coded = f"""SELECT * REPLACE (coalesce(year, {as_of_year}) AS year,
        {truth('family_history_cvd')} AS family_history_cvd),
      {case_map(fold('sex'), C.SEX_CODES, '2')} AS sex_enc,
      {case_map(fold('smoking_status'), C.SMOKING_CODES, '0')} AS smoking_enc,
      {case_map(fold('physical_activity'), C.ACTIVITY_CODES, '1')} AS activity_enc,
      {case_map(fold('diabetes_status'), C.DIABETES_CODES, '0')} AS diabetes_enc,
      systolic_bp - diastolic_bp AS bp_pulse_pressure,
      CASE WHEN systolic_bp IS NULL OR diastolic_bp IS NULL THEN NULL
        WHEN systolic_bp >= 140 OR diastolic_bp >= 90 THEN 3
        WHEN systolic_bp >= 130 OR diastolic_bp >= 80 THEN 2
        WHEN systolic_bp >= 120 THEN 1 ELSE 0 END AS bp_stage,
      CASE WHEN bmi IS NULL THEN NULL WHEN bmi < 18.5 THEN 0 WHEN bmi < 25 THEN 1
        WHEN bmi < 30 THEN 2 WHEN bmi < 35 THEN 3 ELSE 4 END AS bmi_category_enc,
      CASE WHEN fasting_glucose IS NULL THEN NULL WHEN fasting_glucose < 5.6 THEN 0
        WHEN fasting_glucose < 7.0 THEN 1 ELSE 2 END AS glucose_category_enc,
      total_cholesterol / nullif(hdl, 0) AS chol_hdl_ratio
      FROM {source}"""
    flagged = f"SELECT *, {truth('bp_stage >= 2')} AS bp_hypertension_flag FROM coded"
    derived = f"""SELECT *, {truth('abdominal_circ_cm > 94')} + bp_hypertension_flag
      + {truth('glucose_category_enc >= 1')} + {truth('hdl < 1.0')}
      + {truth('bmi_category_enc >= 3')} AS metabolic_syndrome_score FROM flagged"""
    return {"coded": coded, "flagged": flagged, "derived": derived}


def imputer(source: str = "derived") -> str:
    parts = []
    for c in C.MEDIAN_COLUMNS:
        parts.append(f"SELECT '{c}' AS feature, 'median' AS stat, "
                     f"quantile_cont(CAST({c} AS DOUBLE), 0.5) AS value FROM {source}")
    for c in C.MODE_COLUMNS:
        parts.append(f"SELECT '{c}', 'mode', CAST({c} AS DOUBLE) FROM (SELECT {c}, count(*) AS n "
                     f"FROM {source} WHERE {c} IS NOT NULL GROUP BY {c} "
                     f"ORDER BY n DESC, {c} LIMIT 1)")
    return ("SELECT * FROM (" + " UNION ALL ".join(f"({p})" for p in parts)
            + ") WHERE value IS NOT NULL")


def imputed(source: str = "derived", stats: str = "stats") -> str:
    columns = []
    for c in C.MEDIAN_COLUMNS + C.MODE_COLUMNS:
        fill = f"(SELECT value FROM {stats} WHERE feature = '{c}')"
        columns.append(f"coalesce({c}, {fill}) AS {c}")
    return f"SELECT * REPLACE ({', '.join(columns)}) FROM {source}"


def band(c: str, edges=C.AGE_EDGES, labels=C.AGE_LABELS) -> str:
    whens = " ".join(f"WHEN {c} < {hi} THEN '{label}'" for hi, label in zip(edges[1:], labels))
    return f"(CASE WHEN {c} IS NULL OR {c} < {edges[0]} THEN 'nan' {whens} ELSE 'nan' END)"


def target(c: str = "cvd_risk_level") -> str:
    return case_map(fold(c), {**C.RISK_CODES, "very high": 2})


AGE_TEXT_BAND = """(CASE WHEN age_group IS NULL OR lower(trim(age_group)) IN ('all ages','all','total','')
  OR nullif(regexp_extract(age_group, '([0-9]+)', 1), '') IS NULL THEN 'All ages'
  ELSE (CASE WHEN n < 15 THEN '0-14' WHEN n < 30 THEN '15-29' WHEN n < 45 THEN '30-44'
    WHEN n < 60 THEN '45-59' WHEN n < 75 THEN '60-74' ELSE '75+' END) END)"""
AGE_NUMBER = "TRY_CAST(nullif(regexp_extract(age_group, '([0-9]+)', 1), '') AS BIGINT)"
SEX_WORD = ("(CASE WHEN lower(trim(sex)) IN ('male','m','mle','men','man') THEN 'Male' "
            "WHEN lower(trim(sex)) IN ('female','f','fmle','women','woman') THEN 'Female' "
            "ELSE 'Both' END)")


def feature_case(code: str = "indicator_code", name: str = "indicator_name") -> str:
    by_name = " ".join(f"WHEN contains(lower({name}), '{k.lower()}') THEN '{v}'"
                       for k, v in C.INDICATOR_FEATURES.items())
    return (f"coalesce(nullif(feature_name, ''), {case_map(code, C.INDICATOR_FEATURES)}, "
            f"CASE {by_name} END)")


POP_KEYS = ["source", "country_iso3", "year", "indicator_code", "sex", "age_group",
            "country_name", "indicator_name", "metric_type", "unit"]
PRIORITY = case_map("source", C.SOURCE_PRIORITY, "99")


def population(text: str) -> dict[str, str]:
    """Validated, normalised, deduplicated and filled population rows."""
    return {
        "pop": text,
        "pop_clean": "SELECT * FROM pop WHERE value IS NOT NULL AND (year IS NULL OR year BETWEEN "
                     f"1990 AND 2024) QUALIFY row_number() OVER (PARTITION BY {', '.join(POP_KEYS)} "
                     "ORDER BY row_order) = 1",
        "pop_strata": f"SELECT * EXCLUDE (n) REPLACE ({SEX_WORD} AS sex), {AGE_TEXT_BAND} AS "
                      f"age_group_bin FROM (SELECT *, {AGE_NUMBER} AS n FROM pop_clean)",
        "pop_factor": "SELECT indicator_name AS f_name, CASE WHEN count(value) > 5 AND "
                      "avg(CASE WHEN value < 1 THEN 1.0 WHEN value IS NOT NULL THEN 0.0 END) > 0.95 "
                      "THEN 100.0 ELSE 1.0 END AS factor FROM pop_strata "
                      "WHERE indicator_name IS NOT NULL GROUP BY indicator_name",
        "pop_units": "SELECT * EXCLUDE (f_name, factor) REPLACE (value * CAST(coalesce(factor, 1.0) "
                     "AS DOUBLE) AS value) FROM pop_strata LEFT JOIN pop_factor "
                     "ON indicator_name = f_name",
        "pop_named": f"SELECT * REPLACE ({feature_case()} AS feature_name) FROM pop_units",
        "pop_dedup": "SELECT * FROM pop_named QUALIFY row_number() OVER (PARTITION BY country_iso3, "
                     f"year, sex, age_group_bin, feature_name ORDER BY {PRIORITY}, source, "
                     "value NULLS LAST, row_order) = 1",
        "pop_long": "SELECT * REPLACE (CASE WHEN feature_name IS NOT NULL THEN "
                    "last_value(value IGNORE NULLS) OVER (PARTITION BY country_iso3, sex, "
                    "age_group_bin, feature_name ORDER BY year NULLS LAST ROWS BETWEEN 5 PRECEDING "
                    "AND CURRENT ROW) END AS value) FROM pop_dedup",
        "pop_wide": "SELECT country_iso3, year, sex, age_group_bin, max(country_name) AS "
                    "country_name, " + ", ".join(
                        f"avg(CASE WHEN feature_name = '{f}' THEN value END) AS {f}"
                        for f in C.POPULATION_FEATURES)
                    + " FROM pop_long WHERE feature_name IS NOT NULL AND value IS NOT NULL AND "
                      "country_iso3 IS NOT NULL AND year IS NOT NULL GROUP BY country_iso3, year, "
                      "sex, age_group_bin",
    }


def tiered(source: str, with_tier: bool = False, lead: str | None = None) -> dict[str, str]:
    """CTEs ending in ``tiered``: individuals with population features by closest match."""
    features = C.POPULATION_FEATURES
    lead = lead or features[0]
    avgs = ", ".join(f"avg({f}) AS {f}" for f in features)
    last = ", ".join(f"arg_max({f}, year) FILTER (WHERE {f} IS NOT NULL) AS {f}" for f in features)
    chosen = ", ".join(
        f"CASE WHEN t1.{lead} IS NOT NULL THEN t1.{f} WHEN t2.{lead} IS NOT NULL THEN t2.{f} "
        f"ELSE t3.{f} END AS {f}" for f in features)
    tier = (f", CASE WHEN t1.{lead} IS NOT NULL THEN 1 WHEN t2.{lead} IS NOT NULL THEN 2 "
            f"WHEN t3.{lead} IS NOT NULL THEN 3 ELSE 0 END AS tier" if with_tier else "")
    return {
        "t2": f"SELECT country_iso3, year, {avgs} FROM pop_wide WHERE sex = 'Both' AND "
              "age_group_bin = 'All ages' GROUP BY country_iso3, year",
        "t3": f"SELECT country_iso3, {last} FROM t2 GROUP BY country_iso3",
        "tiered": f"SELECT i.*, {chosen}{tier} FROM {source} i "
                  "LEFT JOIN pop_wide t1 ON i.country_iso3 = t1.country_iso3 AND i.year = t1.year "
                  "AND i.sex = t1.sex AND i.age_group_bin = t1.age_group_bin "
                  "LEFT JOIN t2 ON i.country_iso3 = t2.country_iso3 AND i.year = t2.year "
                  "LEFT JOIN t3 ON i.country_iso3 = t3.country_iso3",
    }


ENV_WIDE = """SELECT country_iso3, avg(CASE WHEN parameter = 'pm25' THEN value END) AS pm25_latest,
  avg(CASE WHEN parameter = 'pm10' THEN value END) AS pm10_latest,
  avg(CASE WHEN parameter = 'no2' THEN value END) AS no2_latest,
  avg(CASE WHEN parameter = 'o3' THEN value END) AS env_o3
  FROM env_clean GROUP BY country_iso3"""
ENV_CLEAN = """SELECT * FROM env WHERE value IS NOT NULL QUALIFY row_number() OVER
  (PARTITION BY location_id, parameter, measured_at ORDER BY event_id) = 1"""
ENV_COLUMNS = ["pm25_latest", "pm10_latest", "no2_latest", "env_o3"]


def gate(score: str, field: int) -> str:
    def lit(x):
        return f"'{x}'" if isinstance(x, str) else str(x)

    whens = " ".join(f"WHEN {score} >= {g[0]} AND {score} < {g[1]} THEN {lit(g[field])}"
                     for g in C.WARNING_GATES)
    return f"(CASE {whens} ELSE {lit(C.WARNING_GATES[-1][field])} END)"


def scored(probs: str) -> dict[str, str]:
    mix = ", ".join(f"CAST(0.6 AS DOUBLE) * a_{c} + CAST(0.4 AS DOUBLE) * b_{c} AS p_{c}"
                    for c in ["low", "mod", "high"])
    best = ("(CASE WHEN p_low >= p_mod AND p_low >= p_high THEN 0 "
            "WHEN p_mod >= p_high THEN 1 ELSE 2 END)")
    return {
        "probs": probs,
        "mixed": f"SELECT *, {mix} FROM probs",
        "scored": f"""SELECT patient_id, country_iso3, age_group_bin, sex,
          {rnd('p_low', 4)} AS prob_low, {rnd('p_mod', 4)} AS prob_moderate,
          {rnd('p_high', 4)} AS prob_high, {rnd('p_high', 4)} AS ensemble_risk_score,
          {best} AS predicted_class,
          CASE {best} WHEN 0 THEN 'low' WHEN 1 THEN 'moderate' ELSE 'high' END AS predicted_label,
          {gate('p_high', 2)} AS warning_level, {gate('p_high', 3)} AS warning_label,
          {gate('p_high', 4)} AS warning_message,
          {rnd('a_high', 4)} AS branch_a_score, {rnd('b_high', 4)} AS branch_b_score,
          CASE WHEN abs(a_high - b_high) < 0.15 THEN 'both' WHEN a_high > b_high
            THEN 'current_disease' ELSE 'future_risk' END AS signal_type,
          scored_at, true_label FROM mixed""",
    }
