"""Registered queries: scalars, validation, features, population, enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from checks import sqltext as q
from cohort_risk import config as C
from cohort_risk.functions import scalars as S
from cohort_risk.operators import enrich, environment, individual, population, validate
from cohort_risk.plans import features
from cohort_risk.session import stored

QUERIES = {}
ORACLES = {}


def register(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return add


def individuals(spark: SparkSession, sf: str) -> DataFrame:
    return fx.load(spark, sf, fx.INDIVIDUAL)


def clean_individuals(spark: SparkSession, sf: str) -> DataFrame:
    return validate.clean_rows(validate.tag_individual(individuals(spark, sf), ["seq"]))


def clean_population(spark: SparkSession, sf: str) -> DataFrame:
    return validate.validate_population(fx.load(spark, sf, fx.POPULATION), ["row_order"])


def clean_environment(spark: SparkSession, sf: str) -> DataFrame:
    return validate.validate_environment(fx.load(spark, sf, fx.ENVIRONMENT), ["event_id"])


def stamp(c: str):
    return F.date_format(F.col(c), "yyyy-MM-dd HH:mm:ss").alias(c)


# --- scalars -----------------------------------------------------------------------

_NUM = "^\\s*[+-]?(([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?)\\s*$"
_RAW = """SELECT event_id, CASE event_id % 8 WHEN 0 THEN CAST(value AS VARCHAR) WHEN 1 THEN concat(' ', user_id, '.9 ')
  WHEN 2 THEN 'n/a' WHEN 3 THEN '' WHEN 4 THEN NULL WHEN 5 THEN concat('-', user_id) WHEN 6 THEN 'nan' ELSE concat(user_id, 'e1') END AS raw
  FROM events"""


@register("lenient_casts", f"""SELECT event_id, raw,
  CASE WHEN regexp_matches(raw, '{_NUM}') THEN TRY_CAST(trim(raw) AS DOUBLE) END AS as_double,
  CAST(trunc(CASE WHEN regexp_matches(raw, '{_NUM}') THEN TRY_CAST(trim(raw) AS DOUBLE) END) AS INT) AS as_int
  FROM ({_RAW}) r""")
def lenient_casts(spark, sf):
    raw = fx.load(spark, sf, _RAW.replace("VARCHAR", "STRING"))
    return raw.select("event_id", "raw", S.text_to_double("raw").alias("as_double"),
                      S.text_to_int("raw").alias("as_int"))


_WORDS = """SELECT o_orderkey, CASE o_orderkey % 9 WHEN 0 THEN ' F ' WHEN 1 THEN 'women' WHEN 2 THEN 'MALE' WHEN 3 THEN 'man'
  WHEN 4 THEN 'BTSX' WHEN 5 THEN NULL WHEN 6 THEN 'mle' WHEN 7 THEN 'FMLE' ELSE '' END AS sex,
  CASE o_orderkey % 11 WHEN 0 THEN 'Yes' WHEN 1 THEN '1' WHEN 2 THEN ' TRUE' WHEN 3 THEN 'positive' WHEN 4 THEN 'no'
  WHEN 5 THEN '0' WHEN 6 THEN 'False ' WHEN 7 THEN 'negative' WHEN 8 THEN NULL WHEN 9 THEN 'maybe' ELSE '' END AS answer,
  CASE o_orderkey % 7 WHEN 0 THEN 'Current' WHEN 1 THEN 'never' WHEN 2 THEN ' Former ' WHEN 3 THEN 'vapes' WHEN 4 THEN NULL WHEN 5 THEN '1' ELSE 'NO' END AS smoking,
  CASE o_orderkey % 6 WHEN 0 THEN 'Very Active' WHEN 1 THEN '2' WHEN 2 THEN 'inactive' WHEN 3 THEN 'sometimes' WHEN 4 THEN NULL ELSE 'HIGH' END AS activity,
  CASE o_orderkey % 10 WHEN 0 THEN '30-34 years' WHEN 1 THEN 'All Ages' WHEN 2 THEN NULL WHEN 3 THEN '85+' WHEN 4 THEN 'under 5' WHEN 5 THEN 'adults'
  WHEN 6 THEN concat(o_custkey % 130, ' plus') WHEN 7 THEN ' total ' WHEN 8 THEN '120' ELSE '' END AS age_group,
  o_orderpriority, o_orderstatus, o_orderdate
  FROM orders"""


@register("norm_sex", f"""SELECT o_orderkey, CASE WHEN lower(trim(sex)) IN ('f','female','women','woman') THEN 'Female'
  WHEN lower(trim(sex)) IN ('m','male','men','man') THEN 'Male' ELSE 'Both' END AS source_sex,
  {q.SEX_WORD} AS population_sex FROM ({_WORDS}) w""")
def norm_sex(spark, sf):
    return fx.load(spark, sf, _WORDS).select(
        "o_orderkey", S.normal_sex("sex").alias("source_sex"),
        S.population_sex("sex").alias("population_sex"))


_YES = ("CASE WHEN lower(trim(answer)) IN ('yes','1','true','positive') THEN 'yes' "
        "WHEN lower(trim(answer)) IN ('no','0','false','negative') THEN 'no' END")


@register("yes_no", f"SELECT o_orderkey, {_YES} AS answer, ({_YES}) = 'yes' AS flag FROM ({_WORDS}) w")
def yes_no(spark, sf):
    return fx.load(spark, sf, _WORDS).select(
        "o_orderkey", S.yes_no("answer").alias("answer"), S.yes_no_flag("answer").alias("flag"))


@register("synonym_map", f"""SELECT o_orderkey,
  coalesce({q.case_map('lower(trim(smoking))', C.SMOKING_SYNONYMS)}, lower(trim(smoking))) AS smoking_status,
  coalesce({q.case_map('lower(trim(activity))', C.ACTIVITY_SYNONYMS)}, lower(trim(activity))) AS physical_activity
  FROM ({_WORDS}) w""")
def synonym_map(spark, sf):
    return fx.load(spark, sf, _WORDS).select(
        "o_orderkey", S.synonym("smoking", C.SMOKING_SYNONYMS).alias("smoking_status"),
        S.synonym("activity", C.ACTIVITY_SYNONYMS).alias("physical_activity"))


@register("norm_age_text", f"""SELECT o_orderkey, {q.AGE_TEXT_BAND} AS age_band
  FROM (SELECT *, {q.AGE_NUMBER} AS n FROM ({_WORDS}) w) v""")
def norm_age_text(spark, sf):
    return fx.load(spark, sf, _WORDS).select(
        "o_orderkey", S.age_text_band("age_group").alias("age_band"))


@register("alias_coalesce", f"""SELECT o_orderkey, coalesce(sex, smoking, activity) AS first_word
  FROM ({_WORDS}) w""")
def alias_coalesce(spark, sf):
    df = fx.load(spark, sf, _WORDS)
    return df.select("o_orderkey", S.first_present(
        df, ["Sex (reported)", "sex", "smoking", "activity"]).alias("first_word"))


_STAMPS = """SELECT event_id, CASE event_id % 6 WHEN 0 THEN concat('2024-01-0', 1 + event_id % 9, 'T10:11:12Z')
  WHEN 1 THEN concat('2024-02-1', event_id % 10, 'T01:02:03+00:00') WHEN 2 THEN concat('2023-12-2', event_id % 9)
  WHEN 3 THEN 'yesterday' WHEN 4 THEN NULL ELSE '2024-01-01T10:00:00+05:00' END AS raw FROM events"""


@register("parse_ts", f"""SELECT event_id, strftime(coalesce(try_strptime(raw, '%Y-%m-%dT%H:%M:%SZ'),
  try_strptime(raw, '%Y-%m-%dT%H:%M:%S+00:00'), try_strptime(raw, '%Y-%m-%d')), '%Y-%m-%d %H:%M:%S') AS measured_at
  FROM ({_STAMPS}) s""")
def parse_ts(spark, sf):
    df = fx.load(spark, sf, _STAMPS).withColumn("measured_at", S.utc_timestamp("raw"))
    return df.select("event_id", stamp("measured_at"))


_INDICATORS = """SELECT l_orderkey, l_linenumber, CASE WHEN l_suppkey % 11 = 0 THEN 'given_feature' WHEN l_suppkey % 11 = 1 THEN '' ELSE NULL END AS feature_name,
  CASE l_partkey % 6 WHEN 0 THEN 'NCD_GLUC_04' WHEN 1 THEN 'SH.XPD.CHEX.GD.ZS' WHEN 2 THEN 'other' ELSE NULL END AS indicator_code,
  CASE l_orderkey % 5 WHEN 0 THEN 'mean NCD_CHOL_MEANC level' WHEN 1 THEN 'share wb_urban_pct' WHEN 2 THEN 'sp.urb.totl.in.zs' WHEN 3 THEN NULL ELSE 'unrelated' END AS indicator_name
  FROM lineitem"""


@register("rename_indicators",
          f"SELECT l_orderkey, l_linenumber, {q.feature_case()} AS feature_name FROM ({_INDICATORS}) i")
def rename_indicators(spark, sf):
    df = population.rename_indicators(fx.load(spark, sf, _INDICATORS))
    return df.select("l_orderkey", "l_linenumber", "feature_name")


# --- validation --------------------------------------------------------------------

_V = q.validated(fx.INDIVIDUAL)


@register("validate_clean", q.with_ctes(_V, "SELECT * FROM clean"))
def validate_clean(spark, sf):
    return clean_individuals(spark, sf)


@register("validate_quarantine", q.with_ctes(
    _V, "SELECT *, 'individual' AS _source FROM tagged WHERE _reject <> ''"))
def validate_quarantine(spark, sf):
    tagged = validate.tag_individual(individuals(spark, sf), ["seq"])
    return validate.quarantined_rows(tagged, "individual")


def _report_sql() -> str:
    bad = "_reject <> ''"
    lines = [("total_rows", "NULL", "max((SELECT count(*) FROM ind))"),
             ("duplicate_rows", "NULL", "(SELECT count(*) FROM ind) - count(*)"),
             ("valid_rows", "NULL", "count(*) FILTER (WHERE _reject = '')"),
             ("quarantined_rows", "NULL", f"count(*) FILTER (WHERE {bad})"),
             ("missing_required", "NULL", " + ".join(
                 f"count(*) FILTER (WHERE {c} IS NULL)" for c in C.REQUIRED_COLUMNS)),
             ("pass_rate", "NULL", "count(*) FILTER (WHERE _reject = '') / "
                                   "(SELECT CAST(count(*) AS DOUBLE) FROM ind)")]
    for c in C.NUMERIC_COLUMNS:
        rate = f"avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)"
        lines += [("null_rate", f"'{c}'", rate),
                  ("null_rate_warning", f"'{c}'", f"CASE WHEN {rate} > 0.05 THEN {rate} END")]
    for c in C.CLINICAL_RANGES:
        n = f"count(*) FILTER (WHERE {q.REASONS['range_' + c]})"
        lines.append(("range_violation", f"'{c}'", f"nullif({n}, 0)"))
    body = " UNION ALL ".join(
        f"SELECT 'individual' AS dataset, '{m}' AS metric, CAST({c} AS VARCHAR) AS \"column\", "
        f"CAST({v} AS DOUBLE) AS value FROM tagged" for m, c, v in lines)
    return q.with_ctes(_V, f"SELECT dataset, metric, \"column\", round(value, 9) AS value FROM ({body}) "
                           "WHERE value IS NOT NULL")


@register("validation_report", _report_sql())
def validation_report(spark, sf):
    return validate.individual_report(individuals(spark, sf), ["seq"]).withColumn(
        "value", F.round("value", 9))


_P = q.population(fx.POPULATION)


@register("validate_population", q.with_ctes(
    {k: _P[k] for k in ["pop", "pop_clean"]}, "SELECT * FROM pop_clean"))
def validate_population(spark, sf):
    return clean_population(spark, sf)


_LITERAL = """SELECT * FROM (SELECT * FROM pop QUALIFY row_number() OVER (PARTITION BY source, country_iso3,
  year, indicator_code, sex, age_group ORDER BY row_order) = 1) d
  WHERE value IS NOT NULL AND (year IS NULL OR year BETWEEN 1990 AND 2024)"""


@register("validate_population_dedup_first", q.with_ctes({"pop": fx.POPULATION}, _LITERAL))
def validate_population_dedup_first(spark, sf):
    return validate.validate_population(
        fx.load(spark, sf, fx.POPULATION), ["row_order"],
        keys=C.POPULATION_DEDUP_KEYS, reject_before_dedup=False)


@register("population_report", q.with_ctes(
    {k: _P[k] for k in ["pop", "pop_clean"]}, """
  SELECT 'population' AS dataset, metric, CAST(col AS VARCHAR) AS "column", round(CAST(value AS DOUBLE), 9) AS value FROM (
    SELECT 'total_rows' AS metric, NULL AS col, count(*) AS value FROM pop
    UNION ALL SELECT 'duplicate_rows', NULL, count(*) FILTER (WHERE value IS NOT NULL AND (year IS NULL OR year BETWEEN 1990 AND 2024)) - (SELECT count(*) FROM pop_clean) FROM pop
    UNION ALL SELECT 'valid_rows', NULL, count(*) FROM pop_clean
    UNION ALL SELECT 'quarantined_rows', NULL, count(*) FILTER (WHERE value IS NULL OR NOT coalesce(year BETWEEN 1990 AND 2024, TRUE)) FROM pop
    UNION ALL SELECT 'missing_required', NULL, count(*) FILTER (WHERE value IS NULL) FROM pop
    UNION ALL SELECT 'pass_rate', NULL, (SELECT count(*) FROM pop_clean) / CAST(count(*) AS DOUBLE) FROM pop
    UNION ALL SELECT 'range_violation', 'year', count(*) FILTER (WHERE year NOT BETWEEN 1990 AND 2024) FROM pop) r
  WHERE metric <> 'range_violation' OR value > 0"""))
def population_report(spark, sf):
    return validate.population_report(
        fx.load(spark, sf, fx.POPULATION), ["row_order"]).withColumn("value", F.round("value", 9))


_ENV_OUT = ("event_id, location_id, country_iso3, latitude, longitude, parameter, value, "
            "strftime(measured_at, '%Y-%m-%d %H:%M:%S') AS measured_at")


@register("validate_environment", q.with_ctes(
    {"env": fx.ENVIRONMENT, "env_clean": q.ENV_CLEAN}, f"SELECT {_ENV_OUT} FROM env_clean"))
def validate_environment(spark, sf):
    df = clean_environment(spark, sf)
    return df.withColumn("measured_at", stamp("measured_at"))


@register("environment_report", q.with_ctes({"env": fx.ENVIRONMENT}, """
  SELECT 'environment' AS dataset, metric, CAST(NULL AS VARCHAR) AS "column", CAST(v AS DOUBLE) AS value FROM (
    SELECT sum(n_clean + n_bad) AS total_rows, sum(greatest(n_clean - 1, 0)) AS duplicate_rows,
           count(*) FILTER (WHERE n_clean > 0) AS valid_rows, sum(n_bad) AS quarantined_rows,
           sum(n_value) + sum(n_time) AS missing_required
    FROM (SELECT count(*) FILTER (WHERE value IS NOT NULL AND measured_at IS NOT NULL) AS n_clean,
                 count(*) FILTER (WHERE value IS NULL OR measured_at IS NULL) AS n_bad,
                 count(*) FILTER (WHERE value IS NULL) AS n_value, count(*) FILTER (WHERE measured_at IS NULL) AS n_time
          FROM env GROUP BY location_id, parameter, measured_at) k
  ) r UNPIVOT (v FOR metric IN (total_rows, duplicate_rows, valid_rows, quarantined_rows, missing_required))"""))
def environment_report(spark, sf):
    return validate.environment_report(fx.load(spark, sf, fx.ENVIRONMENT))


@register("environment_quarantine", q.with_ctes({"env": fx.ENVIRONMENT}, """
  SELECT event_id, concat_ws('; ', CASE WHEN value IS NULL THEN 'null_value' END,
                             CASE WHEN measured_at IS NULL THEN 'null_measured_at' END) AS reason
  FROM env WHERE value IS NULL OR measured_at IS NULL"""))
def environment_quarantine(spark, sf):
    _, quarantine = validate.validate_environment_rows(fx.load(spark, sf, fx.ENVIRONMENT), ["event_id"])
    return quarantine.select("event_id", F.col("_reject").alias("reason"))


@register("dataset_summary", f"""SELECT dataset, n_rows, CASE WHEN n_rows > 0 THEN 'OK' ELSE 'FAIL' END AS status FROM (
  SELECT 'individual' AS dataset, count(*) AS n_rows FROM ({fx.INDIVIDUAL}) a
  UNION ALL SELECT 'population', count(*) FROM ({fx.POPULATION}) b
  UNION ALL SELECT 'environment', count(*) FROM ({fx.ENVIRONMENT}) c
  UNION ALL SELECT 'unmapped', count(*) FROM ({fx.ENVIRONMENT}) d WHERE parameter = 'so2') s""")
def dataset_summary(spark, sf):
    env = fx.load(spark, sf, fx.ENVIRONMENT)
    return validate.dataset_summary({
        "individual": individuals(spark, sf), "population": fx.load(spark, sf, fx.POPULATION),
        "environment": env, "unmapped": env.filter("parameter = 'so2'")})


# --- individual features -----------------------------------------------------------

_D = {**_V, **q.prepared(fx.AS_OF_YEAR)}


@register("encode_categories", q.with_ctes(_D, f"""SELECT patient_id, seq, year, sex_enc, smoking_enc,
  activity_enc, diabetes_enc, family_history_cvd, {q.target()} AS target FROM derived"""))
def encode_categories(spark, sf):
    df = individual.prepare(clean_individuals(spark, sf), fx.AS_OF_YEAR)
    return individual.encode_target(df).select(
        "patient_id", "seq", "year", "sex_enc", "smoking_enc", "activity_enc", "diabetes_enc",
        "family_history_cvd", "target")


@register("encode_target_four_levels", q.with_ctes(
    _V, f"SELECT patient_id, seq, {q.case_map(q.fold('cvd_risk_level'), C.RISK_CODES)} AS target FROM clean"))
def encode_target_four_levels(spark, sf):
    return individual.encode_target(clean_individuals(spark, sf), clamp=False).select(
        "patient_id", "seq", "target")


_DERIVED = ["patient_id", "seq", "bp_pulse_pressure", "bp_stage", "bp_hypertension_flag",
            "bmi_category_enc", "glucose_category_enc", "chol_hdl_ratio",
            "metabolic_syndrome_score"]


@register("derive_clinical", q.with_ctes(
    {**_V, **q.prepared(fx.AS_OF_YEAR, "ind")}, f"SELECT {', '.join(_DERIVED)} FROM derived"))
def derive_clinical(spark, sf):
    # over the raw table, so that missing measurements occur
    return individual.prepare(individuals(spark, sf), fx.AS_OF_YEAR).select(*_DERIVED)


@register("age_band", q.with_ctes({"ind": fx.INDIVIDUAL}, f"""SELECT patient_id, seq,
  {q.band('age')} AS age_band, {q.band('cvd_risk_score', [0, .25, .45, .65, 1.01], ['low', 'moderate', 'high', 'critical'])} AS risk_tier
  FROM ind"""))
def age_band(spark, sf):
    return individuals(spark, sf).select(
        "patient_id", "seq", S.age_band("age").alias("age_band"),
        S.risk_tier("cvd_risk_score").alias("risk_tier"))


@register("imputer_fit", q.with_ctes(
    _D, f"SELECT feature, stat, round(value, 9) AS value FROM ({q.imputer()}) s"))
def imputer_fit(spark, sf):
    df = individual.prepare(clean_individuals(spark, sf), fx.AS_OF_YEAR)
    return individual.imputer_stats(df).withColumn("value", F.round("value", 9))


_I = {**_D, "stats": q.imputer(), "imputed": q.imputed()}
_FILLED = C.MEDIAN_COLUMNS + C.MODE_COLUMNS


@register("imputer_apply", q.with_ctes(_I, "SELECT patient_id, seq, " + ", ".join(
    f"round(CAST({c} AS DOUBLE), 9) AS {c}" for c in _FILLED) + " FROM imputed"))
def imputer_apply(spark, sf):
    df = individual.prepare(clean_individuals(spark, sf), fx.AS_OF_YEAR)
    fills = individual.stats_dict(individual.imputer_stats(df))
    return individual.impute(df, fills).select(
        "patient_id", "seq", *[F.round(F.col(c).cast("double"), 9).alias(c) for c in _FILLED])


# --- population --------------------------------------------------------------------


@register("norm_units", q.with_ctes(
    {k: _P[k] for k in ["pop", "pop_clean", "pop_strata", "pop_factor", "pop_units"]},
    "SELECT row_order, indicator_name, round(value, 9) AS value FROM pop_units"))
def norm_units(spark, sf):
    df = population.normalise_strata(clean_population(spark, sf))
    return population.normalise_units(df).select(
        "row_order", "indicator_name", F.round("value", 9).alias("value"))


_PANEL = "source, country_iso3, year, sex, age_group_bin, feature_name, round(value, 9) AS value"


@register("dedup_priority", q.with_ctes(
    {k: v for k, v in _P.items() if k not in ("pop_long", "pop_wide")},
    f"SELECT {_PANEL} FROM pop_dedup"))
def dedup_priority(spark, sf):
    df = population.rename_indicators(population.normalise_units(
        population.normalise_strata(clean_population(spark, sf))))
    return population.dedup_by_priority(df, ["row_order"]).select(
        "source", "country_iso3", "year", "sex", "age_group_bin", "feature_name",
        F.round("value", 9).alias("value"))


# Gaps come from hiding two thirds of the deduplicated values.
_GAPS = ("CASE WHEN (year + row_order) % 3 = 0 THEN value END")


@register("ffill_limit", q.with_ctes(
    {**{k: v for k, v in _P.items() if k not in ("pop_long", "pop_wide")},
     "gaps": f"SELECT * REPLACE ({_GAPS} AS value) FROM pop_dedup"},
    """SELECT country_iso3, year, sex, age_group_bin, feature_name, round(CASE WHEN feature_name IS NOT NULL THEN
  last_value(value IGNORE NULLS) OVER (PARTITION BY country_iso3, sex, age_group_bin, feature_name
  ORDER BY year NULLS LAST ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) END, 9) AS value FROM gaps"""))
def ffill_limit(spark, sf):
    df = population.rename_indicators(population.normalise_units(
        population.normalise_strata(clean_population(spark, sf))))
    gaps = population.dedup_by_priority(df, ["row_order"]).withColumn("value", F.expr(_GAPS))
    return population.forward_fill(gaps).select(
        "country_iso3", "year", "sex", "age_group_bin", "feature_name",
        F.round("value", 9).alias("value"))


_WIDE = ", ".join(f"round({f}, 9) AS {f}" for f in C.POPULATION_FEATURES)


@register("pivot_wide", q.with_ctes(
    _P, f"SELECT country_iso3, year, sex, age_group_bin, country_name, {_WIDE} FROM pop_wide"))
def pivot_wide(spark, sf):
    _, wide = population.transform_population(clean_population(spark, sf), ["row_order"])
    return wide.withColumns({f: F.round(f, 9) for f in C.POPULATION_FEATURES})


@register("union_sources", q.with_ctes(
    {"pop": fx.POPULATION, "env": fx.ENVIRONMENT}, """
  SELECT source, country_iso3, year, value, CAST(NULL AS VARCHAR) AS parameter FROM pop
  UNION ALL SELECT NULL, country_iso3, NULL, value, parameter FROM env"""))
def union_sources(spark, sf):
    pop = fx.load(spark, sf, fx.POPULATION).select("source", "country_iso3", "year", "value")
    env = fx.load(spark, sf, fx.ENVIRONMENT).select("country_iso3", "value", "parameter")
    return population.union_sources(pop, env)


# --- enrichment --------------------------------------------------------------------

_BANDED = {**_D, "base": f"SELECT *, {q.band('age')} AS age_group_bin FROM derived"}
_T = {**_BANDED, **_P, **q.tiered("base", with_tier=True)}


def _base(spark, sf):
    df = individual.prepare(clean_individuals(spark, sf), fx.AS_OF_YEAR)
    return individual.add_age_band(df)


def _wide(spark, sf):
    wide = population.transform_population(clean_population(spark, sf), ["row_order"])[1]
    return stored(wide, "pop_wide")


@register("tiered_join", q.with_ctes(
    _T, f"SELECT patient_id, seq, country_iso3, year, sex, age_group_bin, {_WIDE}, tier FROM tiered"))
def tiered_join(spark, sf):
    out = enrich.tiered_join(_base(spark, sf), _wide(spark, sf), tier="tier")
    return out.select("patient_id", "seq", "country_iso3", "year", "sex", "age_group_bin",
                      *[F.round(f, 9).alias(f) for f in C.POPULATION_FEATURES], "tier")


# the alphabetically first indicator has no data, so the next one with data decides
_SPARSE = "wb_urban_pct"
_S = {**_BANDED, **{k: v for k, v in _P.items() if k != "pop_wide"},
      "all_wide": _P["pop_wide"],
      "pop_wide": "SELECT * REPLACE (" + ", ".join(
          f"CAST(NULL AS DOUBLE) AS {f}" for f in C.POPULATION_FEATURES if f != _SPARSE) + ") FROM all_wide",
      **q.tiered("base", with_tier=True, lead=_SPARSE)}


@register("tiered_join_sparse", q.with_ctes(
    _S, f"SELECT patient_id, seq, {_WIDE}, tier FROM tiered"))
def tiered_join_sparse(spark, sf):
    """Only urban shares have landed."""
    wide = _wide(spark, sf).withColumns(
        {f: F.lit(None).cast("double") for f in C.POPULATION_FEATURES if f != _SPARSE})
    out = enrich.tiered_join(_base(spark, sf), wide, tier="tier")
    return out.select("patient_id", "seq", *[F.round(f, 9).alias(f) for f in C.POPULATION_FEATURES], "tier")


_E = {"env": fx.ENVIRONMENT, "env_clean": q.ENV_CLEAN, "env_wide": q.ENV_WIDE}
_ENV = ", ".join(f"round({c}, 9) AS {c}" for c in q.ENV_COLUMNS)


@register("env_join", q.with_ctes(
    {**_V, **_E}, f"SELECT patient_id, seq, country_iso3, {_ENV} FROM clean "
                  "LEFT JOIN env_wide USING (country_iso3)"))
def env_join(spark, sf):
    ind = clean_individuals(spark, sf).select("patient_id", "seq", "country_iso3")
    out = enrich.join_environment(ind, clean_environment(spark, sf))
    return out.select("patient_id", "seq", "country_iso3",
                      *[F.round(c, 9).alias(c) for c in q.ENV_COLUMNS])


@register("population_fills", q.with_ctes(_T, " UNION ALL ".join(
    f"SELECT '{f}' AS feature, round(quantile_cont({f}, 0.5), 9) AS median, round(min({f}), 9) AS min, "
    f"round(max({f}), 9) AS max FROM tiered HAVING count({f}) > 0" for f in C.POPULATION_FEATURES)))
def population_fills(spark, sf):
    joined = enrich.tiered_join(_base(spark, sf), _wide(spark, sf))
    stats = enrich.fill_stats(enrich.context_counts(joined, C.POPULATION_PREFIXES))
    return stats.groupBy("feature").pivot("stat", ["median", "min", "max"]).agg(
        F.round(F.max("value"), 9))


def _full_sql() -> dict[str, str]:
    """CTEs ending in ``enriched``: everything the feature plan computes."""
    context = C.POPULATION_FEATURES + q.ENV_COLUMNS
    fills = ", ".join(f"quantile_cont({c}, 0.5) AS {c}" for c in context)
    bounds = ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in context)
    burden = [c for c in C.POPULATION_FEATURES if c.startswith(C.BURDEN_PREFIXES)]
    scaled = [f"(f.{c} - b.lo_{c}) / (b.hi_{c} - b.lo_{c} + 1e-9)" for c in burden]
    index = ("(" + " + ".join(f"coalesce({s}, 0)" for s in scaled) + ") / nullif("
             + " + ".join(f"CASE WHEN f.{c} IS NULL THEN 0 ELSE 1 END" for c in burden) + ", 0)")
    return {
        **_I,
        "base": f"SELECT *, {q.band('age')} AS age_group_bin, {q.target()} AS target FROM imputed",
        **_P, **q.tiered("base"), **_E,
        "joined": f"SELECT t.*, {', '.join('e.' + c for c in q.ENV_COLUMNS)} FROM tiered t "
                  "LEFT JOIN env_wide e USING (country_iso3)",
        "fills": f"SELECT {fills} FROM joined",
        "bounds": f"SELECT {bounds} FROM joined",
        "filled": "SELECT j.* REPLACE (" + ", ".join(
            f"coalesce(j.{c}, (SELECT {c} FROM fills)) AS {c}" for c in context) + ") FROM joined j",
        "enriched": f"SELECT f.*, {q.case_map('f.age_group_bin', C.AGE_RISK_MULTIPLIER, '1.0')} AS "
                    f"age_group_risk_multiplier, {index} AS country_ncd_burden_index "
                    "FROM filled f, bounds b",
    }


_FULL = _full_sql()


def fitted(spark, sf) -> tuple[features.FeatureModel, DataFrame]:
    # validated rows are a stored table between the validation and the feature run
    ind = stored(clean_individuals(spark, sf), "clean")
    wide = population.transform_population(clean_population(spark, sf), ["row_order"])[1]
    model = features.fit(ind, wide, clean_environment(spark, sf), fx.AS_OF_YEAR)
    return model, ind


@register("composites", q.with_ctes(_FULL, """SELECT patient_id, seq,
  CAST(age_group_risk_multiplier AS DOUBLE) AS age_group_risk_multiplier,
  round(country_ncd_burden_index, 7) AS country_ncd_burden_index FROM enriched"""))
def composites(spark, sf):
    model, ind = fitted(spark, sf)
    return model.transform(ind).select(
        "patient_id", "seq", "age_group_risk_multiplier",
        F.round("country_ncd_burden_index", 7).alias("country_ncd_burden_index"))


_A = [*C.ID_COLUMNS, "sex", "age_group_bin", C.TARGET, *C.BRANCH_A_FEATURES]
_B = [*C.ID_COLUMNS, "sex", "age_group_bin", C.TARGET, *C.BRANCH_B_FEATURES]
_DOUBLES = {c for c in C.BRANCH_A_FEATURES + C.BRANCH_B_FEATURES}


def _rounded_sql(columns):
    return ", ".join(f"round(CAST({c} AS DOUBLE), 7) AS {c}" if c in _DOUBLES else c
                     for c in columns)


def _rounded(df):
    return df.select(*[F.round(F.col(c).cast("double"), 7).alias(c) if c in _DOUBLES else c
                       for c in df.columns])


@register("branch_tables", q.with_ctes(
    _FULL, f"SELECT 'A' AS branch, {_rounded_sql(_A)}, {_rounded_sql([c for c in _B if c not in _A])} FROM enriched"))
def branch_tables(spark, sf):
    model, ind = fitted(spark, sf)
    enriched = model.transform(ind, with_target=True)
    both = enrich.branch_table(enriched, C.BRANCH_A_FEATURES + [
        c for c in C.BRANCH_B_FEATURES if c not in C.BRANCH_A_FEATURES])
    return _rounded(both).select(F.lit("A").alias("branch"), "*")


@register("branch_b_table", q.with_ctes(_FULL, f"SELECT {_rounded_sql(_B)} FROM enriched"))
def branch_b_table(spark, sf):
    model, ind = fitted(spark, sf)
    return _rounded(features.branch_tables(model.transform(ind, with_target=True))[1])


_EXTRA = q.ENV_COLUMNS + C.POPULATION_FEATURES


@register("feature_tables", q.with_ctes(_FULL, "SELECT seq, " + _rounded_sql(_A) + ", "
          + ", ".join(f"round({c}, 7) AS {c}" for c in _EXTRA)
          + ", round(country_ncd_burden_index, 7) AS country_ncd_burden_index FROM enriched"))
def feature_tables(spark, sf):
    model, ind = fitted(spark, sf)
    out = model.transform(ind, with_target=True)
    return out.select("seq", *_A, *_EXTRA, "country_ncd_burden_index").withColumns(
        {c: F.round(F.col(c).cast("double"), 7)
         for c in [*C.BRANCH_A_FEATURES, *_EXTRA, "country_ncd_burden_index"]})


# --- environment -------------------------------------------------------------------


@register("env_latest_by_country", q.with_ctes(
    {"env": fx.ENVIRONMENT, "env_clean": q.ENV_CLEAN}, f"""SELECT {_ENV_OUT}, CAST(recency AS INT) AS recency FROM (
  SELECT *, row_number() OVER (PARTITION BY country_iso3 ORDER BY measured_at DESC NULLS LAST, event_id) AS recency
  FROM env_clean) r WHERE recency <= 100"""))
def env_latest_by_country(spark, sf):
    out = environment.latest_by_country(clean_environment(spark, sf), "event_id", 100)
    return out.withColumn("measured_at", stamp("measured_at"))


@register("env_latest_all", q.with_ctes(
    {"env": fx.ENVIRONMENT, "env_clean": q.ENV_CLEAN}, f"""SELECT {_ENV_OUT}, CAST(row_number() OVER (
  PARTITION BY country_iso3 ORDER BY measured_at DESC NULLS LAST, event_id) AS INT) AS recency FROM env_clean"""))
def env_latest_all(spark, sf):
    """Without a limit every reading stays, ranked."""
    out = environment.latest_by_country(clean_environment(spark, sf), "event_id", None)
    return out.withColumn("measured_at", stamp("measured_at"))


_POINTS = """SELECT c_custkey AS point_id, CAST((c_custkey * 13) % 120 AS DOUBLE) - 60 + CAST(c_custkey % 7 AS DOUBLE) / 100 AS latitude,
  CAST((c_custkey * 29) % 340 AS DOUBLE) - 170 + CAST(c_custkey % 5 AS DOUBLE) / 100 AS longitude FROM customer"""


@register("env_within_radius", q.with_ctes(
    {"env": fx.ENVIRONMENT, "env_clean": q.ENV_CLEAN, "points": _POINTS}, """
  SELECT point_id, event_id, strftime(measured_at, '%Y-%m-%d %H:%M:%S') AS measured_at, parameter, value, round(distance_m, 3) AS distance_m, CAST(recency AS INT) AS recency FROM (
    SELECT *, row_number() OVER (PARTITION BY point_id ORDER BY measured_at DESC NULLS LAST, event_id) AS recency FROM (
      SELECT p.point_id, e.event_id, e.measured_at, e.parameter, e.value, 2 * 6371000.0 * asin(least(1.0, sqrt(
        pow(sin(radians(e.latitude - p.latitude) / 2), 2) + cos(radians(p.latitude)) * cos(radians(e.latitude))
        * pow(sin(radians(e.longitude - p.longitude) / 2), 2)))) AS distance_m
      FROM points p JOIN env_clean e ON abs(e.latitude - p.latitude) < 0.2) d
    WHERE distance_m <= 10000) r
  WHERE recency <= 100"""))
def env_within_radius(spark, sf):
    points = fx.load(spark, sf, _POINTS)
    out = environment.within_radius(points, clean_environment(spark, sf), "event_id", 100)
    return out.select("point_id", "event_id", stamp("measured_at"), "parameter", "value",
                      F.round("distance_m", 3).alias("distance_m"), "recency")
