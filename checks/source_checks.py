"""Registered queries: publisher payloads, derived from the given tables, to canonical rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from checks import sqltext as q
from checks.features_checks import stamp
from cohort_risk import config as C
from cohort_risk import schemas
from cohort_risk.sources import environment, individuals, population

QUERIES = {}
ORACLES = {}


def register(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return add


_POP = ["source", "country_iso3", "country_name", "region", "year", "age_group", "sex",
        "indicator_code", "indicator_name", "metric_type", "value", "lower_ci", "upper_ci", "unit"]
_SEX = ("CASE WHEN lower(trim({0})) IN ('f','female','women','woman') THEN 'Female' "
        "WHEN lower(trim({0})) IN ('m','male','men','man') THEN 'Male' ELSE 'Both' END")

# --- indicator payloads: one envelope per order, one element per line item -----------

_WHO_ROWS = """SELECT l_orderkey, CASE l_orderkey % 3 WHEN 0 THEN 'BP_PREVALENCE' WHEN 1 THEN 'CHOLESTEROL' ELSE 'TOBACCO_USE' END AS indicator_name,
  concat('N', l_suppkey % 25) AS SpatialDim, CASE WHEN l_partkey % 7 = 0 THEN 'REGION' ELSE 'COUNTRY' END AS SpatialDimType,
  CASE WHEN l_partkey % 13 = 0 THEN NULL WHEN l_partkey % 17 = 0 THEN 'recent' ELSE CAST(1995 + l_orderkey % 33 AS {text}) END AS TimeDim,
  CASE l_linenumber % 5 WHEN 0 THEN 'BTSX' WHEN 1 THEN 'MLE' WHEN 2 THEN 'FMLE' WHEN 3 THEN '' ELSE 'XXX' END AS Dim1,
  CASE l_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN 'YEARS30-49' ELSE '70 plus' END AS Dim2,
  CASE WHEN l_partkey % 19 = 0 THEN 'No data' ELSE CAST(CAST(l_quantity AS INT) AS {text}) END AS NumericValue,
  CAST(CAST(l_quantity AS INT) - 1 AS {text}) AS Low, CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE CAST(CAST(l_quantity AS INT) + 1 AS {text}) END AS High
  FROM lineitem"""


def _envelopes(rows: DataFrame, keys: list[str], field: str, element) -> DataFrame:
    """Group rows into JSON texts, a handful of elements each."""
    return rows.groupBy(*keys).agg(
        F.to_json(F.struct(F.collect_list(element).alias(field))).alias("payload"))


@register("source_who", f"""SELECT 'who_gho' AS source, SpatialDim AS country_iso3, CAST(NULL AS VARCHAR) AS country_name, CAST(NULL AS VARCHAR) AS region,
  TRY_CAST(TimeDim AS INT) AS year, coalesce(nullif(Dim2, ''), 'All ages') AS age_group,
  CASE Dim1 WHEN 'MLE' THEN 'Male' WHEN 'FMLE' THEN 'Female' ELSE 'Both' END AS sex,
  {q.case_map('indicator_name', C.WHO_INDICATORS)} AS indicator_code, indicator_name, 'prevalence' AS metric_type,
  TRY_CAST(NumericValue AS DOUBLE) AS value, TRY_CAST(Low AS DOUBLE) AS lower_ci, TRY_CAST(High AS DOUBLE) AS upper_ci, '%' AS unit
  FROM ({_WHO_ROWS.format(text='VARCHAR')}) w WHERE SpatialDimType = 'COUNTRY' AND TRY_CAST(TimeDim AS INT) BETWEEN 2000 AND 2023""")
def source_who(spark: SparkSession, sf: str):
    rows = fx.load(spark, sf, _WHO_ROWS.format(text="STRING"))
    element = F.struct("SpatialDim", "SpatialDimType", "TimeDim", "Dim1", "Dim2",
                       "NumericValue", "Low", "High")
    texts = _envelopes(rows, ["l_orderkey", "indicator_name"], "value", element)
    payloads = texts.select("indicator_name", F.from_json("payload", schemas.WHO_PAYLOAD)["value"]
                            .alias("value"))
    return population.who_records(payloads).select(*_POP)


_WB_ROWS = """SELECT l_orderkey, CASE l_orderkey % 2 WHEN 0 THEN 'URBAN_POPULATION' ELSE 'DIABETES_PREVALENCE' END AS indicator_name,
  CASE WHEN l_partkey % 6 = 0 THEN '' WHEN l_partkey % 6 = 1 THEN NULL ELSE concat('C', l_suppkey % 12) END AS countryiso3code,
  concat('K', l_suppkey % 12) AS id, concat('Country ', l_suppkey % 12) AS name,
  CASE WHEN l_partkey % 10 = 0 THEN concat(2000 + l_orderkey % 20, 'Q1') ELSE CAST(2000 + l_orderkey % 20 AS {text}) END AS date,
  CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE l_quantity END AS value FROM lineitem"""


@register("source_worldbank", f"""SELECT 'worldbank' AS source, coalesce(nullif(countryiso3code, ''), id) AS country_iso3, name AS country_name,
  CAST(NULL AS VARCHAR) AS region, CAST(substring(date, 1, 4) AS INT) AS year, 'All ages' AS age_group, 'Both' AS sex,
  {q.case_map('indicator_name', C.WORLDBANK_INDICATORS)} AS indicator_code, indicator_name, 'prevalence' AS metric_type, value,
  CAST(NULL AS DOUBLE) AS lower_ci, CAST(NULL AS DOUBLE) AS upper_ci, '%' AS unit
  FROM ({_WB_ROWS.format(text='VARCHAR')}) w WHERE value IS NOT NULL""")
def source_worldbank(spark, sf):
    rows = fx.load(spark, sf, _WB_ROWS.format(text="STRING"))
    element = F.struct("countryiso3code", F.struct("id", F.col("name").alias("value"))
                       .alias("country"), "date", "value")
    texts = rows.groupBy("l_orderkey", "indicator_name").agg(
        F.concat(F.lit('[{"page":1},'), F.to_json(F.collect_list(element)), F.lit("]"))
        .alias("payload"))
    return population.worldbank_records(texts).select(*_POP)


_CDI = """SELECT CASE l_suppkey % 4 WHEN 0 THEN 'Diabetes' WHEN 1 THEN 'Obesity' WHEN 2 THEN 'Asthma' ELSE 'Chronic Kidney Disease' END AS topic,
  CAST(2005 + l_orderkey % 20 AS {text}) AS yearstart, CAST(2006 + l_orderkey % 20 AS {text}) AS yearend, concat('State ', l_suppkey % 50) AS locationdesc,
  CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE 'Gender' END AS stratificationcategory1,
  CASE l_linenumber % 4 WHEN 0 THEN 'Male' WHEN 1 THEN ' female' WHEN 2 THEN NULL ELSE 'Overall' END AS stratification1,
  concat('Q', l_partkey % 10) AS questionid, concat('Question ', l_partkey % 10) AS question,
  CASE l_linenumber % 3 WHEN 0 THEN 'Crude Prevalence' WHEN 1 THEN '' ELSE NULL END AS datavaluetype,
  CASE WHEN l_partkey % 8 = 0 THEN 'suppressed' ELSE CAST(CAST(l_quantity AS INT) AS {text}) END AS datavalue,
  CAST(CAST(l_quantity AS INT) - 2 AS {text}) AS lowconfidencelimit, CAST(CAST(l_quantity AS INT) + 2 AS {text}) AS highconfidencelimit
  FROM lineitem"""


@register("source_cdi", f"""SELECT 'cdc_cdi' AS source, 'USA' AS country_iso3, 'United States' AS country_name, locationdesc AS region,
  CAST(yearstart AS INT) AS year, coalesce(stratificationcategory1, 'Overall') AS age_group, {_SEX.format('stratification1')} AS sex,
  questionid AS indicator_code, question AS indicator_name, lower(coalesce(nullif(datavaluetype, ''), 'prevalence')) AS metric_type,
  TRY_CAST(datavalue AS DOUBLE) AS value, TRY_CAST(lowconfidencelimit AS DOUBLE) AS lower_ci, TRY_CAST(highconfidencelimit AS DOUBLE) AS upper_ci, '%' AS unit
  FROM ({_CDI.format(text='VARCHAR')}) c WHERE topic IN ('Diabetes', 'Obesity', 'Chronic Kidney Disease')
  AND CAST(yearstart AS INT) >= 2010 AND CAST(yearend AS INT) <= 2023""")
def source_cdi(spark, sf):
    return population.cdi_records(fx.load(spark, sf, _CDI.format(text="STRING"))).select(*_POP)


_BRFSS = """SELECT CASE o_orderkey % 4 WHEN 0 THEN 'Tobacco Use' WHEN 1 THEN 'Diabetes' WHEN 2 THEN 'Oral Health' ELSE 'Physical Activity' END AS class,
  CAST(2005 + o_orderkey % 21 AS {text}) AS year, concat('State ', o_custkey % 50) AS locationdesc,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'Age Group' END AS break_out_category, CASE o_orderkey % 3 WHEN 0 THEN 'Men' WHEN 1 THEN 'Women' ELSE '18-24' END AS break_out,
  concat('B', o_custkey % 10) AS questionid, concat('Survey ', o_custkey % 10) AS question,
  CASE o_orderkey % 3 WHEN 0 THEN 'Age-adjusted Prevalence' ELSE NULL END AS data_value_type,
  CAST(o_custkey % 100 AS {text}) AS data_value, NULL AS confidence_limit_low, CAST(o_custkey % 100 + 1 AS {text}) AS confidence_limit_high FROM orders"""


@register("source_brfss", f"""SELECT 'cdc_brfss' AS source, 'USA' AS country_iso3, 'United States' AS country_name, locationdesc AS region,
  CAST(year AS INT) AS year, coalesce(break_out_category, 'Overall') AS age_group, {_SEX.format('break_out')} AS sex,
  questionid AS indicator_code, question AS indicator_name, lower(coalesce(data_value_type, 'prevalence')) AS metric_type,
  CAST(data_value AS DOUBLE) AS value, CAST(NULL AS DOUBLE) AS lower_ci, CAST(confidence_limit_high AS DOUBLE) AS upper_ci, '%' AS unit
  FROM ({_BRFSS.format(text='VARCHAR')}) c WHERE class <> 'Oral Health' AND CAST(year AS INT) BETWEEN 2010 AND 2023""")
def source_brfss(spark, sf):
    rows = fx.load(spark, sf, _BRFSS.format(text="STRING"))
    rows = rows.withColumn("confidence_limit_low", F.col("confidence_limit_low").cast("string"))
    return population.brfss_records(rows).select(*_POP)


_GBD = """SELECT CASE l_suppkey % 3 WHEN 0 THEN 'Prevalence' WHEN 1 THEN 'Deaths' ELSE 'DALYs' END AS measure_name, concat('Land ', l_suppkey % 30) AS location_name,
  CASE l_linenumber % 3 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' ELSE 'Both' END AS sex_name, CASE l_linenumber % 2 WHEN 0 THEN 'All ages' ELSE '50-54 years' END AS age_name,
  CASE l_partkey % 5 WHEN 0 THEN 'Stroke' WHEN 1 THEN 'All causes' WHEN 2 THEN 'Chronic kidney disease' WHEN 3 THEN 'Ischemic heart disease' ELSE 'Injuries' END AS cause_name,
  CASE l_suppkey % 2 WHEN 0 THEN 'Percent' ELSE 'Rate' END AS metric_name, CAST(1995 + l_orderkey % 25 AS {text}) AS year,
  CAST(CAST(l_quantity AS INT) AS {text}) AS val, CAST(CAST(l_quantity AS INT) + 3 AS {text}) AS upper, CAST(CAST(l_quantity AS INT) - 3 AS {text}) AS lower FROM lineitem"""


@register("source_gbd", f"""SELECT 'ihme_gbd' AS source, CAST(NULL AS VARCHAR) AS country_iso3, location_name AS country_name, CAST(NULL AS VARCHAR) AS region,
  CAST(year AS INT) AS year, age_name AS age_group, sex_name AS sex, CAST(NULL AS VARCHAR) AS indicator_code,
  concat(cause_name, ' — ', measure_name, ' (', metric_name, ')') AS indicator_name, lower(measure_name) AS metric_type,
  CAST(val AS DOUBLE) AS value, CAST("lower" AS DOUBLE) AS lower_ci, CAST("upper" AS DOUBLE) AS upper_ci,
  CASE metric_name WHEN 'Percent' THEN '%' ELSE 'per 100k' END AS unit
  FROM ({_GBD.format(text='VARCHAR')}) g WHERE cause_name IN ('Stroke', 'Chronic kidney disease', 'Ischemic heart disease')""")
def source_gbd(spark, sf):
    return population.gbd_records(fx.load(spark, sf, _GBD.format(text="STRING"))).select(*_POP)


# --- individuals -------------------------------------------------------------------

_REG = """SELECT o_orderkey AS row_id, CAST(o_orderkey % 120 AS {text}) AS age_text, CASE o_orderkey % 4 WHEN 0 THEN 'F' WHEN 1 THEN 'man' WHEN 2 THEN NULL ELSE 'x' END AS gender,
  CAST(40 + o_orderkey % 80 AS {text}) AS weight, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(14 + (o_custkey * 13) % 80 AS {text}) END AS bmi_text,
  CAST(50 + (o_orderkey * 37) % 270 AS {text}) AS sbp, CASE WHEN o_orderkey % 11 = 0 THEN 'error' ELSE CAST(25 + (o_orderkey * 41) % 190 AS {text}) END AS dbp,
  CASE o_orderkey % 5 WHEN 0 THEN 'Current' WHEN 1 THEN 'NO' WHEN 2 THEN 'Pipe ' WHEN 3 THEN NULL ELSE 'former' END AS smoking,
  CASE o_orderkey % 3 WHEN 0 THEN 'Positive' WHEN 1 THEN '0' ELSE 'unknown' END AS diabetes,
  CASE o_orderkey % 4 WHEN 0 THEN '1' WHEN 1 THEN 'Very active' WHEN 2 THEN NULL ELSE 'none' END AS activity,
  CASE o_orderkey % 3 WHEN 0 THEN 'yes' WHEN 1 THEN 'no' ELSE NULL END AS family, CASE o_orderkey % 2 WHEN 0 THEN 'HIGH' ELSE NULL END AS risk FROM orders"""
_IND = ["source", "patient_id", "age", "sex", "country_iso3", "region", "systolic_bp", "diastolic_bp",
        "bmi", "weight_kg", "smoking_status", "diabetes_status", "physical_activity",
        "family_history_cvd", "bp_category", "cvd_risk_level"]


@register("source_registry", f"""SELECT 'mendeley_cair_cvd' AS source, concat('cair_', CASE WHEN length(CAST(row_id AS VARCHAR)) > 5 THEN CAST(row_id AS VARCHAR) ELSE lpad(CAST(row_id AS VARCHAR), 5, '0') END) AS patient_id,
  CAST(age_text AS DOUBLE) AS age, {_SEX.format('gender')} AS sex, 'BGD' AS country_iso3, 'Jamalpur' AS region, CAST(sbp AS DOUBLE) AS systolic_bp, TRY_CAST(dbp AS DOUBLE) AS diastolic_bp,
  CAST(bmi_text AS DOUBLE) AS bmi, CAST(weight AS DOUBLE) AS weight_kg, coalesce({q.case_map('lower(trim(smoking))', C.SMOKING_SYNONYMS)}, lower(trim(smoking))) AS smoking_status,
  CASE lower(diabetes) WHEN 'positive' THEN 'yes' WHEN '0' THEN 'no' END AS diabetes_status,
  coalesce({q.case_map('lower(trim(activity))', C.ACTIVITY_SYNONYMS)}, lower(trim(activity))) AS physical_activity,
  family = 'yes' AS family_history_cvd, '' AS bp_category, lower(coalesce(risk, '')) AS cvd_risk_level
  FROM ({_REG.format(text='VARCHAR')}) r WHERE CAST(sbp AS DOUBLE) BETWEEN 60 AND 300 AND TRY_CAST(dbp AS DOUBLE) BETWEEN 30 AND 200 AND CAST(bmi_text AS DOUBLE) BETWEEN 10 AND 80""")
def source_registry(spark, sf):
    rows = fx.load(spark, sf, _REG.format(text="STRING"))
    # some rows carry the second spelling of a header
    first = F.col("row_id") % 2 == 0
    rows = rows.select(
        "row_id", F.col("age_text").alias("Age"), F.col("gender").alias("Gender"),
        F.when(first, F.col("weight")).alias("Weight (kg)"),
        F.when(~first, F.col("weight")).alias("Weight"), F.col("bmi_text").alias("BMI"),
        F.when(first, F.col("sbp")).alias("Systolic BP"),
        F.when(~first, F.col("sbp")).alias("Systolic"),
        F.col("dbp").alias("Diastolic BP"), F.col("smoking").alias("Smoking"),
        F.col("diabetes").alias("Diabetes Status"),
        F.col("activity").alias("Physical Activity Level"),
        F.col("family").alias("Family History of CVD"), F.col("risk").alias("CVD Risk Level"))
    return individuals.registry_records(rows, row_key="row_id").select(*_IND)


BIOMETRICS = """SELECT user_id AS uid_key, event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE concat('u', user_id) END AS user_id,
  concat('v', user_id) AS uid, CASE event_id % 4 WHEN 0 THEN '0' WHEN 1 THEN NULL ELSE CAST(CAST(floor(50 + value * 5) AS INT) AS {text}) END AS systolic,
  CAST(110 + event_id % 50 AS {text}) AS blood_pressure_systolic, CAST(60 + event_id % 60 AS {text}) AS diastolic,
  CASE WHEN event_id % 8 = 0 THEN NULL ELSE CAST(15 + event_id % 30 AS {text}) END AS bmi, CAST(50 + event_id % 70 AS {text}) AS weight,
  CASE event_id % 3 WHEN 0 THEN '' ELSE CAST(4 + event_id % 9 AS {text}) END AS blood_glucose, CASE event_id % 2 WHEN 0 THEN '5.5' ELSE NULL END AS glucose FROM events"""
_EITHER = ("TRY_CAST(CASE WHEN {0} <> '' AND coalesce(TRY_CAST({0} AS DOUBLE) <> 0, TRUE) THEN {0} "
           "ELSE {1} END AS DOUBLE)")
BIO_SQL = f"""SELECT coalesce(user_id, uid) AS patient_id, {_EITHER.format('systolic', 'blood_pressure_systolic')} AS systolic_bp,
  CAST(diastolic AS DOUBLE) AS diastolic_bp, CAST(bmi AS DOUBLE) AS bmi, CAST(weight AS DOUBLE) AS weight_kg,
  {_EITHER.format('blood_glucose', 'glucose')} AS fasting_glucose FROM ({BIOMETRICS.format(text='VARCHAR')}) b"""
BIO_COLUMNS = ["patient_id", "systolic_bp", "diastolic_bp", "bmi", "weight_kg", "fasting_glucose"]


def biometric_payloads(spark, sf) -> DataFrame:
    """JSON texts of at most four items each."""
    rows = fx.load(spark, sf, BIOMETRICS.format(text="STRING"))
    element = F.struct("user_id", "uid", "systolic", "blood_pressure_systolic", "diastolic",
                       "bmi", "weight", "blood_glucose", "glucose")
    return _envelopes(rows.withColumn("page", F.floor(F.col("event_id") / 4)),
                      ["page"], "biometrics", element).select("payload")


@register("source_biometrics", BIO_SQL)
def source_biometrics(spark, sf):
    parsed = biometric_payloads(spark, sf).select(
        F.from_json("payload", schemas.BIOMETRIC_PAYLOAD)["biometrics"].alias("biometrics"))
    return individuals.biometric_records(individuals.biometric_items(parsed)).select(*BIO_COLUMNS)


# --- environment -------------------------------------------------------------------

_AIR = """SELECT event_id, CASE user_id % 3 WHEN 0 THEN 'BD' WHEN 1 THEN 'VN' ELSE 'ZZ' END AS country, concat(user_id) AS locationId, concat('City ', user_id % 9) AS location,
  CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(user_id % 60 AS {text}) END AS latitude, CASE event_id % 3 WHEN 0 THEN 'pm25' WHEN 1 THEN 'pm10' ELSE 'o3' END AS parameter,
  CASE WHEN event_id % 9 = 0 THEN 'n/a' ELSE CAST(event_id % 80 AS {text}) END AS value, 'ug/m3' AS unit,
  CASE event_id % 4 WHEN 0 THEN '2024-01-02T03:04:05Z' WHEN 1 THEN '2024-01-02T03:04:05+00:00' WHEN 2 THEN '2024-01-03' ELSE 'soon' END AS utc FROM events"""


@register("source_air_quality", f"""SELECT 'openaq' AS source, locationId AS location_id, location AS city, CASE country WHEN 'BD' THEN 'BGD' WHEN 'VN' THEN 'VNM' ELSE country END AS country_iso3,
  CAST(latitude AS DOUBLE) AS latitude, CASE WHEN latitude IS NULL THEN NULL ELSE 12.5e0 END AS longitude, parameter, TRY_CAST(value AS DOUBLE) AS value, unit,
  CASE WHEN utc = 'soon' THEN NULL WHEN utc = '2024-01-03' THEN '2024-01-03 00:00:00' ELSE '2024-01-02 03:04:05' END AS measured_at FROM ({_AIR.format(text='VARCHAR')}) a""")
def source_air_quality(spark, sf):
    rows = fx.load(spark, sf, _AIR.format(text="STRING"))
    where = F.when(F.col("latitude").isNotNull(), F.struct(
        "latitude", F.lit("12.5").alias("longitude")))
    element = F.struct("locationId", "location", where.alias("coordinates"), "parameter",
                       "value", "unit", F.struct("utc").alias("date"))
    texts = _envelopes(rows.withColumn("page", F.floor(F.col("event_id") / 4)),
                       ["page", "country"], "results", element)
    payloads = texts.select("country", F.from_json("payload", schemas.AIR_PAYLOAD)["results"]
                            .alias("results"))
    out = environment.air_records(payloads, F.col("country"))
    return out.select("source", "location_id", "city", "country_iso3", "latitude", "longitude",
                      "parameter", "value", "unit", stamp("measured_at"))


@register("source_union", None)
def source_union(spark, sf):
    """All publishers in one canonical table."""
    parts = [fn(spark, sf) for fn in (source_who, source_worldbank, source_cdi, source_brfss,
                                      source_gbd)]
    from cohort_risk.operators.population import union_sources as union
    return union(*parts).groupBy("source").agg(
        F.count("*").alias("n_rows"), F.round(F.sum("value"), 3).alias("total"))


_PARTS = ["source_who", "source_worldbank", "source_cdi", "source_brfss", "source_gbd"]
ORACLES["source_union"] = " UNION ALL ".join(
    f"SELECT any_value(source) AS source, count(*) AS n_rows, round(sum(value), 3) AS total FROM ({ORACLES[p]}) {p}"
    for p in _PARTS)
