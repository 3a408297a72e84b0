"""Inputs of the registered queries, derived from the given tables.

Each text runs unchanged in Spark and in the comparison engine. The tables hold
nulls, boundary values, out-of-range values, unknown words, stray blanks and
duplicates, and grow with the table they come from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

AS_OF_YEAR = 2024

INDIVIDUAL = """
SELECT concat('p', c_custkey) AS patient_id, seq, 'demo' AS source, concat('NATION_', c_nationkey) AS country_iso3, concat('REGION_', c_nationkey % 5) AS region,
  CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST(1990 + c_custkey % 15 AS INT) END AS year,
  CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE CAST((c_custkey * 7) % 125 AS DOUBLE) END AS age,
  CASE c_custkey % 5 WHEN 0 THEN 'Male' WHEN 1 THEN ' female ' WHEN 2 THEN 'M' WHEN 3 THEN 'other' ELSE NULL END AS sex,
  CASE WHEN c_custkey % 29 = 0 THEN NULL WHEN c_custkey % 97 = 0 THEN CAST(400 AS DOUBLE) ELSE CAST(85 + (c_custkey * 37) % 120 AS DOUBLE) END AS systolic_bp,
  CASE WHEN c_custkey % 31 = 0 THEN NULL ELSE CAST(50 + (c_custkey * 41) % 80 AS DOUBLE) END AS diastolic_bp,
  CASE WHEN c_custkey % 37 = 0 THEN CAST(NULL AS DOUBLE) ELSE CAST(14 + (c_custkey * 13) % 40 AS DOUBLE) END AS bmi,
  CAST(40 + (c_custkey * 17) % 90 AS DOUBLE) AS weight_kg,
  CAST(140 + (c_custkey * 19) % 60 AS DOUBLE) / 100 AS height_m,
  CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST(60 + (c_custkey * 23) % 70 AS DOUBLE) END AS abdominal_circ_cm,
  CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE CAST(25 + (c_custkey * 29) % 175 AS DOUBLE) / 10 END AS fasting_glucose,
  CAST(20 + (c_custkey * 43) % 100 AS DOUBLE) / 10 AS total_cholesterol,
  CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE CAST((c_custkey * 47) % 60 AS DOUBLE) / 10 END AS hdl,
  CAST(5 + (c_custkey * 53) % 95 AS DOUBLE) / 10 AS estimated_ldl,
  CASE c_custkey % 4 WHEN 0 THEN 'Smoker' WHEN 1 THEN 'non-smoker' WHEN 2 THEN ' former' ELSE NULL END AS smoking_status,
  CASE c_custkey % 3 WHEN 0 THEN 'yes' WHEN 1 THEN 'No' ELSE NULL END AS diabetes_status,
  CASE c_custkey % 7 WHEN 0 THEN 'low' WHEN 1 THEN 'HIGH' WHEN 2 THEN 'sporadic' ELSE 'moderate' END AS physical_activity,
  CASE c_custkey % 4 WHEN 0 THEN TRUE WHEN 1 THEN NULL ELSE FALSE END AS family_history_cvd,
  CASE c_custkey % 6 WHEN 0 THEN 'low' WHEN 1 THEN ' High' WHEN 2 THEN 'moderate' WHEN 3 THEN '' WHEN 4 THEN 'Very High' ELSE 'low' END AS cvd_risk_level,
  CAST((c_custkey * 59) % 101 AS DOUBLE) / 100 AS cvd_risk_score
FROM (SELECT c_custkey, c_nationkey, 0 AS seq FROM customer
      UNION ALL SELECT c_custkey, c_nationkey, 1 AS seq FROM customer) c
"""

# One indicator row per order. Indicators 0 and 5 repeat each other under one code,
# 2 is a second source of it, 3 is published as a fraction, 4 is unknown; nation 3
# has no row for both sexes and all ages.
POPULATION = """
SELECT CASE k WHEN 1 THEN 'worldbank' WHEN 2 THEN 'ihme_gbd' WHEN 3 THEN 'worldbank' WHEN 4 THEN 'cdc_cdi' ELSE 'who_gho' END AS source,
  concat('NATION_', nation) AS country_iso3, concat('NATION_', nation) AS country_name, year,
  CASE t WHEN 0 THEN 'Both' WHEN 1 THEN 'male' ELSE 'FMLE' END AS sex,
  CASE t WHEN 0 THEN 'All ages' WHEN 1 THEN '30-34 years' ELSE '45-49' END AS age_group,
  CASE k WHEN 1 THEN 'SP.URB.TOTL.IN.ZS' WHEN 3 THEN 'SH.STA.OWAD.ZS' WHEN 4 THEN 'UNKNOWN' ELSE 'NCD_HYP_PREVALENCE_A' END AS indicator_code,
  CASE k WHEN 1 THEN 'URBAN_POPULATION' WHEN 2 THEN 'BP_PREVALENCE_GBD' WHEN 3 THEN 'OBESITY_PREVALENCE' WHEN 4 THEN 'Other question' ELSE 'BP_PREVALENCE' END AS indicator_name,
  CAST(NULL AS VARCHAR(64)) AS feature_name, 'prevalence' AS metric_type,
  CASE WHEN (o_orderkey * 7) % 19 = 0 THEN NULL
       WHEN k = 3 THEN CAST((o_orderkey * 13) % 95 AS DOUBLE) / 100
       ELSE CAST(20 + (o_orderkey * 13) % 40 AS DOUBLE) END AS value,
  '%' AS unit, o_orderkey AS row_order
FROM (SELECT o_orderkey, o_orderkey % 6 AS k, CASE WHEN o_custkey % 25 = 3 AND o_custkey % 3 = 0 THEN 1 ELSE o_custkey % 3 END AS t, o_custkey % 25 AS nation,
        CASE WHEN o_orderkey % 41 = 0 THEN 1989 ELSE CAST(year(o_orderdate) AS INT) END AS year
      FROM orders) o
"""

ENVIRONMENT = """
SELECT event_id, concat('s', user_id % 50) AS location_id, concat('NATION_', user_id % 25) AS country_iso3,
  CAST((user_id * 13) % 120 AS DOUBLE) - 60 AS latitude, CAST((user_id * 29) % 340 AS DOUBLE) - 170 AS longitude,
  CASE event_id % 4 WHEN 0 THEN 'pm25' WHEN 1 THEN 'pm10' WHEN 2 THEN 'no2' ELSE 'o3' END AS parameter,
  CASE WHEN event_id % 31 = 0 THEN NULL ELSE value END AS value, ts AS measured_at
FROM events
"""

BRANCH_PROBS = """
SELECT concat('o', o_orderkey) AS patient_id, concat('NATION_', o_custkey % 25) AS country_iso3,
  CASE o_orderkey % 6 WHEN 0 THEN '30-44' WHEN 1 THEN '45-59' WHEN 2 THEN '60-74' WHEN 3 THEN '75+' WHEN 4 THEN 'nan' ELSE NULL END AS age_group_bin,
  CASE o_orderkey % 3 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' ELSE NULL END AS sex,
  1.0 - CAST((o_orderkey * 37) % 1000 AS DOUBLE) / 1000 - CAST((1000 - (o_orderkey * 37) % 1000) * ((o_orderkey * 11) % 100) AS DOUBLE) / 100000 AS a_low,
  CAST((1000 - (o_orderkey * 37) % 1000) * ((o_orderkey * 11) % 100) AS DOUBLE) / 100000 AS a_mod,
  CAST((o_orderkey * 37) % 1000 AS DOUBLE) / 1000 AS a_high,
  1.0 - CAST((o_orderkey * 53) % 1000 AS DOUBLE) / 1000 - CAST((1000 - (o_orderkey * 53) % 1000) * ((o_orderkey * 17) % 100) AS DOUBLE) / 100000 AS b_low,
  CAST((1000 - (o_orderkey * 53) % 1000) * ((o_orderkey * 17) % 100) AS DOUBLE) / 100000 AS b_mod,
  CAST((o_orderkey * 53) % 1000 AS DOUBLE) / 1000 AS b_high,
  CASE WHEN o_orderkey % 10 = 9 THEN NULL ELSE CAST(o_orderkey % 3 AS INT) END AS true_label, o_orderdate AS scored_at
FROM orders
"""

# Long-form feature values in two samples; 'error' is shifted in the second.
DRIFT = """
SELECT event_type AS feature, CASE WHEN event_id % 2 = 0 THEN 'baseline' ELSE 'current' END AS side,
  CASE WHEN event_id % 2 = 1 AND event_type = 'error' THEN value + 5 ELSE value END AS value
FROM events
"""

# Gini-like importances summed from line items
IMPORTANCE = """
SELECT branch, feature, sum(CAST(l_quantity AS BIGINT)) / 1000000.0E0 AS importance
FROM (SELECT CASE WHEN l_orderkey % 2 = 0 THEN 'A' ELSE 'B' END AS branch, l_quantity,
        CASE l_suppkey % 9 WHEN 0 THEN 'age' WHEN 1 THEN 'systolic_bp' WHEN 2 THEN 'bmi'
          WHEN 3 THEN 'fasting_glucose' WHEN 4 THEN 'hdl' WHEN 5 THEN 'smoking_enc'
          WHEN 6 THEN 'pop_bp_prevalence' WHEN 7 THEN 'pm25_latest' ELSE 'shoe_size' END AS feature
      FROM lineitem) l
GROUP BY branch, feature
"""

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def load(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run a fixture text over the tables in ``sf_dir``."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    for name in TABLES:
        if name in sql:
            spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)
    return spark.sql(sql)
