import json

import pytest
from pyspark.sql import functions as F

from cohort_risk import config as C
from cohort_risk import schemas
from cohort_risk.session import shared_dir, stored
from cohort_risk.sinks import tables
from cohort_risk.sources import environment, individuals, population


def write(path, name, text):
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text(text)


def test_who_payload(spark, tmp_path):
    rows = [
        {"SpatialDim": "BGD", "SpatialDimType": "COUNTRY", "TimeDim": 2010, "Dim1": "MLE", "Dim2": "AGE30", "NumericValue": 24.5, "Low": 20, "High": None},
        {"SpatialDim": "SEAR", "SpatialDimType": "REGION", "TimeDim": 2010, "Dim1": "MLE", "NumericValue": 1},
        {"SpatialDim": "THA", "SpatialDimType": "COUNTRY", "TimeDim": 2023, "Dim1": "??", "Dim2": "", "NumericValue": "x"},
        {"SpatialDim": "THA", "SpatialDimType": "COUNTRY", "TimeDim": 1999, "Dim1": "BTSX", "NumericValue": 3},
        {"SpatialDim": "THA", "SpatialDimType": "COUNTRY", "TimeDim": None, "Dim1": "BTSX", "NumericValue": 3},
    ]
    write(tmp_path / "indicator_name=CHOLESTEROL", "page.json", json.dumps({"value": rows}, indent=1))
    payloads = population.read_payloads(spark, str(tmp_path), schemas.WHO_PAYLOAD)
    out = population.who_records(payloads, ingested_at=F.lit("2024-01-01").cast("timestamp"))
    assert [f.name for f in out.schema] == [f.name for f in schemas.POPULATION]
    got = sorted(tuple(r) for r in out.select(
        "country_iso3", "year", "sex", "age_group", "indicator_code", "value", "lower_ci", "upper_ci").collect())
    assert got == [("BGD", 2010, "Male", "AGE30", "NCD_CHOL_MEANC", 24.5, 20.0, None),
                   ("THA", 2023, "Both", "All ages", "NCD_CHOL_MEANC", None, None, None)]


def test_cdi_and_brfss(spark, tmp_path):
    cdi = [{"topic": "Diabetes", "yearstart": "2012", "yearend": "2013", "stratification1": "Female", "datavalue": "7", "datavaluetype": "Crude"},
           {"topic": "Diabetes", "yearstart": "2023", "yearend": "2024", "datavalue": "7"},
           {"topic": "Asthma", "yearstart": "2012", "yearend": "2013"},
           {"topic": "Diabetes", "yearstart": "2014", "yearend": "2014"}]
    write(tmp_path / "cdi", "a.json", "\n".join(map(json.dumps, cdi)))
    rows = spark.read.schema(schemas.CDI_ROW).json(str(tmp_path / "cdi"))
    got = sorted(tuple(r) for r in population.cdi_records(rows).select(
        "country_iso3", "year", "sex", "age_group", "metric_type", "value").collect())
    assert got == [("USA", 2012, "Female", "Overall", "crude", 7.0), ("USA", 2014, "Both", "Overall", "prevalence", None)]
    brfss = [{"class": "Tobacco Use", "year": "2015", "break_out": "Male", "data_value": "20"}, {"class": "Other", "year": "2015"}]
    write(tmp_path / "brfss", "a.json", "\n".join(map(json.dumps, brfss)))
    rows = spark.read.schema(schemas.BRFSS_ROW).json(str(tmp_path / "brfss"))
    assert [tuple(r) for r in population.brfss_records(rows).select("year", "sex", "value").collect()] == [(2015, "Male", 20.0)]


def test_gbd_headers(spark, tmp_path):
    header = "Measure Name,location_name, Sex_Name ,age_name,cause_name,metric_name,year,val,upper,lower"
    write(tmp_path, "a.csv", header + "\nDeaths,Bangladesh,Male,All ages,Stroke,Rate,2019,1.5,2,1\n"
                                      "Deaths,Bangladesh,Male,All ages,All causes,Rate,2019,1.5,2,1\n")
    other = "year,lower,upper,val,metric_name,cause_name,age_name,sex_name,location_name,measure_name,extra"
    write(tmp_path, "b.csv", other + "\n2020,1,3,2,Percent,Stroke,45-49 years,Both,Nepal,Prevalence,zz\n")
    write(tmp_path, "c.csv", "year,val\n2020,1\n")
    rows = population.read_gbd(spark, str(tmp_path))
    got = sorted(tuple(r) for r in population.gbd_records(rows).select(
        "country_name", "year", "sex", "indicator_name", "metric_type", "value", "lower_ci", "upper_ci", "unit", "country_iso3").collect())
    assert got == [("Bangladesh", 2019, "Male", "Stroke — Deaths (Rate)", "deaths", 1.5, 1.0, 2.0, "per 100k", None),
                   ("Nepal", 2020, "Both", "Stroke — Prevalence (Percent)", "prevalence", 2.0, 1.0, 3.0, "%", None)]


def test_worldbank_payload(spark, tmp_path):
    payload = [{"page": 1}, [
        {"countryiso3code": "BGD", "country": {"id": "BD", "value": "Bangladesh"}, "date": "2015", "value": 34.3},
        {"countryiso3code": "", "country": {"id": "LA", "value": "Lao"}, "date": "2016Q1", "value": 0},
        {"countryiso3code": "THA", "country": None, "date": "2016", "value": None}]]
    write(tmp_path / "indicator_name=URBAN_POPULATION", "p.json", json.dumps(payload, indent=2))
    texts = population.read_texts(spark, str(tmp_path))
    got = sorted(tuple(r) for r in population.worldbank_records(texts).select(
        "country_iso3", "country_name", "year", "value", "indicator_code").collect())
    assert got == [("BGD", "Bangladesh", 2015, 34.3, "SP.URB.TOTL.IN.ZS"), ("LA", "Lao", 2016, 0.0, "SP.URB.TOTL.IN.ZS")]


def test_registry(spark, tmp_path):
    header = " Age ,Sex,Gender,Systolic,Diastolic BP,BMI,Smoking Status,Diabetes,Family History of CVD,CVD Risk Level"
    lines = ["45,F,,120,80,25,YES,Positive,Yes,HIGH", "50,,M,130,85,30,pipe,0,?,", "50,M,,20,85,30,no,0,no,low", "50,M,,,85,30,no,0,no,low"]
    write(tmp_path, "r.csv", header + "\n" + "\n".join(lines))
    rows = individuals.read_registry(spark, str(tmp_path / "r.csv"))
    out = individuals.registry_records(rows)
    got = sorted(tuple(r) for r in out.select(
        "age", "sex", "systolic_bp", "smoking_status", "diabetes_status", "family_history_cvd", "cvd_risk_level", "country_iso3").collect())
    assert got == [(45.0, "Female", 120.0, "smoker", "yes", True, "high", "BGD"), (50.0, "Male", 130.0, "pipe", "no", None, "", "BGD")]
    assert out.select("patient_id").distinct().count() == 2
    keyed = individuals.registry_records(rows.withColumn("k", F.lit(7)), row_key="k")
    assert keyed.first()["patient_id"] == "cair_00007"


def test_biometrics(spark, tmp_path):
    items = [{"user_id": "u1", "systolic": 0, "blood_pressure_systolic": 130, "diastolic": 80, "bmi": 22.5, "blood_glucose": None, "glucose": 5.5},
             {"uid": "u2", "systolic": 118, "blood_pressure_diastolic": 70, "weight": "61"}, {"systolic": 1}]
    write(tmp_path, "b.json", json.dumps({"biometrics": items}))
    payloads = spark.read.schema(schemas.BIOMETRIC_PAYLOAD).json(str(tmp_path))
    cols = ["patient_id", "systolic_bp", "diastolic_bp", "bmi", "weight_kg", "fasting_glucose"]
    got = {tuple(r) for r in individuals.biometric_records(individuals.biometric_items(payloads)).select(*cols).collect()}
    assert got == {("u1", 130.0, 80.0, 22.5, None, 5.5), ("u2", 118.0, 70.0, None, 61.0, None), (None, 1.0, None, None, None, None)}
    given = individuals.biometric_records(individuals.biometric_items(payloads), patient_id="p9")
    assert {r["patient_id"] for r in given.collect()} == {"p9"}


def test_air_quality(spark, tmp_path):
    results = [{"locationId": 5, "location": "Dhaka", "coordinates": {"latitude": 23.7, "longitude": 90.4}, "parameter": "pm25", "value": 80, "unit": "x", "date": {"utc": "2024-01-01T00:00:00Z"}},
               {"parameter": "o3", "value": None, "date": {"utc": "bad"}}]
    write(tmp_path / "country=BD", "a.json", json.dumps({"results": results}))
    payloads = spark.read.schema(schemas.AIR_PAYLOAD).json(str(tmp_path))
    got = sorted((tuple(r) for r in environment.air_records(payloads, F.col("country")).select(
        "location_id", "country_iso3", "latitude", "parameter", "value", F.unix_timestamp("measured_at")).collect()), key=str)
    assert got == [("", "BGD", None, "o3", None, None), ("5", "BGD", 23.7, "pm25", 80.0, 1704067200)]


# --- sinks ---------------------------------------------------------------------------


def test_snapshots(spark, tmp_path):
    path = str(tmp_path / "scores")
    full = spark.createDataFrame([("a", 0.1), ("b", 0.2)], "patient_id string, prob_low double")
    tables.write_scores(full, path, "20240101")
    tables.write_scores(full, path, "20240101")
    tables.write_scores(full.filter("patient_id = 'a'"), path, "20240102")
    tables.write_scores(full.filter("patient_id = 'b'"), path, "20240103", partial=True)
    latest = tables.read_scores(spark, path)
    assert [r["patient_id"] for r in latest.collect()] == ["a"]
    assert latest.columns[:17] == C.RESULT_COLUMNS
    assert spark.read.parquet(path).count() == 4
    tables.write_features({"individual_features": full}, str(tmp_path / "store"), "1")
    assert tables.read_latest(spark, str(tmp_path / "store/individual_features")).count() == 2


def test_landed_datasets(spark, tmp_path):
    root = str(tmp_path)
    one = spark.createDataFrame([("who", 1.0)], "source string, value double")
    two = spark.createDataFrame([("cdc", 2.0, "TX")], "source string, value double, region string")
    tables.write_landed({"population_who": one, "population_cdc": two, "population_none": one.limit(0),
                         "individual_training": one}, root, "20240101")
    tables.write_landed({"population_who": one}, root, "20240102")
    got = tables.read_landed(spark, root, "population_")
    assert sorted((r["source"], r["value"]) for r in got.collect()) == [("cdc", 2.0), ("who", 1.0), ("who", 1.0)]
    assert {"region", "dataset"} <= set(got.columns)


def test_validated_rows_are_written_once_and_read_apart(spark, tmp_path):
    tagged = spark.createDataFrame([("a", ""), ("b", "null_bmi; range_age")], "patient_id string, _reject string")
    path = str(tmp_path / "v")
    tables.write_validated(tagged, path, "individual", "1")
    tables.write_validated(tagged, path, "individual", "2")
    tables.write_validated(tagged, path, "individual", "2")  # the run is repeated
    assert [r[0] for r in tables.read_clean(spark, path).collect()] == ["a"]
    assert tables.read_quarantine(spark, path).count() == 2
    bad = tables.read_quarantine(spark, path).first()
    assert bad["_reasons"] == ["null_bmi", "range_age"] and bad["_source"] == "individual"


def test_logs_and_exports(spark, tmp_path):
    df = spark.createDataFrame([("bmi", 0.1)], "feature string, psi double")
    tables.append_log(df, str(tmp_path / "log"), "1")
    tables.append_log(df, str(tmp_path / "log"), "2")
    tables.append_log(df, str(tmp_path / "log"), "2")
    assert spark.read.parquet(str(tmp_path / "log")).count() == 2
    tables.write_csv_exports({"v": df, "empty": df.limit(0)}, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv/v")).first()["feature"] == "bmi"
    assert not (tmp_path / "csv/empty").exists()


def test_jdbc_mode_is_checked(spark):
    with pytest.raises(ValueError):
        tables.write_jdbc(spark.range(1).toDF("x"), "jdbc:none", "t", mode="replace")


def test_shared_dir_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    folder = shared_dir(spark, "x")
    assert folder != shared_dir(spark, "x")
    if root:
        assert folder.startswith(root)
    else:
        assert folder.startswith(spark.sparkContext.getCheckpointDir())
    assert spark.sparkContext.applicationId in folder
    assert stored(spark.range(3).toDF("n"), "y").count() == 3
