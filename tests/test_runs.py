"""Whole runs on small tables: features, training, scoring, monitoring, publishing, streams."""

import json

import pytest
from pyspark.sql import functions as F

from checks import features_checks as fc
from checks import fixtures as fx
from cohort_risk import config as C
from cohort_risk.operators import drift, population
from cohort_risk.plans import features, monitoring, publish, score, training
from cohort_risk.session import stored
from cohort_risk.streaming import readings

SF = "/root/testdata/sf0.001"
STAMP = "2024-06-01 00:00:00"


@pytest.fixture(scope="module")
def fitted(spark):
    return fc.fitted(spark, SF)


@pytest.fixture(scope="module")
def table(fitted):
    model, ind = fitted
    return stored(model.transform(ind, with_target=True), "features")


@pytest.fixture(scope="module")
def branches(table):
    forest = C.ForestParams(num_trees=5, max_depth=4)
    kernel = C.KernelParams(n_components=32, max_iter=10)
    a = training.train_branch(table, "A", C.BRANCH_A_FEATURES, ["patient_id", "seq"], forest, kernel, cv=True)
    b = training.train_branch(table, "B", C.BRANCH_B_FEATURES, ["patient_id", "seq"], forest, None, cv=False)
    return a, b


def test_model_survives_saving(spark, fitted, tmp_path):
    model, ind = fitted
    model.save(str(tmp_path / "m"), spark)
    again = features.FeatureModel.load(str(tmp_path / "m"), spark)
    assert again.imputer == model.imputer and again.bounds == model.bounds and again.fills == model.fills
    columns = sorted(model.transform(ind).columns)
    first = sorted(map(str, model.transform(ind).select(*columns).collect()))
    assert first == sorted(map(str, again.transform(ind).select(*columns).collect()))


def test_transform_keeps_rows_and_leaves_no_gaps(fitted, table):
    _, ind = fitted
    assert table.count() == ind.count()
    for features_of in (C.BRANCH_A_FEATURES, C.BRANCH_B_FEATURES):
        assert table.filter(" OR ".join(f"{c} IS NULL" for c in features_of)).count() == 0


def test_scoring_does_not_refit(fitted):
    model, ind = fitted
    one = ind.limit(1).withColumn("hdl", F.lit(None).cast("double"))
    assert model.transform(one).first()["hdl"] == model.imputer["hdl"]
    assert C.TARGET not in model.transform(one).columns


def test_population_wide_has_one_row_per_key(spark):
    _, wide = population.transform_population(fc.clean_population(spark, SF), ["row_order"])
    keys = ["country_iso3", "year", "sex", "age_group_bin"]
    assert wide.count() == wide.select(*keys).distinct().count()


def test_training(branches):
    a, b = branches
    got = {(r["model"], r["metric"]): r["value"] for r in a.metrics.collect()}
    for model in (training.FOREST, training.KERNEL):
        for metric in ("accuracy", "f1_macro", "roc_auc", "cv_mean"):
            assert 0 <= got[(model, metric)] <= 1
        assert len(a.cv[model]) == 5
    assert {r["feature"] for r in a.importances.collect()} == set(C.BRANCH_A_FEATURES)
    assert a.importances.agg(F.sum("importance")).first()[0] == pytest.approx(1, abs=0.01)
    assert a.model.primary in (training.FOREST, training.KERNEL) and b.model.primary == training.FOREST


def test_branch_models_survive_saving(spark, table, branches, tmp_path):
    model = branches[0].model
    model.primary = training.KERNEL
    model.save(str(tmp_path / "a"), spark)
    again = training.BranchModel.load(str(tmp_path / "a"), spark)
    assert again.primary == training.KERNEL
    key = ["patient_id", "seq", "a_low", "a_mod", "a_high"]
    want = sorted(map(tuple, model.probabilities(table).select(*key).collect()))
    assert want == sorted(map(tuple, again.probabilities(table).select(*key).collect()))
    assert all(sum(r[2:]) == pytest.approx(1) for r in want)
    model.primary = training.FOREST


def test_score_monitor_publish(spark, table, branches, fitted, tmp_path):
    a, b = branches
    stamp = F.lit(STAMP).cast("timestamp")
    scored = stored(score.score(table, a.model, b.model, stamp), "scored")
    assert scored.columns == C.RESULT_COLUMNS and scored.count() == table.count()
    tables_a, tables_b = features.branch_tables(table.withColumn("patient_id", F.concat("patient_id", F.lit("-"), "seq")))
    apart = score.score_tables(tables_a, tables_b, a.model, b.model, ["patient_id"], ["source"], stamp)
    columns = ["country_iso3", "branch_a_score", "branch_b_score", "warning_level"]
    assert (sorted(map(str, apart.select(*columns).collect()))
            == sorted(map(str, scored.select(*columns).collect())))
    one = score.one_patient(table, scored.first()["patient_id"])
    assert score.score(one, a.model, b.model, stamp).count() >= 1

    base = stored(drift.compute_baseline(drift.long_features(table)), "baseline")
    assert {"pop_bp_prevalence", "systolic_bp"} <= {r["feature"] for r in base.collect()}
    run = monitoring.monitoring_run(table, scored, base, reference_f1=1.5,
                                    truth=scored.select("patient_id", F.lit(1).alias("true_label")))
    assert run.drift.agg(F.max("psi")).first()[0] == pytest.approx(0, abs=1e-9)
    assert run.decision.first()["retrain_triggered"] and "F1 degraded" in run.decision.first()["reasons"]
    monitoring.write_logs(run, str(tmp_path / "logs"), "1")
    assert spark.read.parquet(str(tmp_path / "logs/drift_log")).count() == run.drift.count()

    long, _ = population.transform_population(fc.clean_population(spark, SF), ["row_order"])
    published = publish.reporting_views(
        scored, long, a.importances.unionByName(b.importances), run, F.lit(STAMP))
    publish.write_views(published, str(tmp_path / "views"), "1")
    health = spark.read.parquet(str(tmp_path / "views/model_health_view"))
    assert health.filter("retrain_triggered").count() == health.count() > 0
    assert spark.read.option("header", True).csv(str(tmp_path / "views/csv/1/patient_risk_scores")).count() == scored.count()


# --- streams -------------------------------------------------------------------------


def _payload(*items):
    return json.dumps({"biometrics": list(items)})


def test_biometric_stream_equals_batch_over_several_batches(spark, tmp_path):
    from cohort_risk import schemas
    from cohort_risk.sources.individuals import biometric_items, biometric_records

    landing = tmp_path / "in"
    landing.mkdir()
    for i in range(4):
        (landing / f"{i}.json").write_text(_payload(
            {"user_id": f"u{i}", "systolic": 100 + i, "diastolic": 80, "bmi": 25},
            {"user_id": f"v{i}", "systolic": 20, "diastolic": 80}))
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    stream = readings.validated_stream(readings.biometric_stream(spark, str(landing), max_files=1))
    readings.write_partitioned(stream, out, state).awaitTermination()
    batch = readings.validated_stream(biometric_records(biometric_items(
        spark.read.schema(schemas.BIOMETRIC_PAYLOAD).json(str(landing)))))
    columns = ["patient_id", "systolic_bp", "_reject"]
    got = spark.read.parquet(out).select(*columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, batch.select(*columns).collect()))
    # a restart from the checkpoint takes only new files
    (landing / "9.json").write_text(_payload({"user_id": "w", "systolic": 120, "diastolic": 80, "bmi": 25}))
    stream = readings.validated_stream(readings.biometric_stream(spark, str(landing), max_files=1))
    readings.write_partitioned(stream, out, state).awaitTermination()
    assert spark.read.parquet(out).count() == 9


def test_late_readings_are_dropped_and_open_windows_held_back(spark, tmp_path):
    schema = "location_id string, country_iso3 string, parameter string, value double, measured_at timestamp"
    source = str(tmp_path / "in")

    def land(*rows):
        df = spark.createDataFrame([("s", "A", "pm25", v, t) for v, t in rows],
                                   schema.replace("timestamp", "string"))
        df.withColumn("measured_at", F.to_timestamp("measured_at")).coalesce(1).write.mode("append").parquet(source)

    def drain():
        stream = readings.windowed_means(spark.readStream.schema(schema).parquet(source))
        readings.append_to(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
        got = spark.read.parquet(str(tmp_path / "out"))
        return sorted((r["window_start"].strftime("%d"), r["mean_value"]) for r in got.collect())

    land((1.0, "2024-01-01 10:00:00"), (3.0, "2024-01-01 12:00:00"), (5.0, "2024-01-02 05:00:00"))
    assert drain() == [("01", 2.0)]
    land((100.0, "2024-01-01 13:00:00"), (7.0, "2024-01-03 09:00:00"))
    assert drain() == [("01", 2.0), ("02", 5.0)]


def test_repeated_readings_pass_once(spark, tmp_path):
    schema = "location_id string, parameter string, measured_at timestamp, value double"
    df = spark.sql("SELECT 's' AS location_id, 'o3' AS parameter, timestamp_seconds(1700000000 + id % 5) AS measured_at, "
                   "CAST(id AS double) AS value FROM range(40)")
    df.write.parquet(str(tmp_path / "in"))
    stream = readings.deduplicated(spark.readStream.schema(schema).parquet(str(tmp_path / "in")))
    readings.append_to(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5


def test_scored_stream_equals_batch(spark, fitted, branches, tmp_path):
    model, ind = fitted
    a, b = branches
    stamp = F.lit(STAMP).cast("timestamp")
    ind.write.parquet(str(tmp_path / "in"))
    stream = readings.scored_stream(
        spark.readStream.schema(ind.schema).parquet(str(tmp_path / "in")), model, a.model, b.model, stamp)
    readings.append_to(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    batch = score.score(model.transform(ind), a.model, b.model, stamp)
    columns = ["patient_id", "ensemble_risk_score", "warning_level"]
    got = spark.read.parquet(str(tmp_path / "out")).select(*columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, batch.select(*columns).collect()))
