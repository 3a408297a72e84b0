"""Registered queries give all of their results, not a part of them."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks import run_checks
from cohort_risk import config as C
from cohort_risk.plans import training
from cohort_risk.streaming import readings

SF = "/root/testdata/sf0.001"


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(run_checks, "FOREST", C.ForestParams(num_trees=3, max_depth=3))
    monkeypatch.setattr(run_checks, "KERNEL", C.KernelParams(n_components=16, max_iter=5))


def test_folds_of_both_models_of_both_branches(spark, small):
    got = {(r["branch"], r["model"], r["fold"]) for r in run_checks.cross_validation(spark, SF).collect()}
    assert got == {(b, m, i) for b in "AB" for m in (training.FOREST, training.KERNEL) for i in range(5)}


def test_scoring_uses_the_primary_models(spark, small, monkeypatch):
    train, asked = training.train_branch, []

    def kernel_first(*args, **kwargs):
        result = train(*args, **kwargs)
        result.model.primary = training.KERNEL
        return result

    def probabilities(self, df, of=training.BranchModel.probabilities):
        asked.append((self.branch, self.primary, self.kernel is not None))
        return of(self, df)

    monkeypatch.setattr(training, "train_branch", kernel_first)
    monkeypatch.setattr(training.BranchModel, "probabilities", probabilities)
    for query in (run_checks.score_with_models, run_checks.stream_score):
        asked.clear()
        assert query(spark, SF).count() > 0
        assert asked == [("A", training.KERNEL, True), ("B", training.KERNEL, True)]


def test_prepared_rows_are_spread_over_the_cores(spark):
    n = 3 * training.ROWS_PER_TASK
    rows = spark.range(n).select(
        "id", (F.col("id") % 101).cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b"),
        (F.col("id") % 5 == 0).alias("is_test")).coalesce(1)
    kernel = C.KernelParams(n_components=8)
    prep = training.prepare(rows, ["a", "b"], kernel)
    sizes = [r["count"] for r in prep.rows.groupBy(F.input_file_name()).count().collect()]
    assert sizes == [training.ROWS_PER_TASK] * 3
    assert prep.rows.select("id").distinct().count() == n
    assert training.spread(rows.limit(training.ROWS_PER_TASK)).rdd.getNumPartitions() == 1


def test_mapped_inputs_are_the_random_features(spark):
    kernel = C.KernelParams(n_components=8)
    inputs = [[0.0, 1.0], [-2.5, 3.0], [1e3, 0.25]]
    got = spark.createDataFrame([(x,) for x in inputs], "x array<double>").coalesce(1).select(
        training.random_features(2, kernel)("x").alias("y")).collect()
    rng = np.random.default_rng(kernel.seed)
    freq = rng.normal(0.0, 1.0, (2, 8))
    phase = rng.uniform(0.0, 2.0 * np.pi, 8)
    assert np.allclose([r["y"] for r in got], 0.5 * np.cos(np.array(inputs) @ freq + phase), atol=1e-9)


def test_open_windows_and_late_readings_are_published(spark, tmp_path):
    schema = "country_iso3 string, parameter string, value double, measured_at timestamp"
    source = str(tmp_path / "in")

    def published(*rows):
        df = spark.createDataFrame([("A", "pm25", v, t) for v, t in rows], schema.replace("timestamp", "string"))
        df.withColumn("measured_at", F.to_timestamp("measured_at")).coalesce(1).write.mode("append").parquet(source)
        stream = readings.landed_readings(spark.readStream.schema(schema).parquet(source))
        readings.append_to(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
        got = readings.current_means(spark.read.parquet(str(tmp_path / "out"))).collect()
        return sorted((r["window_start"].strftime("%d"), r["mean_value"], r["n_late"], r["provisional"]) for r in got)

    assert published((1.0, "2024-01-01 10:00:00"), (3.0, "2024-01-01 12:00:00"), (5.0, "2024-01-02 05:00:00")) == [
        ("01", 2.0, 0, False), ("02", 5.0, 0, True)]
    assert published((101.0, "2024-01-01 13:00:00"), (7.0, "2024-01-03 09:00:00")) == [
        ("01", 35.0, 1, False), ("02", 5.0, 0, False), ("03", 7.0, 0, True)]
