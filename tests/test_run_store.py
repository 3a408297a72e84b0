"""Runs become visible by their manifest only; the newest committed run wins."""

from datetime import datetime, timezone

import duckdb
import pytest
from pyspark.sql import functions as F

from checks import run_checks
from cohort_risk import config as C
from cohort_risk.operators import drift
from cohort_risk.plans import monitoring, score, training
from cohort_risk.session import shared_dir
from cohort_risk.sinks import runs

SF = "/root/testdata/sf0.001"


def test_only_committed_runs_are_seen(spark):
    root = shared_dir(spark, "runs")
    assert runs.latest(spark, root) is None
    first = runs.new_run(datetime(2024, 1, 1, tzinfo=timezone.utc))
    runs.write_table(spark.range(3), root, first, "t")
    runs.commit(spark, root, first, {"tables": ["t"], "note": "first"})
    # a later run that fails before its manifest stays invisible
    failed = runs.new_run(datetime(2024, 3, 1, tzinfo=timezone.utc))
    runs.write_table(spark.range(5), root, failed, "t")
    assert runs.latest(spark, root)["note"] == "first"
    assert runs.read_table(spark, root, runs.latest(spark, root), "t").count() == 3
    second = runs.new_run(datetime(2024, 2, 1, tzinfo=timezone.utc))
    runs.write_table(spark.range(7), root, second, "t")
    runs.commit(spark, root, second, {"tables": ["t"], "note": "second"})
    assert [m["note"] for m in runs.committed(spark, root)] == ["first", "second"]
    assert runs.read_table(spark, root, runs.latest(spark, root), "t").count() == 7
    with pytest.raises(KeyError):
        runs.read_table(spark, root, runs.latest(spark, root), "absent")


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(run_checks, "FOREST", C.ForestParams(num_trees=3, max_depth=3))
    monkeypatch.setattr(run_checks, "KERNEL", C.KernelParams(n_components=16, max_iter=5))


def test_training_metadata_equals_sql_and_models_load(spark, small):
    got = sorted(tuple(r) for r in run_checks.training_metadata(spark, SF).collect())
    con = duckdb.connect()
    for name in ("customer", "orders", "lineitem", "nation", "region", "supplier", "part", "events"):
        con.execute(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    want = sorted(tuple(r) for r in con.execute(run_checks.ORACLES["training_metadata"]).fetchall())
    assert got == want and {r[0] for r in got} == {"A", "B"}


def test_run_gives_models_and_reference(spark, small):
    root = shared_dir(spark, "training-runs")
    df = run_checks.enriched(spark, SF)
    manifest = training.train_run(df, root, ["patient_id", "seq"], forest=run_checks.FOREST,
                                  kernel=run_checks.KERNEL)
    for branch in "AB":
        cv = manifest["branches"][branch]["cv"]
        assert set(cv) == {training.FOREST, training.KERNEL} and len(cv[training.FOREST]["fold_scores"]) == 5
    assert training.reference_f1(manifest) == max(manifest["branches"][b]["cv"]["forest"]["mean"] for b in "AB")
    models = training.load_run(spark, root)
    assert set(models) == {"A", "B"} and models["A"].kernel is not None
    assert models["A"].probabilities(df).count() == df.count()
    # every prediction wrong: the F1 rule fires against the committed run's reference
    scored = score.score(df, models["A"], models["B"], F.lit("2024-06-01").cast("timestamp")).withColumn(
        "predicted_class", F.lit(0))
    truth = df.select("patient_id", F.lit(2).alias("true_label"))
    base = drift.compute_baseline(drift.long_features(df))
    decision = monitoring.monitoring_run(df, scored, base, truth=truth, training_root=root).decision.first()
    assert ("F1 degraded" in decision["reasons"]) == (training.reference_f1(manifest) > C.DriftRules().f1_drop)
