"""Monitoring run: drift, performance, retraining decision, logs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from cohort_risk import config as C
from cohort_risk.operators import drift, metrics, monitor
from cohort_risk.plans import training
from cohort_risk.session import stored
from cohort_risk.sinks import runs
from cohort_risk.sinks.tables import append_log


@dataclass
class MonitoringRun:
    drift: DataFrame
    performance: DataFrame
    summary: DataFrame
    decision: DataFrame


def monitoring_run(features: DataFrame, scored: DataFrame, baseline: DataFrame,
                   reference_f1: float | None = None, truth: DataFrame | None = None,
                   truth_order: Sequence[str] = ("true_label",), force: bool = False,
                   monitored: Sequence[str] = tuple(C.MONITORED_FEATURES),
                   rules: C.DriftRules = C.DriftRules(),
                   training_root: str | None = None) -> MonitoringRun:
    """Compare current features and scores with the stored baseline.

    ``truth`` holds (patient_id, true_label) where diagnoses are known. Without a given
    ``reference_f1``, the newest committed training run below ``training_root`` supplies it;
    with no committed run the F1 rule doesn't fire.
    """
    if reference_f1 is None and training_root is not None:
        manifest = runs.latest(features.sparkSession, training_root)
        reference_f1 = training.reference_f1(manifest) if manifest else None
    report = stored(drift.detect_drift(drift.long_features(features, monitored), baseline, rules),
                    "drift_report")
    f1 = None
    if truth is not None:
        labelled = monitor.with_truth(scored, truth, truth_order)
        f1 = stored(metrics.macro_f1(labelled, "true_label", "predicted_class"), "f1")
    performance = stored(monitor.performance_metrics(scored, f1), "performance")
    decision = monitor.retrain_decision(report, f1, reference_f1, force, rules)
    return MonitoringRun(report, performance, monitor.monitoring_summary(report, performance),
                         stored(decision, "decision"))


def write_logs(run: MonitoringRun, root: str, run_ts: str) -> None:
    append_log(drift.rounded_report(run.drift), f"{root}/drift_log", run_ts)
    append_log(run.performance, f"{root}/performance_log", run_ts)
    append_log(run.summary, f"{root}/summary", run_ts)
    append_log(run.decision, f"{root}/decision", run_ts)
