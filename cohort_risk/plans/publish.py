"""Publish run: the four reporting views and their sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohort_risk.operators import views
from cohort_risk.plans.monitoring import MonitoringRun
from cohort_risk.sinks import tables


def reporting_views(scored: DataFrame, pop_long: DataFrame | None, importances: DataFrame,
                    run: MonitoringRun, timestamp: Column) -> dict[str, DataFrame]:
    return {
        "patient_risk_scores": views.patient_scores(scored),
        "population_risk_heatmap": views.population_heatmap(scored, pop_long, timestamp),
        "feature_importance_view": views.feature_importance(importances)
        .withColumn("extracted_at", timestamp),
        "model_health_view": views.model_health(
            run.performance, run.drift, run.summary, run.decision, timestamp)
        .withColumn("value", F.round("value", 4)),
    }


def write_views(published: dict[str, DataFrame], root: str, snapshot_ts: str,
                csv: bool = True) -> None:
    for name, df in published.items():
        tables.write_snapshot(df, f"{root}/{name}", snapshot_ts)
    if csv:
        tables.write_csv_exports(published, f"{root}/csv/{snapshot_ts}")
