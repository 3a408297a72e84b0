"""Performance proxies and the retraining decision."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_risk import config as C
from cohort_risk.operators.dedup import keep_first

WARNING_LEVELS = (1, 2, 3, 4)


def performance_metrics(scored: DataFrame, f1: DataFrame | None = None) -> DataFrame:
    """One row of score statistics and shares of the warning levels.

    Scores carry four digits, so the exact percentile sees at most 10,001 values. ``f1`` is
    a one-row frame with ``f1_macro`` against known diagnoses; without it the column is NULL.
    """
    score = F.round("ensemble_risk_score", 4)
    row = scored.agg(
        *[F.avg((F.col("warning_level") == level).cast("double")).alias(f"level_share_{level}")
          for level in WARNING_LEVELS],
        F.avg((F.col("warning_level") >= 3).cast("double")).alias("high_risk_rate"),
        F.avg(F.abs(F.col("branch_a_score") - F.col("branch_b_score")))
        .alias("branch_divergence_mean"),
        F.avg("branch_a_score").alias("branch_a_mean"),
        F.avg("branch_b_score").alias("branch_b_mean"),
        F.avg("ensemble_risk_score").alias("risk_score_mean"),
        F.stddev_samp("ensemble_risk_score").alias("risk_score_std"),
        F.percentile(score, F.lit(0.9)).alias("risk_score_p90"),
        F.count("*").alias("n_scored"))
    known = F.lit(None).cast("double") if f1 is None else f1.select("f1_macro").scalar()
    return row.withColumn("f1_macro_vs_groundtruth", known)


def monitoring_summary(report: DataFrame, performance: DataFrame) -> DataFrame:
    """(metric, value): monitored features by status and the high-risk rate."""
    counts = report.agg(
        F.count("*").cast("double").alias("n_features_monitored"),
        *[F.count_if(F.col("status") == s).cast("double").alias(f"n_features_{s}")
          for s in ["alert", "warn", "ok"]])
    rate = performance.select(F.coalesce("high_risk_rate", F.lit(0.0)).alias("high_risk_rate"))
    return (counts.unpivot([], counts.columns, "metric", "value")
            .unionByName(rate.unpivot([], rate.columns, "metric", "value")))


def retrain_decision(report: DataFrame, f1: DataFrame | None = None,
                     reference_f1: float | None = None, force: bool = False,
                     rules: C.DriftRules = C.DriftRules()) -> DataFrame:
    """One row: trigger, number of alerts and warnings, reasons.

    ``f1`` is a one-row frame with ``f1_macro`` of the current run. The F1 rule is an
    absolute drop against ``reference_f1``.
    """
    position = F.coalesce(F.nullif(F.array_position(
        F.array(*[F.lit(c) for c in C.MONITORED_FEATURES]), F.col("feature")), F.lit(0)),
        F.lit(len(C.MONITORED_FEATURES) + 1))

    def names(status: str):
        # bounded by the number of monitored features
        found = F.array_sort(F.collect_list(F.when(
            F.col("status") == status, F.struct(position.alias("p"), "feature"))))
        quoted = F.transform(found["feature"], lambda x: F.concat(F.lit("'"), x, F.lit("'")))
        return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))

    drift = report.agg(
        F.count_if(F.col("status") == "alert").alias("n_alert"),
        F.count_if(F.col("status") == "warn").alias("n_warn"),
        names("alert").alias("__alert"), names("warn").alias("__warn"),
    ).select(
        "n_alert", "n_warn",
        F.when(F.col("n_alert") >= 1,
               F.concat(F.lit("PSI/KS alert on features: "), "__alert")).alias("r1"),
        F.when(F.col("n_warn") >= rules.max_warn_features,
               F.concat(F.lit(f"{rules.max_warn_features}+ features in warn state: "), "__warn")
               ).alias("r2"),
        F.lit(None).cast("string").alias("r3"))
    parts = drift
    if f1 is not None and reference_f1 is not None:
        drop = F.lit(float(reference_f1)) - F.col("f1_macro")
        text = F.format_string("F1 degraded by %.3f (ref=%.3f -> current=%.3f)",
                               drop, F.lit(float(reference_f1)), F.col("f1_macro"))
        parts = drift.unionByName(
            f1.select(F.when(drop > rules.f1_drop, text).alias("r3")), allowMissingColumns=True)
    forced = F.when(F.lit(force), "manual force_retrain flag")
    return parts.agg(
        *[F.max(c).alias(c) for c in ["n_alert", "n_warn", "r1", "r2", "r3"]]
    ).select(
        "n_alert", "n_warn",
        F.concat_ws("; ", "r1", "r2", "r3", forced).alias("reasons"),
    ).withColumn("retrain_triggered", F.col("reasons") != "")


def with_truth(scored: DataFrame, truth: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Scored rows with ``true_label`` where known; one label per patient."""
    labels = keep_first(truth.filter(F.col("patient_id").isNotNull()), ["patient_id"], order_by)
    base = scored.drop("true_label")
    known = labels.select("patient_id", "true_label")
    return base.join(known, "patient_id", "left")
