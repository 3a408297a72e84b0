"""Reporting views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohort_risk import config as C
from cohort_risk.functions import scalars as S


def patient_scores(scored: DataFrame) -> DataFrame:
    """View 1: scored rows with tier, dominant branch and time parts."""
    return scored.withColumns({
        "risk_tier": S.risk_tier("ensemble_risk_score"),
        "branch_a_dominant": S.truth(F.col("branch_a_score") > F.col("branch_b_score")),
        "scored_date": F.date_format("scored_at", "yyyy-MM-dd"),
        "scored_hour": F.hour("scored_at"),
    })


def indicator_means(pop_long: DataFrame,
                    indicators: Sequence[str] = tuple(C.HEATMAP_INDICATORS)) -> DataFrame:
    """Mean of the key indicators per country, one column each."""
    wanted = pop_long.filter(F.col("feature_name").isin(*indicators)
                             & F.col("country_iso3").isNotNull())
    return wanted.groupBy("country_iso3").agg(
        *[F.avg(F.when(F.col("feature_name") == i, F.col("value"))).alias(i)
          for i in indicators])


def population_heatmap(scored: DataFrame, pop_long: DataFrame | None = None,
                       updated_at: Column | None = None) -> DataFrame:
    """View 2: scores per country, age band and sex, NULL strata kept."""
    level = F.col("warning_level")

    def share(cond: Column) -> Column:
        # a row without a level counts as "not in this level"
        return F.avg(F.coalesce(cond, F.lit(False)).cast("double"))

    def mean(score: str) -> Column:
        # scores carry four digits; summed as integers the mean does not depend on row order
        return F.sum(F.round(F.col(score) * 10000).cast("bigint")) / F.count(score) / 10000

    out = scored.groupBy("country_iso3", "age_group_bin", "sex").agg(
        F.count("patient_id").alias("n_patients"),
        F.round(mean("ensemble_risk_score"), 4).alias("mean_risk_score"),
        *[share(level == i).alias(f"pct_warning_level_{i}") for i in range(1, 5)],
        F.round(share(level >= 3), 4).alias("pct_high_risk"),
        F.round(mean("branch_a_score"), 4).alias("mean_branch_a_score"),
        F.round(mean("branch_b_score"), 4).alias("mean_branch_b_score"),
        F.mode("signal_type", True).alias("dominant_signal"))
    if updated_at is not None:
        out = out.withColumn("updated_at", updated_at)
    if pop_long is not None:
        # both sides are aggregates; adaptive execution picks the join
        out = out.join(indicator_means(pop_long), "country_iso3", "left")
    return out


def feature_importance(importances: DataFrame) -> DataFrame:
    """View 3: rank and share of each feature within its branch.

    The input has one row per branch and feature, so a window holds one branch list.
    """
    branch = Window.partitionBy("branch")
    rows = importances.withColumn("importance", F.round("importance", 5))
    return rows.select(
        "branch", S.lookup("branch", C.BRANCH_LABELS).alias("branch_label"), "feature",
        "importance",
        F.rank().over(branch.orderBy(F.desc("importance"))).alias("rank"),
        F.round(F.col("importance") / F.sum("importance").over(branch) * 100, 2)
        .alias("pct_of_total"),
        S.clinical_group("feature").alias("clinical_group"))


def top_importances(importances: DataFrame, k: int = 5) -> DataFrame:
    """First ``k`` features per branch by importance."""
    ranked = Window.partitionBy("branch").orderBy(F.desc("importance"), "feature")
    return (importances.withColumn("position", F.row_number().over(ranked))
            .filter(F.col("position") <= k))


def model_health(performance: DataFrame, report: DataFrame, summary: DataFrame,
                 retrain: DataFrame, timestamp: Column,
                 rules: C.DriftRules = C.DriftRules()) -> DataFrame:
    """View 4: performance, drift and summary rows in one long table.

    ``retrain`` is the one-row decision; its flag is attached as a scalar subquery.
    """
    names = ["high_risk_rate", "risk_score_mean", "branch_divergence_mean"]
    perf = performance.select(*[F.coalesce(n, F.lit(0.0)).alias(n) for n in names]).unpivot(
        [], names, "metric_name", "value")
    diverged = ((F.col("metric_name") == "branch_divergence_mean")
                & (F.col("value") > rules.divergence_warn))
    rows = perf.select(F.lit("performance").alias("metric_type"), "metric_name", "value",
                       F.when(diverged, "warn").otherwise("ok").alias("status"))
    rows = rows.unionByName(report.select(
        F.lit("drift").alias("metric_type"), F.col("feature").alias("metric_name"),
        F.col("psi").alias("value"), "status"))
    rows = rows.unionByName(summary.select(
        F.lit("summary").alias("metric_type"), F.col("metric").alias("metric_name"),
        "value", F.lit("ok").alias("status")))
    flag = retrain.select("retrain_triggered").scalar()
    return rows.withColumns({"timestamp": timestamp, "retrain_triggered": flag})
