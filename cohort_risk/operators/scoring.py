"""Fusion of branch probabilities into scored records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohort_risk import config as C
from cohort_risk import schemas
from cohort_risk.operators.dedup import keep_first

CLASSES = ["low", "mod", "high"]


def uniform_probabilities(df: DataFrame, branch: str) -> DataFrame:
    """Stand-in for a branch without a model: one third per class."""
    return df.withColumns({f"{branch}_{c}": F.lit(1.0 / 3.0) for c in CLASSES})


def ensemble(df: DataFrame, weights: dict[str, float] = C.ENSEMBLE_WEIGHTS) -> DataFrame:
    """Weighted mean of the branch probabilities: ``p_low``, ``p_mod``, ``p_high``."""
    return df.withColumns({
        f"p_{c}": sum((F.lit(w) * F.col(f"{b}_{c}") for b, w in list(weights.items())[1:]),
                      F.lit(list(weights.values())[0]) * F.col(f"{list(weights)[0]}_{c}"))
        for c in CLASSES})


def first_argmax(columns: Sequence[str]) -> Column:
    best = F.greatest(*[F.col(c) for c in columns])
    out = F.when(F.col(columns[0]) == best, 0)
    for i, c in enumerate(columns[1:], start=1):
        out = out.when(F.col(c) == best, i)
    return out


def _gate(score: Column, field: int) -> Column:
    out = None
    for gate in C.WARNING_GATES:
        cond = (score >= gate[0]) & (score < gate[1])
        out = F.when(cond, gate[field]) if out is None else out.when(cond, gate[field])
    return out.otherwise(C.WARNING_GATES[-1][field])


def signal(a: Column, b: Column, margin: float = C.SIGNAL_MARGIN) -> Column:
    return (F.when(F.abs(a - b) < margin, "both")
            .when(a > b, "current_disease").otherwise("future_risk"))


def scored_records(df: DataFrame, scored_at: Column) -> DataFrame:
    """Scored table from branch probabilities. Gates use the unrounded risk."""
    df = ensemble(df)
    risk, a, b = F.col("p_high"), F.col("a_high"), F.col("b_high")
    predicted = first_argmax(["p_low", "p_mod", "p_high"])
    out = df.withColumns({
        "prob_low": F.round("p_low", 4),
        "prob_moderate": F.round("p_mod", 4),
        "prob_high": F.round("p_high", 4),
        "ensemble_risk_score": F.round(risk, 4),
        "predicted_class": predicted,
        "predicted_label": F.element_at(
            F.array(*[F.lit(n) for n in C.CLASS_NAMES]), predicted + 1),
        "warning_level": _gate(risk, 2),
        "warning_label": _gate(risk, 3),
        "warning_message": _gate(risk, 4),
        "branch_a_score": F.round(a, 4),
        "branch_b_score": F.round(b, 4),
        "signal_type": signal(a, b),
        "scored_at": scored_at,
    })
    return result_schema(out)


def result_schema(df: DataFrame) -> DataFrame:
    """The result columns in fixed order and type; absent ones are NULL."""
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schemas.SCORED])


def align_branches(a: DataFrame, b: DataFrame, keys: Sequence[str],
                   order_by: Sequence[str]) -> DataFrame:
    """Rows of both branch tables by key, one per key.

    Each side is reduced to one row per key before the join, so repeated keys cannot
    multiply. Non-key columns that both sides have are taken from ``a``.
    """
    left = keep_first(a.dropna(subset=list(keys)), keys, order_by)
    right = keep_first(b.dropna(subset=list(keys)), keys, order_by)
    extra = [c for c in right.columns if c not in left.columns]
    return left.join(right.select(*keys, *extra), list(keys))


def common_ids(a: DataFrame, b: DataFrame, key: str = "patient_id") -> DataFrame:
    """Rows of ``a`` whose id also occurs in ``b``."""
    return a.join(b.select(key).distinct(), key, "left_semi")


def level_distribution(scored: DataFrame) -> DataFrame:
    """Count and share per warning level."""
    counts = scored.groupBy("warning_level").agg(F.count("*").alias("n_patients"))
    total = F.sum("n_patients").over(Window.partitionBy(F.lit(0)))  # one row per level
    return counts.withColumn("share", F.col("n_patients") / total)


def top_risk(scored: DataFrame, k: int = 5) -> DataFrame:
    return (scored.orderBy(F.desc("ensemble_risk_score"), "patient_id").limit(k)
            .select("patient_id", "ensemble_risk_score", "warning_level", "warning_label",
                    "signal_type"))
