"""Scoring runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohort_risk.operators import scoring
from cohort_risk.plans.training import BranchModel


def _branch(df: DataFrame, name: str, model: BranchModel | None) -> DataFrame:
    """Probabilities of one branch; a branch without a model scores one third per class."""
    return model.probabilities(df) if model else scoring.uniform_probabilities(df, name)


def score(enriched: DataFrame, model_a: BranchModel | None, model_b: BranchModel | None,
          scored_at: Column) -> DataFrame:
    """Score enriched rows with both branches in one pass, without a join."""
    out = _branch(_branch(enriched, "a", model_a), "b", model_b)
    return scoring.scored_records(out, scored_at)


def score_tables(table_a: DataFrame, table_b: DataFrame, model_a: BranchModel | None,
                 model_b: BranchModel | None, keys: Sequence[str], order_by: Sequence[str],
                 scored_at: Column) -> DataFrame:
    """Score two separately stored branch tables, aligned by key."""
    aligned = scoring.align_branches(table_a, table_b, keys, order_by)
    return score(aligned, model_a, model_b, scored_at)


def one_patient(enriched: DataFrame, patient_id: str) -> DataFrame:
    """Rows of one patient; the filter reaches the Parquet scan."""
    return enriched.filter(F.col("patient_id") == patient_id)
