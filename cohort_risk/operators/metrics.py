"""Classification metrics from counts, optionally per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohort_risk import config as C
from cohort_risk.operators.ranks import running_totals


def confusion_matrix(df: DataFrame, truth: str, pred: str,
                     groups: Sequence[str] = ()) -> DataFrame:
    """Counts per (truth, prediction) over the labelled rows."""
    return (df.filter(F.col(truth).isNotNull())
            .groupBy(*groups, F.col(truth).cast("int").alias("truth"),
                     F.col(pred).cast("int").alias("pred"))
            .agg(F.count("*").alias("n_rows")))


def class_report(confusion: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Precision, recall and F1 per class that occurs as truth or prediction."""
    n, zero = F.col("n_rows"), F.lit(0).cast("bigint")
    hit = F.when(F.col("truth") == F.col("pred"), n).otherwise(zero)
    sides = F.array(
        F.struct(F.col("truth").alias("label"), hit.alias("tp"), n.alias("support"),
                 zero.alias("predicted")),
        F.struct(F.col("pred").alias("label"), zero.alias("tp"), zero.alias("support"),
                 n.alias("predicted")))
    per_class = (confusion.select(*groups, F.inline(sides))
                 .filter(F.col("label").isNotNull()).groupBy(*groups, "label")
                 .agg(*[F.sum(c).alias(c) for c in ["tp", "support", "predicted"]]))

    def ratio(top: Column, bottom: Column) -> Column:
        return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))

    return per_class.select(
        *groups, "label",
        ratio(F.col("tp"), F.col("predicted")).alias("precision"),
        ratio(F.col("tp"), F.col("support")).alias("recall"),
        ratio(2 * F.col("tp"), F.col("support") + F.col("predicted")).alias("f1"),
        "support")


def macro_f1(df: DataFrame, truth: str, pred: str, groups: Sequence[str] = ()) -> DataFrame:
    """Accuracy and unweighted mean F1 over the labelled rows."""
    report = class_report(confusion_matrix(df, truth, pred, groups), groups)
    hits = F.sum(F.round(F.col("recall") * F.col("support")))
    return report.groupBy(*groups).agg(
        (hits / F.sum("support")).alias("accuracy"),
        F.avg("f1").alias("f1_macro"),
        F.sum("support").alias("n_rows"))


def roc_auc_by_class(df: DataFrame, truth: str, probs: Sequence[str],
                     groups: Sequence[str] = ()) -> DataFrame:
    """One-vs-rest area under the curve per class, ties counted half.

    Scores are combined to distinct values first, then ranked by running totals.
    """
    cells = F.array(*[F.struct(F.lit(i).alias("label"), F.col(p).alias("score"),
                               (F.col(truth) == i).alias("hit"))
                      for i, p in enumerate(probs)])
    counts = (df.filter(F.col(truth).isNotNull())
              .select(*groups, F.inline(cells))
              .groupBy(*groups, "label", (F.col("score") + F.lit(0.0)).alias("score"))
              .agg(F.count_if("hit").alias("pos"), F.count_if(~F.col("hit")).alias("neg")))
    ranked = running_totals(counts, [*groups, "label"], "score", ["pos", "neg"])
    below = F.col("cum_neg") - F.col("neg")
    return (ranked.groupBy(*groups, "label")
            .agg(F.sum(F.col("pos") * (below + F.col("neg") / 2)).alias("__u"),
                 F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
            .select(*groups, "label", "n_pos", "n_neg",
                    F.try_divide(F.col("__u"), F.col("n_pos") * F.col("n_neg")).alias("auc")))


def roc_auc_macro(df: DataFrame, truth: str, probs: Sequence[str],
                  groups: Sequence[str] = ()) -> DataFrame:
    """Mean over the classes; 0 when a class has no positives or no negatives."""
    per_class = roc_auc_by_class(df, truth, probs, groups)
    return per_class.groupBy(*groups).agg(
        F.when(F.count("auc") == len(probs), F.avg("auc")).otherwise(0.0).alias("roc_auc"))


def primary_model(metrics: DataFrame, preferred: str = "forest") -> DataFrame:
    """Per branch the model with the best macro F1, ``preferred`` on ties."""
    return metrics.groupBy("branch").agg(
        F.max_by("model", F.struct(
            F.col("f1_macro"), (F.col("model") == preferred).cast("int"), F.col("model")
        )).alias("primary_model"))
