"""Stratified folds, hold-out and class weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohort_risk import config as C

PREFIX = 4  # hex digits of the hash, 65,536 parts per class


def _positions(df: DataFrame, label: str, ids: Sequence[str], seed: int,
               prefix: int) -> DataFrame:
    """Add the position of each row in the hash order of its class, and the class size.

    The leading hex digits of the hash cut every class into 16**prefix even, ordered
    parts, so no task sees a whole class. ``ids`` must tell the rows apart.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in ids])
    hashed = (df.filter(F.col(label).isNotNull()).withColumn("__hash", F.md5(text))
              .withColumn("__part", F.substring("__hash", 1, prefix)))
    sizes = hashed.groupBy(label, "__part").agg(F.count("*").alias("__size"))
    before = (Window.partitionBy(label).orderBy("__part")
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select(
        label, "__part",
        F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__offset"),
        F.sum("__size").over(Window.partitionBy(label)).alias("__total"))
    inside = Window.partitionBy(label, "__part").orderBy("__hash", *ids)
    return (hashed.join(offsets, [label, "__part"])
            .withColumn("__pos", F.col("__offset") + F.row_number().over(inside) - 1))


def _fold(k: int) -> Column:
    return (F.col("__pos") % k).cast("int")


def _held_out(fraction: float) -> Column:
    return F.col("__pos") < F.ceil(F.col("__total") * F.lit(fraction))


def stratified_folds(df: DataFrame, label: str, ids: Sequence[str], k: int = C.CV_FOLDS,
                     seed: int = 42, prefix: int = PREFIX, fold: str = "fold") -> DataFrame:
    """Fold 0..k-1 per row; fold sizes differ by at most one row per class."""
    out = _positions(df, label, ids, seed, prefix)
    return out.select(*df.columns, _fold(k).alias(fold))


def stratified_holdout(df: DataFrame, label: str, ids: Sequence[str], fraction: float = 0.2,
                       seed: int = 42, prefix: int = PREFIX, flag: str = "is_test") -> DataFrame:
    """Mark the first ``ceil(fraction * class size)`` rows of each class."""
    out = _positions(df, label, ids, seed, prefix)
    return out.select(*df.columns, _held_out(fraction).alias(flag))


def training_split(df: DataFrame, label: str, ids: Sequence[str], k: int = C.CV_FOLDS,
                   fraction: float = 0.2, seed: int = 42, prefix: int = PREFIX) -> DataFrame:
    """``fold`` and ``is_test`` in one shuffle."""
    out = _positions(df, label, ids, seed, prefix)
    return out.select(*df.columns, _fold(k).alias("fold"), _held_out(fraction).alias("is_test"))


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    return df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n_rows"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights n / (classes * n_c). One row per class."""
    counts = class_distribution(df, label)
    whole = Window.partitionBy(F.lit(0))  # over one row per class
    return counts.withColumn(
        "weight", F.sum("n_rows").over(whole) / (F.count("*").over(whole) * F.col("n_rows")))
