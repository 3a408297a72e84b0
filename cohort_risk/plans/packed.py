"""Prepared rows of a branch as blocks of bytes, for fits that compute in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohort_risk.session import stored

#: Bins of a feature, as many as Spark ML's forests take by default.
BINS = 32
#: Most values of a feature that are counted one by one to place its cuts.
MOST_VALUES = 4096
#: Marks of a row: its fold, and whether it is held out from the final models.
HELD_OUT = 128
#: The final model's place among the fits; the others are numbered by the fold they leave out.
FINAL = -1

_BLOCKS = "block long, x binary, codes binary, y binary, marks binary"


def codes_type(n_classes: int):
    return np.uint8 if n_classes * BINS <= 256 else np.uint16


def cut_points(rows: DataFrame, n_features: int, weight: Column | None = None) -> list[np.ndarray]:
    """Candidate thresholds per feature, at most ``BINS`` - 1, so that bins have even weights.

    As in Spark ML they lie halfway between values, but all rows are counted, not 10,000.
    Features of more than ``MOST_VALUES`` values take approximate quantiles.
    """
    x = vector_to_array("__scaled")
    flat = rows.select(*[x[i].alias(f"x{i}") for i in range(n_features)])
    probs = [i / BINS for i in range(1, BINS)]
    found = flat.agg(*[F.percentile_approx(f"x{i}", probs, 10000).alias(f"q{i}") for i in range(n_features)],
                     *[F.approx_count_distinct(f"x{i}").alias(f"n{i}") for i in range(n_features)]).first()
    few = [i for i in range(n_features) if found[f"n{i}"] <= MOST_VALUES]

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, n_features)
            w = batch.column("w").to_numpy(zero_copy_only=False)
            for i in few:
                values, place = np.unique(x[:, i], return_inverse=True)
                yield pa.RecordBatch.from_pydict({
                    "i": pa.array(np.full(len(values), i), pa.int32()), "value": pa.array(values),
                    "w": pa.array(np.bincount(place, w, len(values)))})

    weighed = rows.select(x.alias("x"), (F.lit(1.0) if weight is None else weight).cast("double").alias("w"))
    values = weighed.mapInArrow(counts, "i int, value double, w double").groupBy("i", "value").agg(
        F.sum("w").alias("w")).orderBy("i", "value").toPandas()
    cuts = []
    for i in range(n_features):
        own = values[values["i"] == i]
        cuts.append(_even_cuts(own["value"].to_numpy(), own["w"].to_numpy()) if i in few
                    else np.unique(found[f"q{i}"]))
    return cuts


def _even_cuts(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Spark ML's choice: a cut is where the running weight is nearest to a multiple of the stride."""
    middles = (values[1:] + values[:-1]) / 2
    if len(middles) < BINS:
        return middles
    running, stride = np.cumsum(weights), weights.sum() / BINS
    target, cuts = stride, []
    for i, middle in enumerate(middles):
        if abs(running[i] - target) < abs(running[i + 1] - target):
            cuts.append(middle)
            target += stride
    return np.array(cuts[:BINS - 1])


def pack(rows: DataFrame, label: str, cuts: list[np.ndarray], n_classes: int) -> DataFrame:
    """Stored blocks: inputs, bins (class x BINS + bin, row by row), classes and marks of their rows."""
    kind = codes_type(n_classes)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        at = TaskContext.get().partitionId() << 32
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            y = batch.column("y").to_numpy(zero_copy_only=False).astype(np.uint8)
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(n, len(cuts))
            codes = np.empty((n, len(cuts)), kind)
            for i, cut in enumerate(cuts):
                codes[:, i] = np.searchsorted(cut, x[:, i], side="left")
            codes += (y.astype(kind) * BINS)[:, None]
            marks = batch.column("marks").to_numpy(zero_copy_only=False).astype(np.uint8)
            yield pa.RecordBatch.from_pydict({
                "block": pa.array([at], pa.int64()),
                **{k: pa.array([v.tobytes()], pa.binary()) for k, v in
                   (("x", x), ("codes", codes), ("y", y), ("marks", marks))}})
            at += 1

    narrow = rows.select(
        vector_to_array("__scaled").alias("x"), F.col(label).cast("int").alias("y"),
        (F.col("fold") + F.when(F.col("is_test"), HELD_OUT).otherwise(0)).alias("marks"))
    return stored(narrow.mapInArrow(blocks, _BLOCKS), "packed")


def trained_on(marks: np.ndarray, fit: int) -> np.ndarray:
    """Mask of the rows that a fit trains on."""
    return marks < HELD_OUT if fit == FINAL else (marks & (HELD_OUT - 1)) != fit


def held_out(marks: np.ndarray, fit: int) -> np.ndarray:
    """Mask of the rows that a fold's fit is judged on; the final model is judged elsewhere."""
    return np.zeros(len(marks), bool) if fit == FINAL else (marks & (HELD_OUT - 1)) == fit
