"""Keep-first deduplication and top-k per group.

``row_number() <= k`` lets Spark put a window group limit in front of the shuffle:
every task keeps at most k rows per key, so a key that holds a third of all rows
sends k rows per task, not the rows themselves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(order_by: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order_by]


def top_per_group(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str],
                  k: int | None = 1, rank: str | None = None) -> DataFrame:
    """First ``k`` rows per key in the given total order; NULL keys form one group.

    Without ``k`` all rows stay, ranked.
    """
    name = rank or "__rank"
    window = Window.partitionBy(*keys).orderBy(*_order(order_by))
    out = df.withColumn(name, F.row_number().over(window))
    if k is not None:
        out = out.filter(F.col(name) <= k)
    return out if rank else out.drop(name)


def keep_first(df: DataFrame, keys: Sequence[str],
               order_by: Sequence[Column | str]) -> DataFrame:
    """One row per key, the first in ``order_by``; keys absent from ``df`` are ignored."""
    present = [c for c in keys if c in df.columns]
    return top_per_group(df, present, order_by) if present else df


def first_with_count(df: DataFrame, keys: Sequence[str], order_by: Sequence[str],
                     columns: Sequence[str], count: str = "n_rows") -> DataFrame:
    """First row per key plus the size of its group, in a single aggregation."""
    present = [c for c in keys if c in df.columns]
    rest = [c for c in columns if c not in present]
    payload = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order_by)],
                       *[F.col(c) for c in rest if c not in order_by])
    grouped = df.groupBy(*present).agg(F.count("*").alias(count), F.min(payload).alias("__f"))
    ordered = {c: f"o{i}" for i, c in enumerate(order_by)}
    return grouped.select(
        *present, count,
        *[F.col(f"__f.{ordered.get(c, c)}").alias(c) for c in rest])
