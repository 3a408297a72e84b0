"""Exact order statistics without a global sort or a single-task window.

Input is always a table of distinct values with counts, so repeated values are
combined on the map side. Values are then cut into order-preserving buckets: first
by magnitude, then each bucket with more values than a task should sort is split at
cut points that a quantile summary picks. The summary (Greenwald-Khanna, as
``percentile_approx`` keeps it) is built in each task and merged, so crowded values
beside a few far ones still spread evenly over the parts. The totals per bucket form a small
table whose running sum gives every bucket its offset; the running sum inside a
bucket is an ordinary window over that bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


BUCKETS_PER_OCTAVE = 1024
#: Distinct values that a bucket should hold.
BUCKET_VALUES = 20_000
#: Parts of one magnitude bucket at most; each row of it is compared with its cut points.
MAX_PARTS = 1024
#: Grid points of the quantile summary per part of the largest bucket.
RESOLUTION = 16
_BUCKET = ["__bucket", "__part"]


def order_bucket(value: Column, per_octave: int = BUCKETS_PER_OCTAVE) -> Column:
    """Bucket number that never decreases as ``value`` grows.

    The logarithmic scale needs no pass for the range and no outlier can push the
    other values into one bucket.
    """
    shift = 1075 * per_octave + 1
    magnitude = F.floor(F.least(F.log2(F.abs(value)), F.lit(1100.0)) * per_octave) + shift
    bucket = F.when(value > 0, magnitude).when(value < 0, -magnitude)
    # never NULL, so joins on it add no filter that would keep plans from sharing a shuffle
    return F.coalesce(bucket, F.lit(0).cast("bigint"))


def _cut(counts: DataFrame, groups: Sequence[str], value: str,
         bucket_values: int = BUCKET_VALUES) -> DataFrame:
    """Add the two bucket columns; together they never decrease as ``value`` grows.

    A bucket of n values gets ceil(n / bucket_values) parts, at most ``MAX_PARTS``. The
    summaries of all large buckets share one grid of ``RESOLUTION`` points per part of the
    largest bucket; each bucket takes the grid points nearest its own k / parts. Only that
    largest count reaches the driver. Beyond ``MAX_PARTS`` parts grow, still even; ranks
    stay exact at any size.
    """
    coarse = counts.withColumn("__bucket", order_bucket(F.col(value)))
    shape = coarse.groupBy(*groups, "__bucket").agg(
        F.least(F.ceil(F.count("*") / bucket_values), F.lit(MAX_PARTS)).alias("__parts")).filter("__parts > 1")
    finest = shape.agg(F.max("__parts")).first()[0]
    if not finest:
        return coarse.withColumn("__part", F.lit(0).cast("bigint"))
    size = RESOLUTION * finest
    grid = [k / size for k in range(1, size)]
    summaries = (coarse.join(shape, [*groups, "__bucket"])
                 .groupBy(*groups, "__bucket", "__parts")
                 .agg(F.percentile_approx(value, grid, max(10_000, 2 * size)).alias("__grid")))
    points = summaries.select(*groups, "__bucket", F.transform(
        F.sequence(F.lit(1), F.col("__parts") - 1),
        lambda k: F.element_at("__grid", F.round(k * size / F.col("__parts")).cast("int"))).alias("__points"))
    part = F.size(F.filter("__points", lambda p: p < F.col(value)))
    return (coarse.join(points, [*groups, "__bucket"], "left")
            .withColumn("__part", F.coalesce(part, F.lit(0)).cast("bigint"))
            .drop("__points"))


def value_counts(long: DataFrame, groups: Sequence[str], value: str = "value",
                 weights: dict[str, Column] | None = None) -> DataFrame:
    """Distinct non-null values per group with their counts."""
    weights = weights or {"n": F.lit(1)}
    return (long.filter(F.col(value).isNotNull())
            # -0.0 and 0.0 are the same value
            .groupBy(*groups, (F.col(value) + F.lit(0.0)).alias(value))
            .agg(*[F.sum(w.cast("bigint")).alias(name) for name, w in weights.items()]))


def running_totals(counts: DataFrame, groups: Sequence[str], value: str,
                   columns: Sequence[str]) -> DataFrame:
    """Add ``cum_<column>``: the total over all values up to and including this one."""
    cut = _cut(counts, groups, value)
    by_bucket = cut.groupBy(*groups, *_BUCKET).agg(
        *[F.sum(c).alias(c) for c in columns])
    before = (Window.partitionBy(*groups).orderBy(*_BUCKET)
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = by_bucket.select(
        *groups, *_BUCKET,
        *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"__off_{c}") for c in columns])
    inside = Window.partitionBy(*groups, *_BUCKET).orderBy(value)
    return (cut.join(offsets, [*groups, *_BUCKET])
            .select(*groups, value, *columns,
                    *[(F.col(f"__off_{c}") + F.sum(c).over(inside)).alias(f"cum_{c}")
                      for c in columns]))


def exact_quantiles(counts: DataFrame, groups: Sequence[str], probs: dict[str, float],
                    value: str = "value", count: str = "n") -> DataFrame:
    """Linearly interpolated quantiles per group, one column per entry of ``probs``.

    Only the buckets that hold a wanted rank are sorted.
    """
    cut = _cut(counts, groups, value)
    by_bucket = cut.groupBy(*groups, *_BUCKET).agg(F.sum(count).alias("__size"))
    running = Window.partitionBy(*groups).orderBy(*_BUCKET)
    located = (by_bucket
               .withColumn("__end", F.sum("__size").over(running))
               .withColumn("__total", F.sum("__size").over(Window.partitionBy(*groups)))
               .withColumn("__start", F.col("__end") - F.col("__size")))
    listed = ", ".join(f"{float(p)!r}D" for p in probs.values())
    ranks = (f"flatten(transform(array({listed}), "
             "p -> array(floor(p * (__total - 1)), ceil(p * (__total - 1)))))")
    wanted = (located.withColumn("__ranks", F.expr(
        f"filter(array_distinct({ranks}), r -> r >= __start AND r < __end)"))
        .filter("size(__ranks) > 0"))
    inside = Window.partitionBy(*groups, *_BUCKET).orderBy(value)
    # at most two buckets per group and quantile: the other values are dropped before
    # anything is shuffled again
    ranked = (cut.join(wanted, [*groups, *_BUCKET])
              .withColumn("__hi", F.col("__start") + F.sum(count).over(inside))
              .withColumn("__lo", F.col("__hi") - F.col(count)))
    hits = ranked.select(*groups, value, "__total", F.explode(
        F.expr("filter(__ranks, r -> r >= __lo AND r < __hi)")).alias("__rank"))
    # two ranks per wanted quantile, so the map is small
    picked = hits.groupBy(*groups).agg(
        F.max("__total").alias("__total"),
        F.map_from_entries(F.collect_list(F.struct("__rank", value))).alias("__at"))

    def interpolated(p: float) -> Column:
        pos = f"({float(p)!r}D * (__total - 1))"
        return F.expr(f"__at[floor{pos}] + (__at[ceil{pos}] - __at[floor{pos}]) "
                      f"* ({pos} - floor{pos})")

    return picked.select(*groups, *[interpolated(p).alias(n) for n, p in probs.items()])


def value_modes(counts: DataFrame, groups: Sequence[str], value: str = "value",
                count: str = "n", name: str = "mode") -> DataFrame:
    """Most frequent value per group, the smallest on ties."""
    return counts.groupBy(*groups).agg(
        F.max_by(value, F.struct(F.col(count), -F.col(value))).alias(name))
