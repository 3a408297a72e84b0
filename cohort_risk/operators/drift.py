"""Feature drift: baseline statistics, stability index, Kolmogorov-Smirnov tests.

Everything is computed from distinct values with counts, so a pass over the rows
ends in a map-side combine, whatever the number of rows per feature.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohort_risk import config as C
from cohort_risk.functions.stats import kolmogorov_pvalue, normal_cdf
from cohort_risk.operators.ranks import exact_quantiles, running_totals, value_counts
from cohort_risk.session import stored

DECILES = {f"q{i}": i / 10 for i in range(11)}


def long_features(df: DataFrame, features: Sequence[str] = tuple(C.MONITORED_FEATURES)) -> DataFrame:
    """(feature, value) of the monitored columns that ``df`` has."""
    present = [c for c in features if c in df.columns]
    return df.select(*[F.col(c).cast("double").alias(c) for c in present]).unpivot(
        [], present, "feature", "value")


def moments(counts: DataFrame, n: str = "n") -> DataFrame:
    """Size, mean and sample standard deviation per feature, in two passes over ``counts``."""
    rows = counts.filter(F.col(n) > 0)
    first = rows.groupBy("feature").agg(
        F.sum(n).alias("n"), (F.sum(F.col("value") * F.col(n)) / F.sum(n)).alias("mean"))
    means = first.select("feature", F.col("mean").alias("__mean"))
    spread = (rows.join(means, "feature").groupBy("feature").agg(
        F.sum(F.pow(F.col("value") - F.col("__mean"), 2) * F.col(n)).alias("__ss")))
    return first.join(spread, "feature").select(
        "feature", "n", "mean",
        F.sqrt(F.try_divide(F.col("__ss"), F.col("n") - 1)).alias("std"))


def stored_counts(long: DataFrame) -> DataFrame:
    """Distinct values with counts, written once: several statistics read them."""
    return stored(value_counts(long, ["feature"]), "value_counts")


def baseline_stats(counts: DataFrame, rules: C.DriftRules = C.DriftRules()) -> DataFrame:
    """One row per feature: moments, median, p5, p95 and the distinct decile edges."""
    quantiles = exact_quantiles(
        counts, ["feature"], {**DECILES, "median": 0.5, "p5": 0.05, "p95": 0.95})
    edges = F.array_sort(F.array_distinct(F.array(*DECILES)))
    return (moments(counts).join(quantiles, "feature")
            .select("feature", "mean", "std", "median", "p5", "p95", "n",
                    edges.alias("bin_edges"))
            .filter((F.col("n") >= rules.min_baseline)
                    & (F.size("bin_edges") >= rules.min_edges)))


def bins_of(stats: DataFrame) -> DataFrame:
    """Long form of ``bin_edges``: (feature, bin, low, high, last)."""
    edges = F.col("bin_edges")
    starts = F.posexplode(F.slice(edges, F.lit(1), F.size(edges) - 1)).alias("bin", "low")
    rows = stats.select("feature", "bin_edges", starts)
    return rows.select(
        "feature", "bin", "low",
        F.element_at("bin_edges", F.col("bin") + 2).alias("high"),
        (F.col("bin") == F.size("bin_edges") - 2).alias("last"))


def histogram(counts: DataFrame, bins: DataFrame, n: str = "n",
              name: str = "bin_count") -> DataFrame:
    """Rows per bin, half-open but for the last; values outside are dropped.

    Empty bins are kept with a count of 0.
    """
    value = F.col("value")
    edges = bins
    inside = (counts.join(edges, "feature")
              .filter((value >= F.col("low"))
                      & ((value < F.col("high")) | (F.col("last") & (value == F.col("high"))))))
    hits = inside.groupBy("feature", "bin").agg(F.sum(n).alias(name))
    return (bins.join(hits, ["feature", "bin"], "left")
            .withColumn(name, F.coalesce(name, F.lit(0).cast("bigint"))))


def compute_baseline(long: DataFrame, rules: C.DriftRules = C.DriftRules()) -> DataFrame:
    """Baseline table with ``bin_edges`` and ``bin_counts`` arrays, to be stored."""
    counts = stored_counts(long)
    stats = stored(baseline_stats(counts, rules), "baseline_stats")  # one row per feature
    cells = histogram(counts, bins_of(stats))
    arrays = cells.groupBy("feature").agg(
        F.array_sort(F.collect_list(F.struct("bin", "bin_count"))).alias("__cells"))
    return (stats.join(arrays, "feature")
            .withColumn("bin_counts", F.col("__cells.bin_count")).drop("__cells"))


def baseline_bins(baseline: DataFrame) -> DataFrame:
    """Bins of a stored baseline with their baseline counts."""
    counts = baseline.select("feature", F.posexplode("bin_counts").alias("bin", "baseline_count"))
    return bins_of(baseline).join(counts, ["feature", "bin"])


def psi(bins: DataFrame, counts: DataFrame) -> DataFrame:
    """Population stability index per feature; ``bins`` carry ``baseline_count``."""
    cells = histogram(counts, bins, name="current_count")
    whole = Window.partitionBy("feature")  # a handful of bins per feature

    def share(c: str):
        pct = F.col(c) / (F.sum(c).over(whole) + 1e-10)
        return F.when(F.col(c) == 0, 1e-4).otherwise(pct)

    shares = cells.select("feature", share("baseline_count").alias("b"),
                          share("current_count").alias("c"))
    return shares.groupBy("feature").agg(
        F.sum((F.col("c") - F.col("b")) * F.log(F.col("c") / F.col("b"))).alias("psi"))


def ks_normal(counts: DataFrame, baseline: DataFrame) -> DataFrame:
    """One-sample test of the current values against Normal(mean, std) of the baseline."""
    params = baseline.select("feature", "mean", "std")
    ranked = running_totals(counts, ["feature"], "value", ["n"]).join(params, "feature")
    total = F.col("__total")
    sizes = counts.groupBy("feature").agg(F.sum("n").alias("__total"))
    expected = normal_cdf((F.col("value") - F.col("mean")) / F.col("std"))
    gap = F.greatest(F.col("cum_n") / total - expected,
                     expected - (F.col("cum_n") - F.col("n")) / total)
    out = ranked.join(sizes, "feature").groupBy("feature").agg(
        F.max(gap).alias("ks_stat"), F.max(total).alias("__n"))
    return out.select("feature", "ks_stat",
                      kolmogorov_pvalue(F.col("ks_stat"), F.col("__n")).alias("ks_pval"))


def ks_two_sample(long: DataFrame, is_baseline) -> DataFrame:
    """Two-sample test per feature; ``is_baseline`` tells the samples apart."""
    side = F.coalesce(is_baseline, F.lit(False))
    counts = value_counts(long, ["feature"],
                          weights={"nb": side.cast("int"), "nc": (~side).cast("int")})
    ranked = running_totals(counts, ["feature"], "value", ["nb", "nc"])
    sizes = counts.groupBy("feature").agg(
        F.sum("nb").alias("__b"), F.sum("nc").alias("__c"))
    gap = F.abs(F.try_divide(F.col("cum_nb"), F.col("__b"))
                - F.try_divide(F.col("cum_nc"), F.col("__c")))
    out = ranked.join(sizes, "feature").groupBy("feature").agg(
        F.max(gap).alias("ks_stat"), F.max("__b").alias("n_baseline"),
        F.max("__c").alias("n_current"))
    effective = F.col("n_baseline") * F.col("n_current") / (
        F.col("n_baseline") + F.col("n_current"))
    return out.select("feature", "ks_stat", "n_baseline", "n_current",
                      kolmogorov_pvalue(F.col("ks_stat"), effective).alias("ks_pval"))


def detect_drift(current: DataFrame, baseline: DataFrame,
                 rules: C.DriftRules = C.DriftRules()) -> DataFrame:
    """Drift report of the current values against a baseline table, unrounded.

    Features with fewer than ``rules.min_current`` values are left out.
    """
    counts = stored_counts(current)
    means = counts.groupBy("feature").agg(
        F.sum("n").alias("n_current"),
        (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("current_mean"),
    ).filter(F.col("n_current") >= rules.min_current)
    joined = (means
              .join(baseline.select("feature", F.col("mean").alias("baseline_mean")), "feature")
              .join(psi(baseline_bins(baseline), counts), "feature")
              .join(ks_normal(counts, baseline), "feature"))
    shift = (F.abs(F.col("current_mean") - F.col("baseline_mean"))
             / (F.abs("baseline_mean") + 1e-10) * 100)
    status = (F.when((F.col("psi") > rules.psi_alert) | (F.col("ks_pval") < rules.ks_pvalue),
                     "alert")
              .when(F.col("psi") > rules.psi_warn, "warn").otherwise("ok"))
    return joined.select(
        "feature", "psi", "ks_stat", "ks_pval", shift.alias("mean_shift_pct"),
        "current_mean", "baseline_mean", "n_current", status.alias("status"))


def rounded_report(report: DataFrame) -> DataFrame:
    """The report with the digits it is published with."""
    digits = {"psi": 4, "ks_stat": 4, "ks_pval": 4, "mean_shift_pct": 2,
              "current_mean": 3, "baseline_mean": 3}
    return report.withColumns({c: F.round(c, d) for c, d in digits.items()})


def top_drift(report: DataFrame, k: int = 5) -> DataFrame:
    return report.orderBy(F.desc("psi"), "feature").limit(k)
