"""Row validation with reject reasons, and the quality report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohort_risk import config as C
from cohort_risk.functions import scalars as S
from cohort_risk.operators.dedup import first_with_count, keep_first


def reject_flags(df: DataFrame, required: Sequence[str] = tuple(C.REQUIRED_COLUMNS),
                 ranges: Mapping[str, tuple[float, float]] = C.CLINICAL_RANGES
                 ) -> dict[str, Column]:
    """Reason -> condition. A required value is tested raw, a range on the number."""
    flags = {f"null_{c}": F.col(c).isNull() for c in required if c in df.columns}
    for c, (low, high) in ranges.items():
        if c in df.columns:
            number = S.lenient_double(df, c)
            flags[f"range_{c}"] = F.coalesce((number < low) | (number > high), F.lit(False))
    return flags


def with_reject(df: DataFrame, flags: Mapping[str, Column]) -> DataFrame:
    """Add ``_reject``: the reasons joined by ``"; "``, empty for a clean row."""
    return df.withColumn(
        "_reject", F.concat_ws("; ", *[F.when(cond, name) for name, cond in flags.items()]))


def tag_individual(df: DataFrame, order_by: Sequence[str], **rules) -> DataFrame:
    """Keep-first deduplication, then reject reasons per row."""
    first = keep_first(df, C.INDIVIDUAL_DEDUP_KEYS, order_by)
    return with_reject(first, reject_flags(first, **rules))


def clean_rows(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col("_reject") == "").drop("_reject")


def quarantined_rows(tagged: DataFrame, name: str) -> DataFrame:
    return tagged.filter(F.col("_reject") != "").withColumn("_source", F.lit(name))


def validate_individual(df: DataFrame, order_by: Sequence[str], name: str = "individual",
                        **rules) -> tuple[DataFrame, DataFrame]:
    """(clean, quarantine). Both come from one tagged frame; see ``sinks.write_validated``
    for writing them in a single pass."""
    tagged = tag_individual(df, order_by, **rules)
    return clean_rows(tagged), quarantined_rows(tagged, name)


def population_flags(df: DataFrame, years: tuple[int, int] = C.YEAR_RANGE) -> dict[str, Column]:
    flags = {}
    if "value" in df.columns:
        flags["null_value"] = F.col("value").isNull()
    if "year" in df.columns:
        year = S.lenient_int(df, "year")
        flags["range_year"] = F.coalesce((year < years[0]) | (year > years[1]), F.lit(False))
    return flags


def validate_population(df: DataFrame, order_by: Sequence[str],
                        keys: Sequence[str] = tuple(C.POPULATION_DEDUP_KEYS_WIDE),
                        reject_before_dedup: bool = True) -> DataFrame:
    """Drop null values and impossible years, keep the first row per key.

    With ``reject_before_dedup=False`` a rejected first row also removes its valid
    twins, since the deduplication then runs over all rows.
    """
    tagged = with_reject(df, population_flags(df))
    if "year" in df.columns:
        tagged = tagged.withColumn("year", S.lenient_int(df, "year"))
    if reject_before_dedup:
        return keep_first(clean_rows(tagged), keys, order_by)
    return clean_rows(keep_first(tagged, keys, order_by))


def validate_environment(df: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Drop null readings, keep one reading per station, parameter and time."""
    return keep_first(df.filter(F.col("value").isNotNull()), C.ENVIRONMENT_KEYS, order_by)


def environment_flags(df: DataFrame) -> dict[str, Column]:
    """Reason -> condition for a reading: a missing value or time."""
    return {f"null_{c}": F.col(c).isNull() for c in ("value", "measured_at") if c in df.columns}


def validate_environment_rows(df: DataFrame, order_by: Sequence[str],
                              name: str = "environment") -> tuple[DataFrame, DataFrame]:
    """(clean, quarantine) of readings: rejected rows with their reasons, and the first clean
    reading per station, parameter and time. Clean rows equal :func:`validate_environment`
    where every reading has a time."""
    tagged = with_reject(df, environment_flags(df))
    return keep_first(clean_rows(tagged), C.ENVIRONMENT_KEYS, order_by), quarantined_rows(tagged, name)


def environment_report(df: DataFrame, name: str = "environment") -> DataFrame:
    """Report ``(dataset, metric, column, value)`` of :func:`validate_environment_rows`.

    One aggregation by key (partial on the map side) and one over the keys: a key's clean
    rows beyond the first are duplicates.
    """
    flags = environment_flags(df)
    bad = F.lit(False)
    for cond in flags.values():
        bad = bad | cond
    per_key = df.groupBy(*[c for c in C.ENVIRONMENT_KEYS if c in df.columns]).agg(
        F.count_if(~bad).alias("__clean"), F.count_if(bad).alias("__bad"),
        *[F.count_if(cond).alias(f"__{reason}") for reason, cond in flags.items()])
    aggs = {
        "total_rows": F.coalesce(F.sum(F.col("__clean") + F.col("__bad")), F.lit(0)),
        "duplicate_rows": F.coalesce(F.sum(F.greatest(F.col("__clean") - 1, F.lit(0))), F.lit(0)),
        "valid_rows": F.count_if(F.col("__clean") > 0),
        "quarantined_rows": F.coalesce(F.sum("__bad"), F.lit(0)),
        "missing_required": sum((F.coalesce(F.sum(f"__{r}"), F.lit(0)) for r in flags), F.lit(0)),
    }
    row = per_key.agg(*[a.cast("double").alias(k) for k, a in aggs.items()])
    return _long_report(row, name)


def _long_report(row: DataFrame, name: str) -> DataFrame:
    """One-row frame with columns ``metric`` or ``metric|column`` to long form."""
    out = row.unpivot([], row.columns, "__metric", "value")
    parts = F.split("__metric", r"\|")
    return out.select(
        F.lit(name).alias("dataset"), parts[0].alias("metric"),
        F.nullif(F.get(parts, F.lit(1)), F.lit("")).alias("column"), "value"
    ).filter((F.col("metric") != "range_violation") | (F.col("value") > 0)
             ).filter((F.col("metric") != "null_rate_warning") | F.col("value").isNotNull())


def individual_report(df: DataFrame, order_by: Sequence[str], name: str = "individual",
                      null_warning: float = 0.05) -> DataFrame:
    """Quality report ``(dataset, metric, column, value)`` in one pass over ``df``."""
    used = [c for c in dict.fromkeys([*C.REQUIRED_COLUMNS, *C.CLINICAL_RANGES,
                                      *C.NUMERIC_COLUMNS]) if c in df.columns]
    first = first_with_count(df, C.INDIVIDUAL_DEDUP_KEYS, order_by, used, count="__n")
    flags = reject_flags(first)
    bad = F.lit(False)
    for cond in flags.values():
        bad = bad | cond
    aggs = {
        "total_rows": F.coalesce(F.sum("__n"), F.lit(0)),
        "duplicate_rows": F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)),
        "valid_rows": F.count_if(~bad),
        "quarantined_rows": F.count_if(bad),
        "missing_required": sum((F.count_if(cond) for reason, cond in flags.items()
                                 if reason.startswith("null_")), F.lit(0)),
        "pass_rate": F.coalesce(F.try_divide(F.count_if(~bad), F.sum("__n")), F.lit(0.0)),
    }
    for c in C.NUMERIC_COLUMNS:
        if c in used:
            rate = F.avg(F.col(c).isNull().cast("double"))
            aggs[f"null_rate|{c}"] = rate
            aggs[f"null_rate_warning|{c}"] = F.when(rate > null_warning, rate)
    for reason, cond in flags.items():
        if reason.startswith("range_"):
            aggs[f"range_violation|{reason[6:]}"] = F.count_if(cond)
    row = first.agg(*[a.cast("double").alias(k) for k, a in aggs.items()])
    return _long_report(row, name)


def population_report(df: DataFrame, order_by: Sequence[str], name: str = "population",
                      keys: Sequence[str] = tuple(C.POPULATION_DEDUP_KEYS_WIDE),
                      reject_before_dedup: bool = True) -> DataFrame:
    """Report of :func:`validate_population`, in one pass.

    Per key it is enough to know how many rows are clean and whether the first row is.
    """
    tagged = with_reject(df, population_flags(df)).withColumn(
        "__bad", F.col("_reject") != "")
    present = [c for c in keys if c in df.columns]
    order = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order_by)])
    grouped = tagged.groupBy(*present).agg(
        F.count("*").alias("__n"),
        F.count_if(~F.col("__bad")).alias("__ok"),
        F.count_if(F.col("_reject").contains("null_value")).alias("__nulls"),
        F.count_if(F.col("_reject").contains("range_year")).alias("__years"),
        F.min(F.struct(order, F.col("__bad").alias("bad"))).alias("__first"))
    if reject_before_dedup:
        valid = F.count_if(F.col("__ok") > 0)
        rejected = F.sum(F.col("__n") - F.col("__ok"))
        duplicates = F.sum(F.greatest(F.col("__ok") - 1, F.lit(0)))
    else:
        valid = F.count_if(~F.col("__first.bad"))
        rejected = F.count_if(F.col("__first.bad"))
        duplicates = F.sum(F.col("__n") - 1)
    aggs = {
        "total_rows": F.sum("__n"),
        "duplicate_rows": duplicates,
        "valid_rows": valid,
        "quarantined_rows": rejected,
        "missing_required": F.sum("__nulls"),
        "pass_rate": F.try_divide(valid, F.sum("__n")),
        "range_violation|year": F.sum("__years"),
    }
    row = grouped.agg(
        *[F.coalesce(a.cast("double"), F.lit(0.0)).alias(k) for k, a in aggs.items()])
    return _long_report(row, name)


def dataset_summary(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """Row count and OK / FAIL per dataset."""
    out = None
    for name, df in datasets.items():
        line = df.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("dataset"), "n_rows",
            F.when(F.col("n_rows") > 0, "OK").otherwise("FAIL").alias("status"))
        out = line if out is None else out.unionByName(line)
    return out
