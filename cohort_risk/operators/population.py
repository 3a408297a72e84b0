"""Population indicators: normalise, deduplicate by source priority, fill, pivot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohort_risk import config as C
from cohort_risk.functions import scalars as S
from cohort_risk.operators.dedup import keep_first

PANEL_KEYS = ["country_iso3", "sex", "age_group_bin", "feature_name"]


def normalise_strata(df: DataFrame) -> DataFrame:
    """Sex to Male / Female / Both and free-text age groups to bands."""
    sex = S.population_sex("sex") if "sex" in df.columns else F.lit("Both")
    band = S.age_text_band("age_group") if "age_group" in df.columns else F.lit("All ages")
    return df.withColumns({"sex": sex, "age_group_bin": band})


def normalise_units(df: DataFrame, min_count: int = 5, share: float = 0.95) -> DataFrame:
    """Scale indicators that were published as fractions to percent.

    An indicator qualifies over all its rows: more than ``min_count`` values, more
    than ``share`` of them below 1.
    """
    if "value" not in df.columns:
        return df
    df = df.withColumn("value", S.lenient_double(df, "value"))
    if "indicator_name" not in df.columns:
        return df
    fractions = (
        df.filter(F.col("indicator_name").isNotNull() & F.col("value").isNotNull())
        .groupBy("indicator_name")
        .agg(F.count("*").alias("__n"), F.avg((F.col("value") < 1).cast("double")).alias("__s"))
        .filter((F.col("__n") > min_count) & (F.col("__s") > share))
        .select("indicator_name", F.lit(100.0).alias("__factor")))
    out = df.join(fractions, "indicator_name", "left")
    return out.withColumn(
        "value", F.col("value") * F.coalesce("__factor", F.lit(1.0))
    ).select(*df.columns)


def rename_indicators(df: DataFrame) -> DataFrame:
    def column(name: str) -> Column:
        return F.col(name) if name in df.columns else S.null("string")

    return df.withColumn("feature_name", S.feature_of_indicator(
        column("feature_name"), column("indicator_code"), column("indicator_name")))


def dedup_by_priority(df: DataFrame, tie_break: Sequence[Column | str] = ()) -> DataFrame:
    """Per panel key and year the row of the best source; ties by source and value."""
    priority = S.lookup("source", C.SOURCE_PRIORITY, C.SOURCE_PRIORITY_DEFAULT)
    order = [priority, F.col("source"), F.col("value").asc_nulls_last(), *tie_break]
    return keep_first(df, ["country_iso3", "year", "sex", "age_group_bin", "feature_name"], order)


def forward_fill(df: DataFrame, keys: Sequence[str] = tuple(PANEL_KEYS), limit: int = 5) -> DataFrame:
    """Carry the last value forward over at most ``limit`` rows in year order.

    Groups with a NULL key get NULL. After :func:`dedup_by_priority` a group holds
    one row per year, so its size is bounded by the number of years.
    """
    if "year" not in df.columns or "feature_name" not in df.columns:
        return df
    keys = [k for k in keys if k in df.columns]
    window = (Window.partitionBy(*keys).orderBy(F.col("year").asc_nulls_last())
              .rowsBetween(-limit, 0))
    complete = F.lit(True)
    for k in keys:
        complete = complete & F.col(k).isNotNull()
    return df.withColumn(
        "value", F.when(complete, F.last("value", ignorenulls=True).over(window)))


def pivot_features(df: DataFrame, features: Sequence[str] = tuple(C.POPULATION_FEATURES)
                   ) -> DataFrame:
    """Long to wide: mean per (country, year, sex, band) and feature.

    The country name is carried along, not grouped by, so rows without one survive.
    The features are given, so no extra job looks for them.
    """
    keys = [k for k in ["country_iso3", "year", "sex", "age_group_bin"] if k in df.columns]
    rows = df.dropna(subset=["feature_name", "value", *keys])
    name = ([F.max("country_name").alias("country_name")]
            if "country_name" in df.columns else [])
    return (rows.groupBy(*keys)
            .agg(*name, *[F.avg(F.when(F.col("feature_name") == f, F.col("value"))).alias(f)
                          for f in features]))


def transform_population(df: DataFrame, tie_break: Sequence[Column | str] = (),
                         features: Sequence[str] = tuple(C.POPULATION_FEATURES)
                         ) -> tuple[DataFrame, DataFrame]:
    """(long, wide) feature tables from validated population rows."""
    long = rename_indicators(normalise_units(normalise_strata(df)))
    long = forward_fill(dedup_by_priority(long, tie_break))
    return long, pivot_features(long, features)


def union_sources(*frames: DataFrame) -> DataFrame:
    """Union by name; columns a source lacks become NULL."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
