"""Population indicators: landed publisher payloads to canonical rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohort_risk import config as C
from cohort_risk import schemas
from cohort_risk.functions import scalars as S


def canonical(df: DataFrame, schema, columns: Mapping[str, Column],
              ingested_at: Column | None = None) -> DataFrame:
    """Project to a canonical schema; fields without an expression are NULL."""
    given = dict(columns)
    if ingested_at is not None:
        given["ingested_at"] = ingested_at
    return df.select(*[
        given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name, metadata=f.metadata)
        for f in schema])


def _population(df: DataFrame, source: str, columns: Mapping[str, Column],
                ingested_at: Column | None) -> DataFrame:
    fixed = {"source": F.lit(source), "record_type": F.lit("population")}
    return canonical(df, schemas.POPULATION, {**fixed, **columns}, ingested_at)


def read_payloads(spark: SparkSession, path: str, schema) -> DataFrame:
    """JSON envelopes, one document per file; partition folders become columns."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def who_records(payloads: DataFrame, year_from: int = 2000, year_to: int = 2023,
                ingested_at: Column | None = None) -> DataFrame:
    """Country rows of indicator payloads ``(indicator_name, value[])``."""
    rows = payloads.select("indicator_name", F.inline("value"))
    year = S.text_to_int("TimeDim")
    kept = rows.filter((F.col("SpatialDimType") == "COUNTRY") & year.between(year_from, year_to))
    return _population(kept, "who_gho", {
        "country_iso3": F.col("SpatialDim"),
        "year": year,
        "sex": S.lookup("Dim1", C.WHO_SEX, "Both"),
        "age_group": F.coalesce(F.nullif(F.col("Dim2"), F.lit("")), F.lit("All ages")),
        "indicator_code": S.lookup("indicator_name", C.WHO_INDICATORS),
        "indicator_name": F.col("indicator_name"),
        "metric_type": F.lit("prevalence"),
        "value": S.text_to_double("NumericValue"),
        "lower_ci": S.text_to_double("Low"),
        "upper_ci": S.text_to_double("High"),
        "unit": F.lit("%"),
    }, ingested_at)


def _us(location: str) -> dict[str, Column]:
    return {"country_iso3": F.lit("USA"), "country_name": F.lit("United States"),
            "region": F.col(location), "unit": F.lit("%")}


def _metric(name: str) -> Column:
    return F.lower(F.coalesce(F.nullif(F.col(name), F.lit("")), F.lit("prevalence")))


def cdi_records(rows: DataFrame, year_from: int = 2010, year_to: int = 2023,
                topics: Sequence[str] = tuple(C.CDI_TOPICS),
                ingested_at: Column | None = None) -> DataFrame:
    """Chronic-disease indicators of the listed topics within the years."""
    start, end = S.text_to_int("yearstart"), S.text_to_int("yearend")
    kept = rows.filter((start >= year_from) & (end <= year_to) & F.col("topic").isin(*topics))
    return _population(kept, "cdc_cdi", {
        **_us("locationdesc"),
        "year": start,
        "age_group": F.coalesce("stratificationcategory1", F.lit("Overall")),
        "sex": S.normal_sex(F.coalesce("stratification1", F.lit(""))),
        "indicator_code": F.col("questionid"),
        "indicator_name": F.col("question"),
        "metric_type": _metric("datavaluetype"),
        "value": S.text_to_double("datavalue"),
        "lower_ci": S.text_to_double("lowconfidencelimit"),
        "upper_ci": S.text_to_double("highconfidencelimit"),
    }, ingested_at)


def brfss_records(rows: DataFrame, year_from: int = 2010, year_to: int = 2023,
                  classes: Sequence[str] = tuple(C.BRFSS_CLASSES),
                  ingested_at: Column | None = None) -> DataFrame:
    """Behavioural survey rows of the listed classes within the years."""
    year = S.text_to_int("year")
    kept = rows.filter(F.col("class").isin(*classes) & year.between(year_from, year_to))
    return _population(kept, "cdc_brfss", {
        **_us("locationdesc"),
        "year": year,
        "age_group": F.coalesce("break_out_category", F.lit("Overall")),
        "sex": S.normal_sex(F.coalesce("break_out", F.lit(""))),
        "indicator_code": F.col("questionid"),
        "indicator_name": F.col("question"),
        "metric_type": _metric("data_value_type"),
        "value": S.text_to_double("data_value"),
        "lower_ci": S.text_to_double("confidence_limit_low"),
        "upper_ci": S.text_to_double("confidence_limit_high"),
    }, ingested_at)


def tidy_header(names: Sequence[str]) -> list[str]:
    return [n.strip().lower().replace(" ", "_") for n in names]


def read_gbd(spark: SparkSession, directory: str) -> DataFrame | None:
    """Burden-of-disease CSV files whose header has all required columns.

    One pass finds the header line of every file. Only the distinct layouts come to the
    driver; each is one CSV read over the whole folder, joined to the files that have it,
    so the work follows the number of layouts, not of files.
    """
    lines = (spark.read.option("pathGlobFilter", "*.csv").text(directory)
             .select("value", F.col("_metadata.file_path").alias("file"),
                     F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("line")))
    heads = (lines.filter(F.col("block") == 0).groupBy("file")
             .agg(F.min_by("value", "line").alias("head")))
    frames = []
    for row in heads.select("head").distinct().collect():
        names = tidy_header(row["head"].lstrip("\ufeff").replace('"', "").split(","))
        if set(C.GBD_REQUIRED) <= set(names):
            files = heads.filter(F.col("head") == row["head"]).select("file")
            raw = (spark.read.option("header", True).option("pathGlobFilter", "*.csv").option("enforceSchema", True)
                   .schema(", ".join(f"`{n}` string" for n in names)).csv(directory)
                   .withColumn("file", F.col("_metadata.file_path")))
            frames.append(raw.join(files, "file", "left_semi").select(*C.GBD_REQUIRED))
    return reduce(DataFrame.unionByName, frames) if frames else None


def gbd_records(rows: DataFrame, causes: Sequence[str] = tuple(C.GBD_CAUSES),
                ingested_at: Column | None = None) -> DataFrame:
    """Rows of the listed causes. The publisher gives no country or indicator code."""
    kept = rows.filter(F.col("cause_name").isin(*causes))
    metric = F.lower(F.coalesce("metric_name", F.lit("")))
    return _population(kept, "ihme_gbd", {
        "country_name": F.col("location_name"),
        "year": S.text_to_int("year"),
        "sex": S.normal_sex("sex_name"),
        "age_group": F.col("age_name"),
        "indicator_name": F.concat("cause_name", F.lit(" — "), "measure_name", F.lit(" ("),
                                   "metric_name", F.lit(")")),
        "metric_type": F.lower("measure_name"),
        "value": S.text_to_double("val"),
        "lower_ci": S.text_to_double("lower"),
        "upper_ci": S.text_to_double("upper"),
        "unit": F.when(metric.contains("percent"), "%").otherwise("per 100k"),
    }, ingested_at)


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """Whole files as ``payload``, for documents without a single row type."""
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", "payload")


def worldbank_records(payloads: DataFrame, ingested_at: Column | None = None,
                      year_from: int | None = None, year_to: int | None = None,
                      countries: Sequence[str] | None = None) -> DataFrame:
    """Rows of ``[meta, rows[]]`` payload texts ``(indicator_name, payload)``.

    Bounds and countries are those that a request would name; None takes all.
    """
    rows = payloads.select("indicator_name", F.inline(F.from_json(
        F.get_json_object("payload", "$[1]"), schemas.WORLDBANK_ROWS)))
    kept = rows.filter(F.col("value").isNotNull())
    year = S.text_to_int(F.substring("date", 1, 4))
    code = F.coalesce(F.nullif(F.col("countryiso3code"), F.lit("")), F.col("country.id"))
    if year_from is not None:
        kept = kept.filter(year >= year_from)
    if year_to is not None:
        kept = kept.filter(year <= year_to)
    if countries is not None:
        kept = kept.filter(code.isin(*countries))
    return _population(kept, "worldbank", {
        "country_iso3": code,
        "country_name": F.col("country.value"),
        "year": year,
        "sex": F.lit("Both"),
        "age_group": F.lit("All ages"),
        "indicator_code": S.lookup("indicator_name", C.WORLDBANK_INDICATORS),
        "indicator_name": F.col("indicator_name"),
        "metric_type": F.lit("prevalence"),
        "value": S.text_to_double("value"),
        "unit": F.lit("%"),
    }, ingested_at)
