"""Structured Streaming forms of the realtime feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cohort_risk import config as C
from cohort_risk import schemas
from cohort_risk.operators.validate import reject_flags, with_reject
from cohort_risk.plans.features import FeatureModel
from cohort_risk.plans.score import score
from cohort_risk.plans.training import BranchModel
from cohort_risk.sources.individuals import biometric_items, biometric_records


def biometric_stream(spark: SparkSession, directory: str,
                     max_files: int | None = None) -> DataFrame:
    """Landed device payloads, one JSON document per line, as canonical rows."""
    reader = spark.readStream.schema(schemas.BIOMETRIC_PAYLOAD)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return biometric_records(biometric_items(reader.json(directory)))


def validated_stream(records: DataFrame) -> DataFrame:
    """The stateless rules: reject reasons per row."""
    tagged = with_reject(records, reject_flags(records))
    return tagged.withColumn("rejected", F.col("_reject") != "")


def write_partitioned(stream: DataFrame, path: str, checkpoint: str,
                      by: str = "rejected") -> StreamingQuery:
    """Exactly-once file sink; clean and rejected rows are its partitions."""
    return (stream.writeStream.format("parquet").partitionBy(by)
            .option("path", path).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def deduplicated(readings: DataFrame, delay: str = "1 hour") -> DataFrame:
    """One reading per station, parameter and time within the watermark delay."""
    return (readings.withWatermark("measured_at", delay)
            .dropDuplicatesWithinWatermark(C.ENVIRONMENT_KEYS))


def windowed_means(readings: DataFrame, window: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """Mean reading per country, parameter and closed window."""
    return (readings.withWatermark("measured_at", delay)
            .groupBy(F.window("measured_at", window), "country_iso3", "parameter")
            .agg(F.avg("value").alias("mean_value"), F.count("value").alias("n_values"))
            .select(F.col("window.start").alias("window_start"),
                    F.col("window.end").alias("window_end"),
                    "country_iso3", "parameter", "mean_value", "n_values"))


def landed_readings(readings: DataFrame, window: str = "1 day") -> DataFrame:
    """Every reading with its window and the time of its micro-batch, for an append sink.

    ``landed_at`` is fixed in the checkpoint, so a batch that is repeated has the same.
    """
    return readings.select(
        "country_iso3", "parameter", "value", "measured_at",
        F.window("measured_at", window).alias("window"),
        F.current_timestamp().alias("landed_at")).withColumns(
        {"window_start": F.col("window.start"), "window_end": F.col("window.end")}).drop("window")


def current_means(landed: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Mean reading of every window over all readings that have landed.

    A window is ``provisional`` until the watermark has passed its end. ``n_late`` counts the
    readings, with or without a value, that landed after the watermark of the batches before
    theirs had passed their window; they are in the mean.
    """
    late_by = F.expr(f"INTERVAL {delay}")
    batches = landed.groupBy("landed_at").agg(F.max("measured_at").alias("newest"))
    before = Window.orderBy("landed_at").rowsBetween(Window.unboundedPreceding, -1)  # a row per micro-batch
    marks = batches.select("landed_at", (F.max("newest").over(before) - late_by).alias("watermark"))
    last = batches.agg((F.max("newest") - late_by).alias("last_watermark"))
    late = F.coalesce(F.col("window_end") <= F.col("watermark"), F.lit(False))
    keys = ["window_start", "window_end", "country_iso3", "parameter"]
    means = (landed.join(marks, "landed_at").groupBy(*keys)
             .agg(F.avg("value").alias("mean_value"), F.count("value").alias("n_values"),
                  F.count_if(late).alias("n_late")))
    return means.crossJoin(last).withColumn(
        "provisional", F.col("window_end") > F.col("last_watermark")).drop("last_watermark")


def scored_stream(individuals: DataFrame, features: FeatureModel, model_a: BranchModel | None,
                  model_b: BranchModel | None, scored_at: Column) -> DataFrame:
    """Score a stream of individuals with fitted models and static lookups."""
    return score(features.transform(individuals), model_a, model_b, scored_at)


def append_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return (stream.writeStream.format("parquet").outputMode("append")
            .option("path", path).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


_WINDOW_KEYS = ["window_start", "window_end", "country_iso3", "parameter"]


def _exists(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


def merge_batch(batch: DataFrame, batch_id: int, root: str, window: str = "1 day",
                delay: str = "1 hour") -> None:
    """Adds one micro-batch of readings to the window table below ``root``.

    The batch's partial sums are written under its id (a repeated batch replaces its own),
    and only the days of windows it touched are added up again, from the partials of those
    days; raw readings of earlier batches are never read again. A reading is late when the
    watermark of the batches before it (their newest time less ``delay``) has passed its
    window's end; it still counts in the mean.
    """
    spark = batch.sparkSession
    rows = batch.select("country_iso3", "parameter", "value", "measured_at",
                        F.window("measured_at", window).alias("w")).select(
        "country_iso3", "parameter", "value", "measured_at",
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"))
    marks = f"{root}/marks"
    newest = None
    if _exists(spark, marks):
        newest = spark.read.parquet(marks).filter(F.col("batch_id") < batch_id).agg(F.max("newest")).first()[0]
    late = (F.col("window_end") <= F.lit(newest) - F.expr(f"INTERVAL {delay}")) if newest is not None \
        else F.lit(False)
    rows = rows.persist()
    try:
        partial = (rows.groupBy(*_WINDOW_KEYS)
                   .agg(F.sum("value").alias("total"), F.count("value").alias("n_values"),
                        F.count_if(late).alias("n_late"))
                   .withColumns({"day": F.to_date("window_start"), "batch_id": F.lit(batch_id)}))
        (partial.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("day", "batch_id").parquet(f"{root}/partials"))
        (rows.agg(F.max("measured_at").alias("newest")).withColumn("batch_id", F.lit(batch_id))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(marks))
        # the days of one batch's windows, a short list
        touched = [r["day"] for r in rows.select(F.to_date("window_start").alias("day")).distinct().collect()]
    finally:
        rows.unpersist()
    if not touched:
        return
    sums = (spark.read.parquet(f"{root}/partials").filter(F.col("day").isin(touched))
            .groupBy("day", *_WINDOW_KEYS)
            .agg(F.sum("total").alias("total"), F.sum("n_values").alias("n_values"),
                 F.sum("n_late").alias("n_late")))
    (sums.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("day").parquet(f"{root}/windows"))


def merge_windows(stream: DataFrame, root: str, checkpoint: str, window: str = "1 day",
                  delay: str = "1 hour") -> StreamingQuery:
    """Keeps the window table below ``root`` current, one micro-batch at a time."""
    return (stream.writeStream.option("checkpointLocation", checkpoint)
            .foreachBatch(lambda batch, batch_id: merge_batch(batch, batch_id, root, window, delay))
            .trigger(availableNow=True).start())


def merged_means(spark: SparkSession, root: str, delay: str = "1 hour") -> DataFrame:
    """The windows of ``merge_windows``: mean, counts, and whether still provisional."""
    newest = spark.read.parquet(f"{root}/marks").agg(F.max("newest")).first()[0]  # one value
    last = F.lit(newest) - F.expr(f"INTERVAL {delay}")
    return spark.read.parquet(f"{root}/windows").select(
        *_WINDOW_KEYS, F.when(F.col("n_values") > 0, F.col("total") / F.col("n_values")).alias("mean_value"),
        "n_values", "n_late", F.coalesce(F.col("window_end") > last, F.lit(True)).alias("provisional"))
