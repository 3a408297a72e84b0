"""Windows merged batch by batch equal the means over all readings at once."""

from pyspark.sql import functions as F

from cohort_risk.session import shared_dir
from cohort_risk.streaming import readings

SCHEMA = "country_iso3 string, parameter string, value double, measured_at timestamp"


def _landed(spark, path, rows):
    df = spark.createDataFrame([("A", "pm25", v, t) for v, t in rows], SCHEMA.replace("timestamp", "string"))
    df.withColumn("measured_at", F.to_timestamp("measured_at")).coalesce(1).write.mode("append").parquet(path)


def _table(df):
    return sorted((r["window_start"].strftime("%d"), r["mean_value"], r["n_values"], r["n_late"], r["provisional"])
                  for r in df.collect())


def test_merged_windows_over_files_and_a_repeated_batch(spark):
    source, root, state = (shared_dir(spark, n) for n in ("in", "windows", "state"))
    stream = lambda: spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    _landed(spark, source, [(1.0, "2024-01-01 10:00:00"), (3.0, "2024-01-01 12:00:00"), (5.0, "2024-01-02 05:00:00")])
    _landed(spark, source, [(None, "2024-01-02 06:00:00")])
    readings.merge_windows(stream(), root, state).awaitTermination()
    assert _table(readings.merged_means(spark, root)) == [("01", 2.0, 2, 0, False), ("02", 5.0, 1, 0, True)]
    _landed(spark, source, [(101.0, "2024-01-01 13:00:00"), (7.0, "2024-01-03 09:00:00")])
    readings.merge_windows(stream(), root, state).awaitTermination()
    merged = _table(readings.merged_means(spark, root))
    assert merged == [("01", 35.0, 3, 1, False), ("02", 5.0, 1, 0, False), ("03", 7.0, 1, 0, True)]
    # a batch that runs again changes nothing
    again = spark.read.schema(SCHEMA).parquet(source).filter("value = 101.0 OR value = 7.0")
    readings.merge_batch(again, 2, root)
    assert _table(readings.merged_means(spark, root)) == merged
    # the same as landing every reading and averaging all of them
    landed = readings.landed_readings(spark.read.schema(SCHEMA).parquet(source)).withColumn(
        "landed_at", F.lit(0).cast("timestamp"))
    want = readings.current_means(landed).select("window_start", "mean_value", "n_values")
    assert sorted(map(tuple, want.collect())) == sorted(
        map(tuple, readings.merged_means(spark, root).select("window_start", "mean_value", "n_values").collect()))
