"""Snapshot tables, quarantine, exports.

A table is a folder of Parquet files partitioned by ``snapshot_ts``; a run writes one
partition, and the latest state is the newest partition. A run that is repeated replaces
its own partition and touches no other.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohort_risk.operators.scoring import result_schema


def _write(df: DataFrame, path: str, *partitions: str) -> None:
    """Write partitions; those of ``path`` that ``df`` has rows of are replaced."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partitions).parquet(path))


def write_snapshot(df: DataFrame, path: str, snapshot_ts: str, kind: str = "full",
                   written_at: str | None = None) -> None:
    """Add one snapshot. ``kind="partial"`` rows (single patients) never become latest."""
    out = df.withColumns({"_written_at": F.lit(written_at or snapshot_ts),
                          "snapshot_kind": F.lit(kind), "snapshot_ts": F.lit(snapshot_ts)})
    _write(out, path, "snapshot_kind", "snapshot_ts")


def latest_snapshot(df: DataFrame, column: str = "snapshot_ts") -> DataFrame:
    """Rows of the newest snapshot. The bound is a scalar subquery, so partitions prune."""
    newest = df.agg(F.max(column).alias("newest")).scalar()
    return df.filter(F.col(column) == newest)


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    full = spark.read.option("basePath", path).parquet(path).filter(
        F.col("snapshot_kind") == "full")
    return latest_snapshot(full)


def write_features(tables: Mapping[str, DataFrame], root: str, snapshot_ts: str) -> None:
    for name, df in tables.items():
        write_snapshot(df, f"{root}/{name}", snapshot_ts)


def write_scores(scored: DataFrame, path: str, snapshot_ts: str, partial: bool = False) -> None:
    """Scored rows in the fixed column order."""
    write_snapshot(result_schema(scored), path, snapshot_ts, "partial" if partial else "full")


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    return read_latest(spark, path).orderBy(F.desc("scored_at"))


def write_landed(datasets: Mapping[str, DataFrame], root: str, snapshot_ts: str) -> None:
    """Land datasets under ``dataset=<name>/snapshot_ts=<ts>``; empty ones leave no rows."""
    for name, df in datasets.items():
        _write(df.withColumn("snapshot_ts", F.lit(snapshot_ts)), f"{root}/dataset={name}", "snapshot_ts")


def read_landed(spark: SparkSession, root: str, prefix: str) -> DataFrame:
    """All landed datasets whose name starts with ``prefix``, united by name."""
    return (spark.read.option("basePath", root).option("mergeSchema", True)
            .parquet(f"{root}/dataset={prefix}*"))


def write_validated(tagged: DataFrame, path: str, name: str, snapshot_ts: str) -> None:
    """Clean and rejected rows in one pass, parted by ``rejected``.

    Both sides are read back by partition, so the validation runs once.
    """
    _write(tagged.withColumns({"_source": F.lit(name), "rejected": F.col("_reject") != "",
                               "snapshot_ts": F.lit(snapshot_ts)}), path, "rejected", "snapshot_ts")


def read_clean(spark: SparkSession, path: str) -> DataFrame:
    """The clean rows of the newest snapshot; earlier ones stay for the quarantine's history."""
    rows = latest_snapshot(spark.read.parquet(path)).filter(F.col("rejected") == "false")
    return rows.drop("_reject", "_source", "rejected", "snapshot_ts")


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.parquet(path).filter(F.col("rejected") == "true")
    return rows.withColumn("_reasons", F.split("_reject", "; ")).drop("rejected")


def append_log(df: DataFrame, path: str, run_ts: str) -> None:
    """Add a run to a log: one drift row per feature, or one performance row."""
    _write(df.withColumn("run_ts", F.lit(run_ts)), path, "run_ts")


def write_csv_exports(views: Mapping[str, DataFrame], root: str) -> None:
    for name, df in views.items():
        if not df.isEmpty():
            df.write.mode("overwrite").option("header", True).csv(f"{root}/{name}")


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append",
               batch_size: int = 5000, **options: str) -> None:
    """Write to a database table through Spark's JDBC writer."""
    if mode not in ("append", "overwrite"):
        raise ValueError(f"mode is append or overwrite, not {mode}")
    (df.write.format("jdbc").options(url=url, dbtable=table, batchsize=str(batch_size), **options)
     .mode(mode).save())
