"""Session settings and shared storage."""

from __future__ import annotations

import gc
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

#: Spark's setting that deletes the shuffles of a query at its end.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app_name: str = "cohort_risk", **conf: str) -> SparkSession:
    """Create a session; the cluster's own settings stay unless given in ``conf``."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def set_root(spark: SparkSession) -> None:
    """Name a folder for intermediate tables in a local session that has none.

    For tests, benches and entry points on one machine; the engine never calls it.
    """
    if _root(spark) is None and spark.sparkContext.master.split("[")[0] == "local":
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cohort_risk_"))


def _root(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def _run_dir(spark: SparkSession) -> str:
    root = _root(spark)
    if root is None:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    return f"{root.rstrip('/')}/{spark.sparkContext.applicationId}"


#: The scope that ``stored`` writes into, if any: a folder of the run that is deleted as a whole.
_SCOPE: list[str] = []


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder of this application below ``spark.checkpoint.dir`` (inside the open scope)."""
    inside = f"{_SCOPE[-1]}/" if _SCOPE else ""
    return f"{_run_dir(spark)}/{inside}{purpose}-{uuid.uuid4().hex}"


def free_shuffles(spark: SparkSession) -> None:
    """Lets Spark clean the shuffles of frames that nobody refers to any more."""
    gc.collect()
    spark._jvm.System.gc()


@contextmanager
def freed_shuffles(spark: SparkSession):
    """Queries inside delete their shuffles when they end, without waiting for a garbage collection."""
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def drop_scope(spark: SparkSession, name: str) -> None:
    """Deletes the intermediate tables of a scope, and lets Spark clean the shuffles nobody reads.

    Frames that still read one of those tables can't be used afterwards.
    """
    free_shuffles(spark)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{_run_dir(spark)}/{name}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scope(spark: SparkSession, name: str):
    """Tables stored inside go to one folder; what was there from before is deleted first.

    For steps that run one after the other, each reading only what the one before returned
    after that was written out: a step frees its predecessor's intermediate tables.
    """
    drop_scope(spark, name)
    _SCOPE.append(name)
    try:
        yield
    finally:
        _SCOPE.pop()


def release(spark: SparkSession) -> None:
    """Delete all intermediate tables of this application.

    For the end of a run: frames that still read one of them can't be used afterwards.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(_run_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, purpose: str, tasks: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage at a point that survives lost executors, computes the frame
    once for several readers, and gives Catalyst its true size. The shuffles of the
    write are deleted when it ends, as nobody reads them again. ``tasks`` bounds the tasks
    of the last stage, and so the files, of a frame whose partitions hold few rows each.
    """
    path = shared_dir(df.sparkSession, purpose)
    with freed_shuffles(df.sparkSession):
        (df.coalesce(tasks) if tasks else df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
