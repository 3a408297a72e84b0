"""Runs of a job as sets of tables that become visible together.

A run writes its tables below ``<root>/<run_id>/<name>`` and, last, its manifest
``<root>/_committed/<run_id>.json``: first under a temporary name, then renamed, so that a
reader sees a whole manifest or none. Readers list manifests only. A run that failed or is
still writing has none and stays invisible; its rerun takes a new id. Ids begin with the
UTC time of the run, so the newest committed run sorts last.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

COMMITTED = "_committed"


def new_run(stamp: datetime | None = None) -> str:
    """An id that sorts by time and never repeats."""
    at = (stamp or datetime.now(timezone.utc)).strftime("%Y%m%dT%H%M%S")
    return f"{at}-{uuid.uuid4().hex[:8]}"


def table_path(root: str, run_id: str, name: str) -> str:
    return f"{root.rstrip('/')}/{run_id}/{name}"


def write_table(df: DataFrame, root: str, run_id: str, name: str) -> str:
    path = table_path(root, run_id, name)
    df.write.mode("overwrite").parquet(path)
    return path


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark._jsc.hadoopConfiguration())


def commit(spark: SparkSession, root: str, run_id: str, manifest: dict) -> dict:
    """Writes the manifest last; from then on the run's tables are visible."""
    body = {**manifest, "run_id": run_id, "committed_at": datetime.now(timezone.utc).isoformat()}
    final, fs = _fs(spark, f"{root.rstrip('/')}/{COMMITTED}/{run_id}.json")
    temp, _ = _fs(spark, f"{root.rstrip('/')}/{COMMITTED}/.{run_id}.{uuid.uuid4().hex}.tmp")
    out = fs.create(temp, True)
    try:
        out.write(bytearray(json.dumps(body, sort_keys=True).encode()))
    finally:
        out.close()
    if not fs.rename(temp, final):
        fs.delete(temp, False)
        raise OSError(f"could not commit run {run_id} under {root}")
    return body


def committed(spark: SparkSession, root: str) -> list[dict]:
    """Manifests of all committed runs, oldest first: one small file per run."""
    folder, fs = _fs(spark, f"{root.rstrip('/')}/{COMMITTED}")
    if not fs.exists(folder):
        return []
    names = sorted(s.getPath().getName() for s in fs.listStatus(folder)
                   if s.getPath().getName().endswith(".json") and not s.getPath().getName().startswith("."))
    out = []
    for name in names:
        path, _ = _fs(spark, f"{root.rstrip('/')}/{COMMITTED}/{name}")
        stream = fs.open(path)
        try:
            reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(stream, "UTF-8"))
            out.append(json.loads("".join(iter(reader.readLine, None))))
        finally:
            stream.close()
    return out


def latest(spark: SparkSession, root: str) -> dict | None:
    """The manifest of the newest committed run, or None."""
    runs = committed(spark, root)
    return runs[-1] if runs else None


def read_table(spark: SparkSession, root: str, manifest: dict, name: str) -> DataFrame:
    if name not in manifest.get("tables", []):
        raise KeyError(f"run {manifest['run_id']} has no table {name}")
    return spark.read.parquet(table_path(root, manifest["run_id"], name))
