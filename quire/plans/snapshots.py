"""Versioned state tables: a snapshot per write, the newest finished one is the state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _finished_versions(spark: SparkSession, root: str) -> list[int]:
    """Versions whose write was committed. The list is as long as the kept history, not the data."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    found = []
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        marker = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if name.startswith("v=") and fs.exists(marker):
            found.append(int(name[2:]))
    return sorted(found)


def read_snapshot(spark: SparkSession, root: str, before: int | None = None) -> DataFrame | None:
    """Newest finished snapshot, or the newest older than ``before``; None if there is none."""
    versions = [v for v in _finished_versions(spark, root) if before is None or v < before]
    return spark.read.parquet(f"{root}/v={versions[-1]}") if versions else None


def write_snapshot(df: DataFrame, root: str, version: int) -> None:
    """Write one version. The commit marker comes last, so a failed write never becomes the state.

    Writing a version again replaces it: with `read_snapshot(before=version)` a repeated batch is a
    no-op.
    """
    df.write.mode("overwrite").parquet(f"{root}/v={version}")
