"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def build_session(app_name: str = "quire", master: str | None = None, **conf: object) -> SparkSession:
    """A session with adaptive execution and UTC. A cluster's own settings win over these."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **{key: str(value) for key, value in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder from ``spark.checkpoint.dir``.

    Unset, a session on one machine takes a fresh temporary folder; on a cluster that is an error, as
    executors would not see each other's files.
    """
    configured = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getConf().get(
        CHECKPOINT_SETTING
    )
    if not configured:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="quire-", dir="/tmp")
        spark.conf.set(CHECKPOINT_SETTING, configured)
    return configured


def new_shared_path(spark: SparkSession, name: str) -> str:
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: what is used several times is worked out once."""
    path = new_shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_by(df: DataFrame, name: str, keys: list[str], buckets: int) -> tuple[str, str]:
    """``df`` written to the shared folder in buckets of ``keys``: (table, path).

    Joins on the keys read the table as it lies, without a shuffle. It is a name in the session's catalog for
    files that are its own; `forget` takes the name away, and the path can still be read.
    """
    path = new_shared_path(df.sparkSession, name)
    table = f"quire_{uuid.uuid4().hex}"
    df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).option("path", path).saveAsTable(table)
    return table, path


def forget(spark: SparkSession, tables: list[str]) -> None:
    for table in tables:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint: the result survives the loss of any executor."""
    spark = df.sparkSession
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=eager)
