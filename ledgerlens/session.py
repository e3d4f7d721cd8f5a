"""Session set-up and shared working storage."""

from __future__ import annotations

import re
import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "ledgerlens", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the engine relies on; ``conf`` overrides them.

    Parallelism is left to the cluster: AQE coalesces small shuffle partitions
    and splits skewed ones, so only the upper bound is worth tuning.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update({key.replace("__", "."): str(value) for key, value in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir``.

    Where it is unset a temporary folder is used, which is only sound (and only
    allowed) when driver and executors are one local process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^,\]]*(,[^,\]]*)?\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="ledgerlens-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_root(spark)}/{name}-{uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Later passes read the stored columns instead of computing them again, and
    losing an executor costs a re-read, not the whole history.
    """
    path = scratch_path(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
