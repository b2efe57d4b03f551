"""Session helpers.

Library functions never create or reconfigure a session; they take the
DataFrames they are given.  ``build_session`` is for scripts, tests and the
bench, and ``checkpoint_dir`` reads the shared folder the cluster names in
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Session defaults for scripts and tests; a cluster deployment passes its own.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "quakescope", master: str | None = None,
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster (``spark.checkpoint.dir``), as the session names it.

    Where none is set, a local session (tests) gets a temporary folder; any
    other raises, since its executors would each write to a disk of their
    own.  The session itself is never changed.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return tempfile.mkdtemp(prefix="quakescope-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh name under the shared folder for a written table (the writer makes the folder)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back: later steps re-read them instead of running them again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
