"""Report bundle reader: the one-row JSON document written by the batch job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quakescope.schema import REPORT


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its file system (any Hadoop scheme)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """Bundle rows with the report schema; an absent path gives an empty frame."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], REPORT)
    return spark.read.schema(REPORT).json(path)
