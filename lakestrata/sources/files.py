"""The Hadoop file system of a path, through the session's JVM: listings and markers on any store."""

from __future__ import annotations

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """(Hadoop path, its file system)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
