"""Scratch tables of the operators: Parquet below the session's shared checkpoint folder.

Writing a table cuts the lineage, so a lost executor re-runs only the stage that needs it, and each
step is computed once. Steps that a later written table replaces are removed again.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import lakestrata
from lakestrata.session import checkpoint_dir

_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Give this package to the application's executors, once: their workers import it, wherever the
    driver has it from."""
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        _SHIPPED.add(sc.applicationId)
        package = os.path.dirname(os.path.abspath(lakestrata.__file__))
        if os.path.isdir(package):
            at = os.path.join(tempfile.mkdtemp(prefix="lakestrata-code-"), "lakestrata")
            sc.addPyFile(shutil.make_archive(at, "zip", os.path.dirname(package), os.path.basename(package)))


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    ship_code(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Written steps of one operator run. ``keep`` writes a frame and returns the re-read one;
    ``drop`` deletes steps that nothing reads any more."""

    def __init__(self, spark: SparkSession, tag: str) -> None:
        self.spark = spark
        self.base = f"{checkpoint_dir(spark).rstrip('/')}/llm-{tag}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            p = jvm.org.apache.hadoop.fs.Path(self.path(name))
            p.getFileSystem(conf).delete(p, True)


#: rows of keys (a few numbers each) that a join may broadcast; it counts them first
MAX_BROADCAST_KEYS = 300_000


def small(keys: DataFrame) -> DataFrame:
    """``keys`` (a written table of few bytes a row) with a broadcast hint if it is small; a larger one is
    joined by shuffle."""
    return F.broadcast(keys) if keys.count() <= MAX_BROADCAST_KEYS else keys
