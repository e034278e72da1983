"""A stream over landed drops: new files are taken as they come, summed in event-time windows and published per batch.

A run takes everything that has landed (``availableNow``) and ends, so it is scheduled like any layer job; the checkpoint
remembers files and state between runs. Sums are kept in the state store until the watermark passes their window: a row
that is later than that is dropped, any other one changes the window's published sums.

Publishing is idempotent: batch N replaces ``{out}/batch=N`` whatever a failed try has left there, and readers take each
window's row of the last batch that touched it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.sources.files import file_system
from lakestrata.sources.landing import landing_path


def landing_stream(spark: SparkSession, landing_root: str, table: str, schema: str, max_files: int = 10_000) -> DataFrame:
    """The rows of a table's landed CSV files, typed by ``schema`` (DDL), with the drop's ``ingestion_date``."""
    return (spark.readStream.schema(f"{schema}, ingestion_date string").option("header", True).option("maxFilesPerTrigger", max_files)
            .csv(landing_path(landing_root, table)))


def window_sums(rows: DataFrame, time: str, width: str, by: Sequence[str], measures: Mapping[str, Column], watermark: str) -> DataFrame:
    """Aggregates per tumbling window of ``width`` and ``by``; works on a stream and, without state, on a table. A hot key
    is added up in each task before the shuffle."""
    grouped = rows.withWatermark(time, watermark).groupBy(F.window(time, width).alias("window"), *by)
    sums = grouped.agg(*(m.alias(n) for n, m in measures.items()))
    return sums.select(F.col("window.start").alias("window_start"), *by, *measures)


def run_available(sums: DataFrame, out: str, checkpoint: str) -> int:
    """Take what has landed since the last run with this checkpoint, publish each batch, and end. Returns the number of
    rows that were read."""
    def publish(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    query = sums.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(publish).start()
    query.awaitTermination()
    return sum(p["numInputRows"] for p in query.recentProgress)


def read_published(spark: SparkSession, out: str, schema: str, keys: Sequence[str]) -> DataFrame:
    """The current sums: each window's and key's row of the last batch that has it. ``schema`` is the sums' DDL."""
    _, fs = file_system(spark, out)
    if not fs.exists(file_system(spark, out)[0]):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(f"{schema}, batch long").parquet(out)
    rest = [c for c in rows.columns if c not in (*keys, "batch")]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("last"))
    return last.select(*keys, "last.*")
