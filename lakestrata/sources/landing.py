"""Landing zone: immutable, dated CSV drops (SRC-1..3, SNK-2, FLT-5).

Layout: ``{landing}/{table}/ingestion_date=YYYY-MM-DD/part-*.csv.gz``, one partition per extraction,
history kept. Drops are written compressed, and no file holds more than :data:`FILE_ROWS` rows, so one task, which has
to read a compressed file whole, never gets more; drops of others may be plain CSV. Writing a date again replaces only that date (dynamic partition overwrite), so a rerun
on the same day is idempotent.

Reading takes one date for a whole run (:func:`latest_ingestion`): the newest one of any table, which every
table must have, so a half-landed drop is an error and two dates never mix in one layer. Only the names of
the table folders' sub-folders are listed, never the files of the history, and only the one date's folder is
read, whatever its files are called. CSV is read as all strings, with the header's names and no inference.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.sources.files import file_system
from lakestrata.sources.multiline import read_multiline_csv
from lakestrata.specs import TableSpec

PARTITION_COLUMN = "ingestion_date"
#: rows of a written file: some tens of MB of text
FILE_ROWS = 500_000


class NoLandingPartitionError(FileNotFoundError):
    pass


def landing_path(landing_root: str, table: str) -> str:
    return f"{landing_root.rstrip('/')}/{table}"


def write_landing(df: DataFrame, landing_root: str, table: str, ingestion_date: str | dt.date) -> str:
    """Drop ``df`` (all columns as text) as the ``ingestion_date`` partition of ``table``."""
    d = ingestion_date.isoformat() if isinstance(ingestion_date, dt.date) else str(ingestion_date)
    dt.date.fromisoformat(d)  # validate the partition name
    path = landing_path(landing_root, table)
    out = df.select(*[F.col(c).cast("string") for c in df.columns]).withColumn(PARTITION_COLUMN, F.lit(d))
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .option("header", True).option("quote", '"').option("escape", '"')
        .option("compression", "gzip").option("maxRecordsPerFile", FILE_ROWS)
        .partitionBy(PARTITION_COLUMN).csv(path))
    return path


def landed_dates(spark: SparkSession, landing_root: str, table: str) -> list[str]:
    """The dates of ``table``, ascending: the names of its partition folders (ISO dates sort as text)."""
    path, fs = file_system(spark, landing_path(landing_root, table))
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()]
    return sorted(n.partition("=")[2] for n in names if n.startswith(f"{PARTITION_COLUMN}="))


def latest_ingestion(spark: SparkSession, landing_root: str, tables: Iterable[str]) -> str:
    """The newest date of any of ``tables``; an error if one of them has no drop of that date."""
    dates = {t: landed_dates(spark, landing_root, t) for t in tables}
    newest = max((d[-1] for d in dates.values() if d), default=None)
    if newest is None:
        raise NoLandingPartitionError(f"no '{PARTITION_COLUMN}=' partition under {landing_root} for {sorted(dates)}")
    missing = sorted(t for t, d in dates.items() if newest not in d)
    if missing:
        raise NoLandingPartitionError(f"the drop of {newest} under {landing_root} lacks {missing}")
    return newest


def csv_reader(spark: SparkSession, spec: TableSpec | None = None):
    r = spark.read.option("header", True).option("sep", ",").option("inferSchema", False)
    if spec is not None and spec.csv_options:
        r = r.options(**spec.csv_options)
    return r


def read_landing(spark: SparkSession, landing_root: str, spec: TableSpec, ingestion_date: str) -> DataFrame:
    """One landing partition of ``spec``'s table as all-string columns, named by that drop's own header."""
    path = f"{landing_path(landing_root, spec.name)}/{PARTITION_COLUMN}={ingestion_date}"
    if spec.csv_options.get("multiLine") == "true":
        return read_multiline_csv(spark, path, spec.csv_options)
    return csv_reader(spark, spec).csv(path)


def read_landing_latest(spark: SparkSession, landing_root: str, spec: TableSpec) -> tuple[DataFrame, str]:
    d = latest_ingestion(spark, landing_root, [spec.name])
    return read_landing(spark, landing_root, spec, d), d
