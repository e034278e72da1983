"""Layer tables (Parquet), staged publishing and the audit table (SRC-4/5, SNK-1, SNK-3).

Layout under one lake root (shared storage):
``{root}/{layer}/{table}/{run_id}``                   one version of a table, whole and never changed
``{root}/{layer}/{table}/_published/{n}-{run_id}``    empty marker; the highest n names the current version
``{root}/_audit``                                     one appended row per table run
``{root}/_offenders``                                 rejected values of a run's accepted_values checks

A run writes its version directory, the checks read exactly those files, and publishing adds one marker:
creating an empty file is atomic on file systems and object stores alike, nothing is renamed or copied, and
readers see the old version until the marker is there. A failed run leaves the current version as it is.
:func:`remove_old_versions` deletes what no reader needs any more.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.sources.files import file_system

AUDIT_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("layer", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("columns", T.ArrayType(T.StringType())),
    T.StructField("checksum", T.LongType()),
    T.StructField("checks", T.ArrayType(T.StructType([
        T.StructField("check", T.StringType()),
        T.StructField("passed", T.BooleanType()),
        T.StructField("violations", T.LongType()),
        T.StructField("observed", T.StringType()),
        T.StructField("expected", T.StringType()),
    ]))),
    T.StructField("passed", T.BooleanType()),
    T.StructField("published", T.BooleanType()),
    T.StructField("error", T.StringType()),
    T.StructField("source_partition", T.StringType()),
    T.StructField("generated_at", T.TimestampType()),
])


def layer_path(root: str, layer: str, table: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{table}"


def version_path(root: str, layer: str, table: str, run_id: str) -> str:
    return f"{layer_path(root, layer, table)}/{run_id}"


def audit_path(root: str) -> str:
    return f"{root.rstrip('/')}/_audit"


def _markers(spark: SparkSession, root: str, layer: str, table: str) -> list[tuple[int, str]]:
    """(number, run id) of the table's publications, ascending."""
    path, fs = file_system(spark, f"{layer_path(root, layer, table)}/_published")
    names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    return sorted((int(n.partition("-")[0]), n.partition("-")[2]) for n in names)


def current_version(spark: SparkSession, root: str, layer: str, table: str) -> str:
    """The run id of the published version."""
    published = _markers(spark, root, layer, table)
    if not published:
        raise FileNotFoundError(f"{layer}/{table} is not published under {root}")
    return published[-1][1]


def read_layer(spark: SparkSession, root: str, layer: str, table: str) -> DataFrame:
    return spark.read.parquet(version_path(root, layer, table, current_version(spark, root, layer, table)))


def read_layers(spark: SparkSession, root: str, layer: str, tables: Iterable[str]) -> dict[str, DataFrame]:
    return {t: read_layer(spark, root, layer, t) for t in tables}


def write_staged(df: DataFrame, root: str, layer: str, table: str, run_id: str,
                 partition_by: Sequence[str] = ()) -> str:
    """Write ``df`` as the run's version of the table, not published yet; with ``partition_by``, one Hive-style
    directory per value. The rows are first rebalanced on those columns, so each directory gets a few
    large files instead of one per task, and AQE splits a hot value (a day with a third of the rows)
    over several tasks and files instead of one."""
    path = version_path(root, layer, table, run_id)
    _write(df, path, partition_by)
    return path


def _write(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the whole directory: a repeated run id leaves no partition of its first try behind, whatever
    the session's overwrite mode is. A version is written once and read by every later layer and check: zstd."""
    df = df.hint("rebalance", *partition_by) if partition_by else df
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "zstd").partitionBy(*partition_by).parquet(path)


def read_staged(spark: SparkSession, path: str, schema: T.StructType, partition_by: Sequence[str] = ()) -> DataFrame:
    """Re-read a staged directory with the written types (a partition column whose values are all NULL
    would otherwise be inferred as text); partition columns come last, as on every later read."""
    if not partition_by:
        return spark.read.parquet(path)
    parts = set(partition_by)
    ordered = [f for f in schema.fields if f.name not in parts] + [schema[c] for c in partition_by]
    return spark.read.schema(T.StructType(ordered)).parquet(path)


def publish(spark: SparkSession, root: str, layer: str, table: str, run_id: str) -> None:
    """Make the run's version the current one."""
    published = _markers(spark, root, layer, table)
    number = published[-1][0] + 1 if published else 1
    path, fs = file_system(spark, f"{layer_path(root, layer, table)}/_published/{number:012d}-{run_id}")
    fs.create(path, False).close()


def remove_old_versions(spark: SparkSession, root: str, layer: str, table: str, keep: int = 2) -> list[str]:
    """Delete all versions but the ``keep`` published last; returns the run ids that are gone."""
    if keep < 1:
        raise ValueError("the current version must stay")
    stay = {run for _, run in _markers(spark, root, layer, table)[-keep:]}
    path, fs = file_system(spark, layer_path(root, layer, table))
    gone = [s for s in fs.listStatus(path) if s.isDirectory() and s.getPath().getName() not in stay | {"_published"}]
    for s in gone:
        fs.delete(s.getPath(), True)
    return sorted(s.getPath().getName() for s in gone)


def schema_strings(df: DataFrame) -> list[str]:
    return [f"{f.name}:{f.dataType.simpleString()}" for f in df.schema.fields]


AUDIT_KEYS = ("layer", "table_name", "run_id")


def append_audit(spark: SparkSession, root: str, record: dict) -> None:
    """Append one audit row (the run's manifest); history is kept, unlike a per-table JSON file.

    Each row lands in its own ``layer=/table_name=/run_id=`` directory: tables of a layer run
    concurrently without sharing a committer directory, and a retried run rewrites its own row
    instead of duplicating it."""
    rec = dict(record)
    rec.setdefault("generated_at", dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
    row = spark.createDataFrame([tuple(rec.get(f.name) for f in AUDIT_SCHEMA.fields)], AUDIT_SCHEMA)
    where = "/".join(f"{k}={rec[k]}" for k in AUDIT_KEYS)
    row.drop(*AUDIT_KEYS).coalesce(1).write.mode("overwrite").parquet(f"{audit_path(root)}/{where}")


def read_audit(spark: SparkSession, root: str) -> DataFrame:
    """The audit table; the key columns come from the directory names with the declared types."""
    return (spark.read.schema(AUDIT_SCHEMA).option("basePath", audit_path(root)).parquet(audit_path(root))
            .select(*[f.name for f in AUDIT_SCHEMA.fields]))


def append_offenders(df: DataFrame, root: str, layer: str, table: str, run_id: str) -> None:
    """Keep a run's rejected values beside the audit: rows ``(check, value, rows)``, written by the executors."""
    out = df.drop("layer", "table_name")
    out.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(
        f"{root.rstrip('/')}/_offenders/layer={layer}/table_name={table}/run_id={run_id}")


def read_offenders(spark: SparkSession, root: str) -> DataFrame:
    base = f"{root.rstrip('/')}/_offenders"
    return spark.read.schema("check string, value string, rows long, layer string, table_name string, run_id string").option(
        "basePath", base).parquet(base)


def compare_runs(audit: DataFrame) -> DataFrame:
    """DQ-11: per (layer, table), each run next to the version that was published before it; ``unchanged``
    when the content checksums are equal (NULL for a first run). Runs that were not published are compared,
    but nothing is compared with them."""
    before = Window.partitionBy("layer", "table_name").orderBy("generated_at", "run_id").rowsBetween(Window.unboundedPreceding, -1)

    def previous(col: str) -> Column:
        live = F.when(F.col("published"), F.struct(F.col(col)))
        return F.last(live, ignorenulls=True).over(before)[col]

    return (audit.select("layer", "table_name", "run_id", "generated_at", "rows", "checksum", "passed", "published")
            .withColumn("previous_checksum", previous("checksum"))
            .withColumn("previous_rows", previous("rows"))
            .withColumn("unchanged", F.col("checksum") == F.col("previous_checksum")))
