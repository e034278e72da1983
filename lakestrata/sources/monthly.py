"""Layer tables that are brought up to date month by month, instead of being replaced.

Layout below ``{root}/{layer}/{table}``:
``data/layout_month=YYYY-MM-DD/layout_run=R``   the rows of one month as run R wrote them, never changed
``months/R``, ``schemas/R``                     the version R: which run holds each month and its rows; the columns' types
``_published/{n}-R``                            empty marker; the highest n names the current version (as for whole tables)

:func:`publish_changes` compares the new content with the current version by key and row hash and writes only the
months in which a key came, went or changed; a version lists the directories of older runs for all others. When
nothing changed, nothing is written. A version becomes visible by its marker, so readers never see half of it, and a
repeated run replaces its own directories only.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.operators.changes import change_counts, change_set
from lakestrata.operators.quality import CheckResult, run_report
from lakestrata.session import materialize
from lakestrata.sources.files import file_system
from lakestrata.sources.layers import current_version, layer_path, publish
from lakestrata.specs import Check

#: directory of rows without a date
NO_MONTH = "none"


@dataclass
class ChangeOutcome:
    run_id: str
    changes: dict[str, int] = field(default_factory=dict)
    written: list[str] = field(default_factory=list)
    dropped: list[str] = field(default_factory=list)
    failures: list[CheckResult] = field(default_factory=list)
    published: bool = False


def _months_path(root: str, layer: str, table: str, run_id: str) -> str:
    return f"{layer_path(root, layer, table)}/months/{run_id}"


def read_months(spark: SparkSession, root: str, layer: str, table: str, run_id: str | None = None) -> DataFrame:
    """(month, run, rows) of a version, by default the current one."""
    run_id = run_id or current_version(spark, root, layer, table)
    return spark.read.schema("month string, run string, rows long").parquet(_months_path(root, layer, table, run_id))


def _schema_path(root: str, layer: str, table: str, run_id: str) -> str:
    return f"{layer_path(root, layer, table)}/schemas/{run_id}"


def _read(spark: SparkSession, root: str, layer: str, table: str, where: list[tuple[str, str]], schema: T.StructType) -> DataFrame:
    base = f"{layer_path(root, layer, table)}/data"
    if not where:
        return spark.createDataFrame([], schema)
    paths = [f"{base}/layout_month={m}/layout_run={r}" for m, r in where]
    return spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*schema.fieldNames())


def read_monthly(spark: SparkSession, root: str, layer: str, table: str, start: str | dt.date | None = None,
                 end: str | dt.date | None = None, run_id: str | None = None) -> DataFrame:
    """The table's current version, or the one of ``run_id``; with ``start`` or ``end``, only the directories of months
    in that range are opened (the caller still filters by day)."""
    where = [(r["month"], r["run"]) for r in read_months(spark, root, layer, table, run_id).collect()]  # one row a month
    if start is not None:
        where = [x for x in where if x[0] != NO_MONTH and x[0] >= f"{start}"[:8] + "01"]
    if end is not None:
        where = [x for x in where if x[0] != NO_MONTH and x[0] <= f"{end}"]
    run_id = run_id or current_version(spark, root, layer, table)
    types = spark.read.schema("types string").parquet(_schema_path(root, layer, table, run_id)).first()[0]
    return _read(spark, root, layer, table, where, T.StructType.fromJson(json.loads(types)))


def _has_version(spark: SparkSession, root: str, layer: str, table: str) -> bool:
    path, fs = file_system(spark, f"{layer_path(root, layer, table)}/_published")
    return fs.exists(path)


def publish_changes(spark: SparkSession, df: DataFrame, root: str, layer: str, table: str, run_id: str, keys: Sequence[str], date_col: str,
                    checks: Sequence[Check] = ()) -> ChangeOutcome:
    """Make ``df`` the content of the table, writing only months that differ from the current version.

    ``keys`` are unique in a version (copies of a key are compared per month). With ``checks``, the version as it would
    be read is checked before its marker is written; if one fails, the current version stays."""
    keys, out = list(keys), ChangeOutcome(run_id)
    month = F.coalesce(F.trunc(date_col, "month").cast("string"), F.lit(NO_MONTH))
    new = df.withColumn("__month", month)
    content = [c for c in df.columns if c not in keys]
    before: dict[str, tuple[str, int]] = {}
    if _has_version(spark, root, layer, table):
        before = {r["month"]: (r["run"], r["rows"]) for r in read_months(spark, root, layer, table).collect()}
        old = _read(spark, root, layer, table, [(m, r) for m, (r, _) in before.items()], df.schema).withColumn("__month", month)
        by_month = materialize(change_set(old, new, [*keys, "__month"], content), "changes")
        touched = sorted(r[0] for r in by_month.select("__month").distinct().collect())
        # a key that moves to another month goes from one and comes to the other: that is an update
        moved = by_month.groupBy(*keys).agg(F.sum("rows_before").alias("b"), F.sum("rows_after").alias("a"))
        kinds = moved.select(F.when(F.col("b") == 0, "insert").when(F.col("a") == 0, "delete").otherwise("update").alias("change"))
    else:
        touched = None
        kinds = new.groupBy(*keys).agg(F.lit("insert").alias("change")).select("change")
    out.changes = {r["change"]: r["keys"] for r in change_counts(kinds).collect()}
    if touched == []:
        return out
    rows = new if touched is None else new.where(F.col("__month").isin(touched))
    data = f"{layer_path(root, layer, table)}/data"
    named = rows.withColumnRenamed("__month", "layout_month").withColumn("layout_run", F.lit(run_id))
    (named.hint("rebalance", "layout_month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
          .partitionBy("layout_month", "layout_run").parquet(data))
    counts = {r["__month"]: r["n"] for r in rows.groupBy("__month").agg(F.count(F.lit(1)).alias("n")).collect()}
    out.written = sorted(counts)
    out.dropped = sorted(m for m in (touched or []) if m not in counts)
    after = {m: x for m, x in before.items() if m not in (touched or [])} | {m: (run_id, n) for m, n in counts.items()}
    listing = spark.createDataFrame([(m, r, n) for m, (r, n) in sorted(after.items())], "month string, run string, rows long")
    listing.coalesce(1).write.mode("overwrite").parquet(_months_path(root, layer, table, run_id))
    types = spark.createDataFrame([(json.dumps(df.schema.jsonValue()),)], "types string")
    types.coalesce(1).write.mode("overwrite").parquet(_schema_path(root, layer, table, run_id))
    if checks:
        version = _read(spark, root, layer, table, [(m, r) for m, (r, _) in after.items()], df.schema)
        out.failures = run_report(version, list(checks), layer, table, {}).failures
    if not out.failures:
        publish(spark, root, layer, table, run_id)
        out.published = True
    return out
