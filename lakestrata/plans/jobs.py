"""Layer jobs (JOB-1..4): landing → bronze → silver → gold, each table validated before publish.

One table run = build the lazy plan → write it as a version of its own (action 1) → one report action over the
written files: every declared check, the row count and the content checksum (action 2; the values that a failed
``accepted_values`` check rejects are written, all of them) → publish by one marker file if every check passed → append the
audit row, pass or fail (action 3). The reference runs 16 actions for the item fact; here it is 3 plus the
landing-partition lookup for Bronze.

``run_layer`` runs the tables of a layer (optionally several at once: they are independent Spark
jobs submitted from threads) and collects every outcome; ``run_all`` starts a layer only when the
whole previous layer passed. Executor loss is handled by Spark's task retry: every write is a
whole-directory overwrite of a run-specific version path, so a retried or re-run job converges to
the same published state; nothing relies on cached data for correctness.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.operators import gold as gold_ops
from lakestrata.operators.quality import CheckResult, content_columns, log_results, offenders, run_report
from lakestrata.operators.silver import to_silver
from lakestrata.sources import layers as io
from lakestrata.sources.landing import latest_ingestion, read_landing, write_landing
from lakestrata.specs import GOLD_OBJECTS, TABLES, declared_checks, gold_spec, table_spec

STAMP = {"bronze": "data_processamento_bronze", "silver": "dt_criacao_silver", "gold": "dt_criacao_gold"}
LAYERS = ("bronze", "silver", "gold")


@dataclass(frozen=True)
class LakePaths:
    landing: str
    lake: str


@dataclass
class TableOutcome:
    layer: str
    table: str
    run_id: str
    passed: bool
    published: bool
    rows: int | None
    checksum: int | None
    results: list[CheckResult] = field(default_factory=list)
    source_partition: str | None = None
    error: str | None = None

    @property
    def failures(self) -> list[CheckResult]:
        return [r for r in self.results if not r.passed]


class LayerGateError(RuntimeError):
    def __init__(self, layer: str, outcomes: list[TableOutcome]):
        self.outcomes = outcomes
        bad = [o for o in outcomes if not o.passed]
        msg = "; ".join(f"{o.table}: " + (o.error or ", ".join(r.check for r in o.failures)) for o in bad)
        super().__init__(f"layer {layer} failed for {len(bad)} table(s): {msg}")


def _stamp(run_ts: dt.datetime | None) -> Column:
    return F.lit(run_ts).cast("timestamp") if run_ts is not None else F.current_timestamp()


def _new_run_id() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S") + "-" + uuid.uuid4().hex[:8]


def _refs(spark: SparkSession, paths: LakePaths, checks) -> dict[str, DataFrame]:
    return {f"{c.ref_layer}/{c.ref_table}": io.read_layer(spark, paths.lake, c.ref_layer, c.ref_table)
            for c in checks if c.ref_table}


def stage_validate_publish(spark: SparkSession, paths: LakePaths, layer: str, table: str, df: DataFrame,
                           run_id: str, extra_checks: bool = False, source_partition: str | None = None,
                           log=print, partition_by: tuple[str, ...] = ()) -> TableOutcome:
    """Write the run's version, check the written files, publish if they pass, and then write the audit row
    with what really happened; an error while publishing is in the row and goes on to the caller."""
    staged_path = io.write_staged(df, paths.lake, layer, table, run_id, partition_by)
    staged = io.read_staged(spark, staged_path, df.schema, partition_by)
    checks = declared_checks(layer, table, extra=extra_checks)
    report = run_report(staged, checks, layer, table, _refs(spark, paths, checks), stats=True,
                        checksum_cols=content_columns(staged))
    if log and report.results:
        log_results(layer, table, report.results, log)
    if any(c.kind == "accepted_values" for c in checks) and report.failures:
        io.append_offenders(offenders(staged, checks, layer, table), paths.lake, layer, table, run_id)
    passed, error = not report.failures, None
    if passed:
        try:
            io.publish(spark, paths.lake, layer, table, run_id)
        except Exception as e:
            error = e
    published = passed and error is None
    io.append_audit(spark, paths.lake, {
        "run_id": run_id, "layer": layer, "table_name": table, "rows": report.rows,
        "columns": io.schema_strings(staged), "checksum": report.checksum,
        "checks": [(r.check, r.passed, r.violations, r.observed, r.expected) for r in report.results],
        "passed": passed, "published": published, "error": None if error is None else f"{type(error).__name__}: {error}",
        "source_partition": source_partition,
    })
    if error is not None:
        raise error
    return TableOutcome(layer, table, run_id, passed, published, report.rows, report.checksum, report.results,
                        source_partition)


def bronze_job(spark: SparkSession, paths: LakePaths, table: str, run_id: str | None = None,
               run_ts: dt.datetime | None = None, ingestion_date: str | None = None, **kw) -> TableOutcome:
    spec = table_spec(table)
    partition = ingestion_date or latest_ingestion(spark, paths.landing, [table])
    df = read_landing(spark, paths.landing, spec, partition).withColumn(STAMP["bronze"], _stamp(run_ts))
    return stage_validate_publish(spark, paths, "bronze", table, df, run_id or _new_run_id(),
                                  source_partition=partition, **kw)


def silver_job(spark: SparkSession, paths: LakePaths, table: str, run_id: str | None = None,
               run_ts: dt.datetime | None = None, **kw) -> TableOutcome:
    table_spec(table)
    df = to_silver(table, io.read_layer(spark, paths.lake, "bronze", table)).withColumn(STAMP["silver"],
                                                                                        _stamp(run_ts))
    return stage_validate_publish(spark, paths, "silver", table, df, run_id or _new_run_id(), **kw)


def gold_job(spark: SparkSession, paths: LakePaths, name: str, run_id: str | None = None,
             run_ts: dt.datetime | None = None, **kw) -> TableOutcome:
    spec = gold_spec(name)
    src = io.read_layers(spark, paths.lake, "silver", spec.sources)
    df = gold_ops.build(name, src).withColumn(STAMP["gold"], _stamp(run_ts))
    part: tuple[str, ...] = ()
    if spec.partition_column:
        df = df.withColumn(spec.partition_column, F.trunc(spec.partition_month_of, "month"))
        part = (spec.partition_column,)
    return stage_validate_publish(spark, paths, "gold", name, df, run_id or _new_run_id(),
                                  partition_by=part, **kw)


JOBS = {"bronze": bronze_job, "silver": silver_job, "gold": gold_job}


def layer_tables(layer: str) -> list[str]:
    return [g.name for g in GOLD_OBJECTS] if layer == "gold" else [t.name for t in TABLES]


def run_layer(spark: SparkSession, paths: LakePaths, layer: str, tables: Iterable[str] | None = None,
              run_id: str | None = None, run_ts: dt.datetime | None = None, max_parallel: int = 1,
              log=print, **kw) -> list[TableOutcome]:
    """Run every table of ``layer``; a table's failure (checks or error) never stops the others."""
    if layer not in JOBS:
        raise ValueError(f"unknown layer {layer!r}")
    run_id = run_id or _new_run_id()
    names = list(tables) if tables is not None else layer_tables(layer)
    if layer == "bronze" and "ingestion_date" not in kw:  # one date for the whole run
        kw["ingestion_date"] = latest_ingestion(spark, paths.landing, names)

    def one(name: str) -> TableOutcome:
        try:
            return JOBS[layer](spark, paths, name, run_id=run_id, run_ts=run_ts, log=log, **kw)
        except Exception as e:  # noqa: BLE001 - collected, reported by the gate
            return TableOutcome(layer, name, run_id, False, False, None, None, error=f"{type(e).__name__}: {e}")

    if max_parallel > 1:
        with ThreadPoolExecutor(max_workers=max_parallel) as ex:
            return list(ex.map(one, names))
    return [one(n) for n in names]


def run_all(spark: SparkSession, paths: LakePaths, run_ts: dt.datetime | None = None, max_parallel: int = 1,
            log=print, **kw) -> dict[str, list[TableOutcome]]:
    """bronze → silver → gold; a layer starts only if the whole previous layer passed."""
    run_id = _new_run_id()
    out: dict[str, list[TableOutcome]] = {}
    for layer in LAYERS:
        outcomes = run_layer(spark, paths, layer, run_id=run_id, run_ts=run_ts, max_parallel=max_parallel,
                             log=log, **kw)
        out[layer] = outcomes
        if not all(o.passed for o in outcomes):
            raise LayerGateError(layer, outcomes)
    return out


def land_tables(frames: dict[str, DataFrame], landing_root: str, ingestion_date: str | dt.date,
                max_parallel: int = 1) -> None:
    """Drop raw frames into the landing zone (one partition per ingestion date); independent tables
    may be written concurrently."""
    for name in frames:
        table_spec(name)

    def one(item):
        write_landing(item[1], landing_root, item[0], ingestion_date)

    if max_parallel > 1:
        with ThreadPoolExecutor(max_workers=max_parallel) as ex:
            list(ex.map(one, frames.items()))
    else:
        for item in frames.items():
            one(item)


def main(argv: list[str] | None = None) -> int:
    """Command line: ``python -m lakestrata.plans.jobs --landing L --lake K [--layer X [--table T ...]]``.

    Without ``--layer`` all three layers run with gating; with it, the named layer (optionally only
    some tables). Exit status 1 when any table failed."""
    import argparse

    from lakestrata.session import get_session

    ap = argparse.ArgumentParser(prog="lakestrata-jobs")
    ap.add_argument("--landing", required=True)
    ap.add_argument("--lake", required=True)
    ap.add_argument("--layer", choices=LAYERS)
    ap.add_argument("--table", action="append")
    ap.add_argument("--parallel", type=int, default=1)
    a = ap.parse_args(argv)
    spark = get_session()
    paths = LakePaths(a.landing, a.lake)
    try:
        if a.layer:
            outcomes = run_layer(spark, paths, a.layer, a.table, max_parallel=a.parallel)
        else:
            outcomes = [o for v in run_all(spark, paths, max_parallel=a.parallel).values() for o in v]
    except LayerGateError as e:
        print(e)
        return 1
    bad = [o for o in outcomes if not o.passed]
    for o in outcomes:
        print(f"{o.layer}/{o.table}: {'published' if o.published else 'FAILED'} rows={o.rows} checksum={o.checksum}"
              + (f" error={o.error}" if o.error else ""))
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
