"""Data-quality operators: declared checks compiled into as few Spark jobs as possible.

A check suite for one table becomes ONE result DataFrame ``(layer, table_name, check, passed, violations,
observed, expected)``, built from
* one fused global aggregate over the table: row count, NULL counts, range and accepted-value violations and
  cast audits are all ``count_if`` expressions of the same scan;
* one grouped aggregate per ``unique`` check (excess rows, NULL keys comparing equal); partial aggregation
  collapses hot keys map-side. It is a pass of its own on purpose: over written Parquet it reads the key
  columns only, while carrying every other check's counters through its shuffle would move more;
* one distinct + ``left_anti`` join per ``referential`` check (NULL never matches, so a NULL key is an orphan);
* one pair of counts per ``row_count_equals_source`` check.
The parts are united and collected once: the driver receives one small row per check, never table data.
The values that an ``accepted_values`` check rejects are a table of their own (:func:`offenders`), complete
and distributed.

Semantics: ``range`` bounds are inclusive, ``None`` means open, NULL passes (three-valued logic), NaN fails an
upper bound only; ``accepted_values`` lets NULL pass.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.functions.hashing import checksum_agg
from lakestrata.specs import Check, declared_checks

RESULT_COLUMNS = ["layer", "table_name", "check", "passed", "violations", "observed", "expected"]
OFFENDER_SCHEMA = "layer string, table_name string, check string, value string, rows long"


@dataclass(frozen=True)
class CheckResult:
    """``observed`` is the figure that was found, ``expected`` the rule it is held against."""

    layer: str
    table_name: str
    check: str
    passed: bool
    violations: int
    observed: str
    expected: str


class QualityError(RuntimeError):
    """Raised after ALL checks of a table ran, listing every failure."""

    def __init__(self, layer: str, table: str, failures: list[CheckResult]):
        self.failures = failures
        super().__init__(f"{layer}/{table}: " + "; ".join(f"{f.check} observed={f.observed} expected={f.expected}" for f in failures))


# ------------------------------------------------------------------------------------------ parts

def outside(c: Check) -> Column:
    """Whether a row's value is not one of an ``accepted_values`` check's."""
    return ~F.col(c.column).isin(list(c.values))


def _violations(c: Check) -> Column | None:
    """The violation count of a check that one scan answers, as an aggregate."""
    col = F.col(c.column) if c.columns else None
    if c.kind == "row_count_min":
        return F.greatest(F.lit(c.minimum) - F.count(F.lit(1)), F.lit(0)).cast("bigint")
    if c.kind == "not_null":
        return F.count_if(col.isNull())
    if c.kind == "accepted_values":
        return F.count_if(outside(c))
    if c.kind == "cast_audit":
        return F.count_if(col.isNotNull() & col.try_cast(c.cast_type).isNull())
    if c.kind == "range":
        sides = [F.count_if(col < F.lit(c.lo))] * (c.lo is not None) + [F.count_if(col > F.lit(c.hi))] * (c.hi is not None)
        return reduce(Column.__add__, sides, F.lit(0).cast("bigint"))
    return None


def _expected(c: Check) -> str:
    return {
        "row_count_min": f"rows >= {c.minimum}", "not_null": "no NULL", "accepted_values": f"one of {len(c.values)} values",
        "range": f"{'-inf' if c.lo is None else c.lo} .. {'inf' if c.hi is None else c.hi}", "cast_audit": f"parses as {c.cast_type}",
        "unique": f"one row per {'+'.join(c.columns)}", "row_count_equals_source": f"rows of {c.ref_layer}/{c.ref_table}",
        "referential": f"found in {c.ref_layer}/{c.ref_table}",
    }[c.kind]


STAT_ROWS = "__rows__"
STAT_CHECKSUM = "__checksum__"


def _rows(layer: str, table: str, agg: DataFrame, parts: list[tuple[str, str, str, str]]) -> DataFrame:
    """A one-row frame as result rows: (check name, violation column, observed column, expected) each."""
    structs = [F.struct(F.lit(name).alias("check"), (F.col(v) == 0).alias("passed"), F.col(v).cast("bigint").alias("violations"),
                        F.col(seen).cast("string").alias("observed"), F.lit(want).alias("expected"))
               for name, v, seen, want in parts]
    return (agg.select(F.explode(F.array(*structs)).alias("r"))
               .select(F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), "r.*"))


def fused_check_frame(df: DataFrame, checks: list[Check], layer: str, table: str,
                      checksum_cols: list[str] | None = None, stats: bool = False) -> DataFrame | None:
    """The checks answered by one scan, as result rows. With ``stats`` the same aggregate also yields two
    pseudo-rows, the row count and the content checksum."""
    fused = [(c, v) for c in checks if (v := _violations(c)) is not None]
    if not fused and not stats:
        return None
    aggs = [v.alias(f"v{i}") for i, (_, v) in enumerate(fused)] + [F.count(F.lit(1)).alias("n")]
    parts = [(c.name, f"v{i}", "n" if c.kind == "row_count_min" else f"v{i}", _expected(c)) for i, (c, _) in enumerate(fused)]
    if stats:
        aggs.append(checksum_agg(checksum_cols if checksum_cols is not None else df.columns).alias("checksum"))
        parts += [(STAT_ROWS, "n", "n", ""), (STAT_CHECKSUM, "checksum", "checksum", "")]
    return _rows(layer, table, df.agg(*aggs), parts)


def unique_check_frame(df: DataFrame, c: Check, layer: str, table: str) -> DataFrame:
    per_key = df.groupBy(*c.columns).agg(F.count(F.lit(1)).alias("n"))
    excess = per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("v"))
    return _rows(layer, table, excess, [(c.name, "v", "v", _expected(c))])


def referential_check_frame(df: DataFrame, c: Check, ref: DataFrame, layer: str, table: str) -> DataFrame:
    known = ref.select(F.expr(c.ref_column or c.column).alias(c.column)).distinct()
    orphans = df.select(c.column).distinct().join(known, c.column, "left_anti").agg(F.count(F.lit(1)).alias("v"))
    return _rows(layer, table, orphans, [(c.name, "v", "v", _expected(c))])


def source_count_check_frame(df: DataFrame, c: Check, src: DataFrame, layer: str, table: str) -> DataFrame:
    one = [x.agg(F.count(F.lit(1)).alias("n")).select(F.lit(sign).alias("sign"), "n") for sign, x in ((1, df), (-1, src))]
    both = one[0].unionByName(one[1]).agg(F.abs(F.sum(F.col("sign") * F.col("n"))).alias("v"),
                                          F.max(F.when(F.col("sign") == 1, F.col("n"))).alias("n"))
    return _rows(layer, table, both, [(c.name, "v", "n", _expected(c))])


# ------------------------------------------------------------------------------------------ suite

def check_frame(df: DataFrame, checks: Iterable[Check], layer: str, table: str,
                refs: Mapping[str, DataFrame] | None = None, stats: bool = False,
                checksum_cols: list[str] | None = None) -> DataFrame | None:
    """All ``checks`` on ``df`` as one lazily evaluated result DataFrame (``None`` if no checks).

    ``refs`` maps ``ref_table`` (or ``"{ref_layer}/{ref_table}"``) to the frame a ``referential`` or
    ``row_count_equals_source`` check compares against.
    """
    checks, refs = list(checks), refs or {}
    fused = fused_check_frame(df, checks, layer, table, checksum_cols=checksum_cols, stats=stats)
    parts = [] if fused is None else [fused]
    for c in checks:
        if c.kind == "unique":
            parts.append(unique_check_frame(df, c, layer, table))
        elif c.ref_table:
            ref = refs.get(f"{c.ref_layer}/{c.ref_table}", refs.get(c.ref_table))
            if ref is None:
                raise ValueError(f"check {c.name} needs the frame of {c.ref_layer}/{c.ref_table}")
            compare = referential_check_frame if c.kind == "referential" else source_count_check_frame
            parts.append(compare(df, c, ref, layer, table))
    return reduce(DataFrame.unionByName, parts) if parts else None


def offenders(df: DataFrame, checks: Iterable[Check], layer: str, table: str) -> DataFrame:
    """Every distinct value that an ``accepted_values`` check rejects, with its number of rows: a grouped
    count per check, complete however many values there are."""
    parts = [df.where(outside(c)).groupBy(F.col(c.column).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("rows"))
             .select(F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), F.lit(c.name).alias("check"), "value", "rows")
             for c in checks if c.kind == "accepted_values"]
    return reduce(DataFrame.unionByName, parts) if parts else df.sparkSession.createDataFrame([], OFFENDER_SCHEMA)


@dataclass(frozen=True)
class TableReport:
    results: list[CheckResult]
    rows: int | None = None
    checksum: int | None = None

    @property
    def failures(self) -> list[CheckResult]:
        return [r for r in self.results if not r.passed]


def run_report(df: DataFrame, checks: Iterable[Check], layer: str, table: str,
               refs: Mapping[str, DataFrame] | None = None, stats: bool = True,
               checksum_cols: list[str] | None = None) -> TableReport:
    """Run the checks (plus count and checksum with ``stats``) as ONE action; results come back in
    declaration order. Never raises on a failed check."""
    checks = list(checks)
    frame = check_frame(df, checks, layer, table, refs, stats=stats, checksum_cols=checksum_cols)
    if frame is None:
        return TableReport([])
    by_check = {r["check"]: r for r in frame.collect()}  # one row per check
    stat = {k: by_check.pop(k)["violations"] if k in by_check else None for k in (STAT_ROWS, STAT_CHECKSUM)}
    results = [CheckResult(**{k: by_check[c.name][k] for k in RESULT_COLUMNS}) for c in checks]
    return TableReport(results, stat[STAT_ROWS], stat[STAT_CHECKSUM])


def run_checks(df: DataFrame, checks: Iterable[Check], layer: str, table: str,
               refs: Mapping[str, DataFrame] | None = None) -> list[CheckResult]:
    """Run the checks as one action; results in declaration order; never raises on failure."""
    return run_report(df, checks, layer, table, refs, stats=False).results


def log_results(layer: str, table: str, results: list[CheckResult], log=print) -> None:
    for r in results:
        log(f"{layer}/{table} {'ok' if r.passed else 'VIOLATED'} {r.check} violations={r.violations} observed={r.observed} expected={r.expected}")


def run_suite(df: DataFrame, layer: str, table: str, refs: Mapping[str, DataFrame] | None = None,
              extra: bool = False, raise_on_failure: bool = True, log=print) -> list[CheckResult]:
    """Run every check declared for ``(layer, table)``; undeclared table ⇒ ``[]``.

    All checks run and are reported before a :class:`QualityError` lists every failure.
    """
    checks = declared_checks(layer, table, extra=extra)
    if not checks:
        return []
    results = run_checks(df, checks, layer, table, refs)
    failures = [r for r in results if not r.passed]
    if log:
        log_results(layer, table, results, log)
    if failures and raise_on_failure:
        raise QualityError(layer, table, failures)
    return results


# --------------------------------------------------------------------------- individual checks

def _one(df: DataFrame, c: Check, refs=None) -> CheckResult:
    return run_checks(df, [c], "adhoc", "adhoc", refs)[0]


def check_row_count_min(df: DataFrame, minimum: int) -> CheckResult:
    return _one(df, Check("row_count_min", minimum=minimum))


def check_not_null(df: DataFrame, column: str) -> CheckResult:
    return _one(df, Check("not_null", (column,)))


def check_unique(df: DataFrame, columns: list[str]) -> CheckResult:
    return _one(df, Check("unique", tuple(columns)))


def check_accepted_values(df: DataFrame, column: str, values: Iterable) -> CheckResult:
    return _one(df, Check("accepted_values", (column,), values=tuple(values)))


def check_range(df: DataFrame, column: str, minimum=None, maximum=None) -> CheckResult:
    return _one(df, Check("range", (column,), lo=minimum, hi=maximum))


def check_row_count_equals_source(df: DataFrame, source: DataFrame, source_name: str = "source") -> CheckResult:
    return _one(df, Check("row_count_equals_source", ref_table=source_name), {source_name: source})


def check_referential(df: DataFrame, column: str, ref: DataFrame, ref_name: str = "ref") -> CheckResult:
    return _one(df, Check("referential", (column,), ref_table=ref_name), {ref_name: ref})


def check_cast_audit(df: DataFrame, column: str, cast_type: str) -> CheckResult:
    return _one(df, Check("cast_audit", (column,), cast_type=cast_type))


# ------------------------------------------------------------------------------------- checksum

def checksum_frame(df: DataFrame, columns: list[str] | None = None, compat: bool = False) -> DataFrame:
    """One row: ``checksum`` (bigint, NULL for an empty table), the wrapped 64-bit sum of per-row
    ``xxhash64``, and ``linhas``, the row count of the same scan. Order independent; one partial + final aggregate, no sort, no shuffle of rows."""
    cols = list(columns) if columns is not None else df.columns
    return df.agg(checksum_agg(cols, compat).alias("checksum"), F.count(F.lit(1)).alias("linhas"))


def checksum(df: DataFrame, columns: list[str] | None = None, compat: bool = False) -> str:
    """Checksum as text; ``"None"`` for an empty table (the reference's representation)."""
    return str(checksum_frame(df, columns, compat).collect()[0]["checksum"])


def content_columns(df: DataFrame, technical: Iterable[str] = ()) -> list[str]:
    """Columns that carry content: everything but the processing stamps, so that two runs over the
    same data give the same checksum."""
    tech = set(technical) | {"data_processamento_bronze", "dt_criacao_silver", "dt_criacao_gold"}
    return [c for c in df.columns if c not in tech]
