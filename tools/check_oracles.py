"""Run every registered query in Spark and its oracle in DuckDB on one data directory and compare
row count, column names and values (order-insensitive). Usage:

    python tools/check_oracles.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

BASE_TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
               "benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in BASE_TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "as_integer_ratio") and not isinstance(v, bool):  # Decimal
        return float(v)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def compare(spark, con, name: str, sf_dir: str, queries, oracles, sdf=None):
    sdf = sdf if sdf is not None else queries[name](spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(_norm(r[c]) for c in sorted(s_cols)) for r in sdf.collect()]
    rel = con.sql(oracles[name])
    d_cols = rel.columns
    idx = [d_cols.index(c) for c in sorted(d_cols)] if sorted(d_cols) == sorted(s_cols) else None
    if idx is None:
        return False, f"columns differ: spark={sorted(s_cols)} duck={sorted(d_cols)}"
    d_rows = [tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()]
    if len(s_rows) != len(d_rows):
        return False, f"row count spark={len(s_rows)} duck={len(d_rows)}"
    s_sorted, d_sorted = sorted(s_rows, key=_key), sorted(d_rows, key=_key)
    bad = [(a, b) for a, b in zip(s_sorted, d_sorted) if a != b]
    if bad:
        return False, f"{len(bad)} rows differ; first: spark={bad[0][0]} duck={bad[0][1]} cols={sorted(s_cols)}"
    types = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    dtypes = dict(zip(d_cols, [str(t) for t in rel.types]))
    return True, f"{len(s_rows)} rows; types spark={[types[c] for c in sorted(s_cols)]} duck={[dtypes[c] for c in sorted(d_cols)]}"


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from lakestrata.plans.catalog import ORACLES, QUERIES
    from lakestrata.session import get_session

    names = argv[2:] or list(QUERIES)
    spark = get_session("local[8]", shuffle_partitions=8)
    if os.environ.get("ANSI"):
        spark.conf.set("spark.sql.ansi.enabled", os.environ["ANSI"])
    con = duck(sf_dir)
    failed = 0
    for n in names:
        if n not in ORACLES:
            print(f"SKIP {n} (no oracle)")
            continue
        t0 = time.time()
        try:
            ok, msg = compare(spark, con, n, sf_dir, QUERIES, ORACLES)
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:400]}"
        failed += not ok
        print(f"{'OK  ' if ok else 'FAIL'} {n} ({time.time() - t0:.1f}s) {msg}", flush=True)
    print(f"{len(names) - failed}/{len(names)} match")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
