"""Registered queries against their DuckDB texts, and what every one of them returns."""

import duckdb
import pytest

from lakestrata.llm import registered

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = registered()
TABLES = ("documents", "pages", "benchmark", "labels", "conversations", "embeddings")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(str(tuple(r[c] for c in columns)) for r in df.collect())
    assert got == sorted(map(str, con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()))


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


def test_entry_has_them():
    import os
    import sys
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    import __spark_entry__
    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
