"""Every registered query against its DuckDB oracle on the smallest data set, plus plan guards:
no cartesian product or nested-loop join, no Python UDF in the hot path."""

import re

import pytest

import __spark_entry__ as entry
from small_data import SMALL_SF
from lakestrata.plans.catalog import ORACLES, QUERIES
from tools.check_oracles import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SMALL_SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SMALL_SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op} in plan"
    ok, msg = compare(spark, con, name, SMALL_SF, QUERIES, ORACLES, sdf=df)
    assert ok, msg


def test_scans_are_pruned(spark):
    plan = QUERIES["q_revenue_by_state"](spark, SMALL_SF)._jdf.queryExecution().executedPlan().toString()
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    lineitem = [x for x in schemas if "l_orderkey" in x]
    assert lineitem and all("l_quantity" not in x and "l_discount" not in x for x in lineitem)


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["customer_state", "receita", "posicao"] and df.count() == 5


@pytest.mark.parametrize("layer", ["bronze", "silver", "gold"])
def test_suites_find_something(con, layer):
    rows = con.sql(ORACLES[f"dq_suite_{layer}"]).fetchall()
    assert len(rows) == {"bronze": 9, "silver": 25, "gold": 21}[layer]
    assert any(r[-1] > 0 for r in rows) and any(r[-1] == 0 for r in rows)
