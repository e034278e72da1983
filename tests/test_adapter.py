"""The parts that line items are dealt into follow the table's size; the rows do not depend on them."""

import pytest

from lakestrata.sources import adapter


@pytest.fixture()
def tables(spark, scratch):
    rows = spark.range(3000).selectExpr(
        "IF(id % 50 = 0, NULL, IF(id % 3 = 0, 7, id DIV 4)) AS l_orderkey", "CAST(id % 5 AS INT) AS l_linenumber", "id % 11 AS l_partkey", "id % 3 AS l_suppkey",
        "id % 100 / 4 AS l_extendedprice", "0.05D AS l_tax", "substr('ANR', CAST(id % 3 + 1 AS INT), 1) AS l_returnflag", "TIMESTAMP_NTZ'2018-01-05 00:00:00' AS l_shipdate")
    rows.coalesce(1).write.parquet(f"{scratch}/lineitem.parquet")
    return scratch


@pytest.mark.parametrize("table", ["items", "payments"])
def test_parts_follow_the_size_and_rows_do_not(spark, tables, table, monkeypatch):
    one = adapter.raw_table(spark, tables, table)
    assert adapter.driver_parts(spark, tables, "lineitem") == 1 == one.rdd.getNumPartitions()
    monkeypatch.setattr(adapter, "PART_BYTES", 1000)
    parts = adapter.driver_parts(spark, tables, "lineitem")
    many = adapter.raw_table(spark, tables, table)
    assert parts > 5 and 5 < many.rdd.getNumPartitions() <= parts
    assert sorted(many.collect(), key=str) == sorted(one.collect(), key=str)
