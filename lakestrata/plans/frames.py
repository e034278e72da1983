"""Lazily built layer frames over one data directory.

``Layers(spark, sf_dir)`` derives raw → Silver → Gold frames from the driver tables without writing
anything; the accessors return lazy plans, so Catalyst prunes columns and pushes filters through the
whole chain down to the Parquet scans. A raw frame is built once per ``Layers`` object and the same
DataFrame is reused by every branch of a query (identical subtrees also let Spark reuse exchanges);
nothing is cached in memory. Jobs that publish layers read the written tables
instead (see :mod:`lakestrata.plans.jobs`).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.operators import gold as gold_ops
from lakestrata.operators.gold import ORDER_HEADER
from lakestrata.operators.silver import to_silver
from lakestrata.sources.adapter import dirty_table, raw_table
from lakestrata.sources.layers import read_layer
from lakestrata.specs import gold_spec


class Layers:
    def __init__(self, spark: SparkSession, sf_dir: str, dirty: bool = False):
        """``dirty``: with the faults of FIXTURES.md part C, for checks that must find something."""
        self.spark = spark
        self.sf_dir = sf_dir
        self.dirty = dirty
        self._raw: dict[str, DataFrame] = {}

    def raw(self, table: str) -> DataFrame:
        if table not in self._raw:
            clean = raw_table(self.spark, self.sf_dir, table)
            self._raw[table] = dirty_table(clean, table) if self.dirty else clean
        return self._raw[table]

    def silver(self, table: str) -> DataFrame:
        return to_silver(table, self.raw(table))

    def gold(self, name: str) -> DataFrame:
        src = {s: self.silver(s) for s in gold_spec(name).sources}
        return gold_ops.build(name, src)

    def order_grain(self) -> DataFrame:
        """One row per order that has an item, with its delivery measures."""
        return gold_ops.order_grain({s: self.silver(s) for s in ("orders", "items")})

    def order_totals(self) -> DataFrame:
        """(order_id, customer_id, total, n) of every order that has an item."""
        return gold_ops.order_totals({s: self.silver(s) for s in ("orders", "items")})


class PublishedLayers:
    """The same accessors over a published lake (``{root}/{layer}/{table}`` Parquet): what an analyst
    uses once the layer jobs have run. Technical stamp columns are present and simply not selected."""

    def __init__(self, spark: SparkSession, lake_root: str):
        self.spark = spark
        self.root = lake_root

    def raw(self, table: str) -> DataFrame:
        return read_layer(self.spark, self.root, "bronze", table)

    def silver(self, table: str) -> DataFrame:
        return read_layer(self.spark, self.root, "silver", table)

    def gold(self, name: str) -> DataFrame:
        gold_spec(name)
        return read_layer(self.spark, self.root, "gold", name)

    def order_grain(self) -> DataFrame:
        return self.gold("fato_pedidos_itens").select(*ORDER_HEADER.columns, *ORDER_HEADER.after).distinct()

    def order_totals(self) -> DataFrame:
        return gold_ops.add_up(self.gold("fato_pedidos_itens").groupBy("order_id", "customer_id"))

    def gold_between(self, name: str, start: str | dt.date, end: str | dt.date) -> DataFrame:
        """Rows of a dated Gold fact whose date lies in ``[start, end]``. The same range is also put on
        the month layout column, so Spark reads only the matching month directories."""
        spec = gold_spec(name)
        if not spec.partition_month_of:
            raise ValueError(f"{name} has no date layout")
        lo, hi = F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date")
        d, m = F.col(spec.partition_month_of), F.col(spec.partition_column)
        return self.gold(name).where(d.between(lo, hi) & m.between(F.trunc(lo, "month"), F.trunc(hi, "month")))
