"""The registered queries and their DuckDB oracles, by key."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakestrata.plans.oracle_sql import with_ctes
from lakestrata.session import checkpoint_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None, dirty: bool = False):
    """Register a query; ``sql`` may use the layers' tables (``raw_x``, ``silver_x``, ``gold_x``)."""
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_ctes(sql, dirty)
        return fn
    return deco


def fresh_folder(spark: SparkSession, tag: str) -> str:
    """A folder of its own below the session's checkpoint folder, for a query that writes files."""
    return f"{checkpoint_dir(spark).rstrip('/')}/lakestrata-{tag}-{uuid.uuid4().hex}"
