"""Change sets: what differs between two versions of a table, by key.

Both versions are reduced to key, row count and a 64-bit content hash, put one below the other and added up per key: a
full outer comparison in one shuffle. Repeated rows of a key collapse before it, NULL keys are equal, and a hot key is
one row. Keys should be unique in a version; copies of a key are compared as a bag (count and sum of hashes).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.functions.hashing import row_hash

INSERT, UPDATE, DELETE = "insert", "update", "delete"


def change_set(old: DataFrame, new: DataFrame, keys: Sequence[str], content: Sequence[str] | None = None) -> DataFrame:
    """(keys..., change, rows_before, rows_after) of every key that is not the same in both versions.

    ``content``: the columns that are compared, by default all common ones but the keys. A key that is in one version
    only is an ``insert`` or a ``delete``, one with other content or another number of copies an ``update``."""
    keys = list(keys)
    if content is None:
        content = [c for c in new.columns if c in old.columns and c not in keys]

    def side(df: DataFrame, after: int) -> DataFrame:
        digest = row_hash(list(content)).cast("decimal(38,0)") if content else F.lit(0).cast("decimal(38,0)")
        return df.select(*(F.col(c) for c in keys), F.lit(1 - after).alias("__before"), F.lit(after).alias("__after"),
                         (digest * (2 * after - 1)).alias("__digest"))

    # equal contents cancel out: hashes count negative in the old version
    each = side(old, 0).unionByName(side(new, 1)).groupBy(*keys).agg(
        F.sum("__before").alias("rows_before"), F.sum("__after").alias("rows_after"), F.sum("__digest").alias("__digest"))
    change = (F.when(F.col("rows_before") == 0, INSERT).when(F.col("rows_after") == 0, DELETE)
              .when((F.col("rows_before") != F.col("rows_after")) | (F.col("__digest") != 0), UPDATE))
    return each.withColumn("change", change).where(F.col("change").isNotNull()).select(*keys, "change", "rows_before", "rows_after")


def with_contents(changes: DataFrame, old: DataFrame, new: DataFrame, keys: Sequence[str], content: Sequence[str]) -> DataFrame:
    """The changes with what was there and what is there now, as structs ``before`` and ``after`` (NULL if absent); for
    versions with unique keys. The changes are few against the table: they are the side that AQE broadcasts if it can."""
    keys = list(keys)

    def packed(df: DataFrame, name: str) -> DataFrame:
        return df.select(*(F.col(c).alias(f"__{c}") for c in keys), F.struct(*(F.col(c) for c in content)).alias(name))

    out = changes
    for df, name in ((old, "before"), (new, "after")):
        same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in keys]
        out = out.join(packed(df, name), same, "left").drop(*(f"__{c}" for c in keys))
    return out


def change_counts(changes: DataFrame) -> DataFrame:
    """(change, keys): how many keys were inserted, updated and deleted."""
    return changes.groupBy("change").agg(F.count(F.lit(1)).alias("keys"))
