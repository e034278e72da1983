"""Exact stratified sampling: the k rows with the smallest hashes of each stratum.

The hash of a row's key is uniform, so a stratum of n rows has its k smallest hashes below about k / n. Rows above that
threshold, with some to spare, go in the scan; the few candidates that stay are ranked. A stratum with too few candidates
gets a wider threshold, until every stratum has k or all its rows. No stratum is sorted or sent whole, and as the hash
belongs to the key, reruns and other orders of the rows give the same sample.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.session import materialize

#: hashes are numbers below 2 ** BITS
BITS = 60


def key_hash(keys: Sequence[str], seed: str) -> Column:
    """The first 60 bits of an md5, as a number: any SQL engine has it."""
    text = F.concat_ws("|", F.lit(seed), *(F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in keys))
    return F.conv(F.substring(F.md5(text), 1, BITS // 4), 16, 10).cast("long")


def stratified_sample(df: DataFrame, strata: Sequence[str], keys: Sequence[str], k: int, seed: str = "sample", spare: float = 6.0) -> DataFrame:
    """The rows of ``df`` with the ``k`` smallest hashes of ``keys`` in each stratum (NULL is a value), all rows of a
    smaller one; ties by the keys."""
    strata, keys = list(strata), list(keys)
    rows = df.withColumn("__hash", key_hash(keys, seed))
    sizes = materialize(df.groupBy(*strata).agg(F.count(F.lit(1)).alias("__n")), "strata").withColumn("__want", F.least("__n", F.lit(k)))
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in strata]
    names = [F.col(c).alias(f"__{c}") for c in strata]
    found = None
    todo, wide = sizes, (k + spare * k ** 0.5 + 10)
    while True:
        limits = todo.select(*names, "__want", F.least(F.lit(1.0), F.lit(wide) / F.col("__n")).alias("__share"))
        near = rows.join(limits, same).where(F.col("__hash") <= F.col("__share") * F.lit(float(1 << BITS))).drop("__share", *(f"__{c}" for c in strata))
        near = materialize(near, "candidates")
        enough = near.groupBy(*strata).agg(F.count(F.lit(1)).alias("__got"), F.first("__want").alias("__w")).where(F.col("__got") >= F.col("__w"))
        done = enough.select(*names)
        part = near.join(done, same, "left_semi")
        found = part if found is None else found.unionByName(part)
        todo = materialize(todo.join(done, same, "left_anti"), "strata-left")
        if not todo.limit(1).count():
            break
        wide *= 4
    rank = Window.partitionBy(*strata).orderBy("__hash", *keys)
    return found.withColumn("__rank", F.row_number().over(rank)).where(F.col("__rank") <= k).select(*(f"`{c}`" for c in df.columns))
