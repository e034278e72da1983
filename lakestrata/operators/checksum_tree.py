"""Checksum trees: two versions of a table are compared from the root down, and only what differs is read.

A key's hash places it in a range: its first bits name a node on each level of the tree, and a node holds the number of
rows and the sum of their 64-bit hashes. A version is written once as

``{path}/rows/range=N``   its rows, one directory per node of the first level, sorted by leaf inside
``{path}/levels``         (level, node, rows, digest), a few numbers a node
``{path}/schema``         the rows' types, so that a version without rows can be read

:func:`differing` walks two trees level by level and keeps the children of unequal nodes alone. Then it opens the
directories that hold an unequal leaf, and of their files the row groups of such leaves: equal ranges are not read. The
rows found give the exact change set.

Order of rows, number of files and copies of a run do not matter. A leaf with equal count and digest on both sides is
taken as equal; two different bags of rows agree there with a chance of 2^-64.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.functions.hashing import fold_int64, row_hash
from lakestrata.operators.changes import change_set

#: bits of a key's hash that name a node, level by level; the first level's nodes are directories
LEVEL_BITS = (6, 10, 14)
#: unequal leaves up to which a comparison names them in the scan's filter; more are joined
NAMED_LEAVES = 1000


def _node(keys: Sequence[str], bits: int) -> Column:
    return F.shiftrightunsigned(row_hash(list(keys)), 64 - bits)


def write_tree(df: DataFrame, path: str, keys: Sequence[str], content: Sequence[str] | None = None, level_bits: Sequence[int] = LEVEL_BITS) -> str:
    """Write a version of the table and its tree below ``path``. Rows go to their directory by one exchange that AQE
    splits and merges by size; a hot key is one leaf, which may span files."""
    spark, bits = df.sparkSession, list(level_bits)
    content = list(content) if content is not None else [c for c in df.columns if c not in keys]
    rows = df.withColumns({"range": _node(keys, bits[0]), "__leaf": _node(keys, bits[-1])})
    (rows.hint("rebalance", "range").sortWithinPartitions("range", "__leaf")
         .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("range").parquet(f"{path}/rows"))
    spark.createDataFrame([(json.dumps(rows.schema.jsonValue()),)], "schema string").coalesce(1).write.mode("overwrite").parquet(f"{path}/schema")
    written = read_rows(spark, path)
    digest = F.sum(row_hash([*keys, *content]).cast("decimal(38,0)"))
    level = written.groupBy(F.col("__leaf").alias("node")).agg(F.count(F.lit(1)).alias("rows"), digest.alias("digest"))
    level = level.withColumn("digest", fold_int64(F.col("digest")))
    out = f"{path}/levels"
    for i in reversed(range(len(bits))):
        level.write.mode("overwrite").parquet(f"{out}/level={i}")
        if i:
            below = spark.read.parquet(f"{out}/level={i}")
            level = below.groupBy(F.shiftrightunsigned("node", bits[i] - bits[i - 1]).alias("node")).agg(
                F.sum("rows").alias("rows"), fold_int64(F.sum(F.col("digest").cast("decimal(38,0)"))).alias("digest"))
    return path


def read_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a written version, with their ``range`` (the directory) and ``__leaf``."""
    types = T.StructType.fromJson(json.loads(spark.read.schema("schema string").parquet(f"{path}/schema").first()[0]))
    return spark.read.schema(types).parquet(f"{path}/rows")


def unequal_leaves(spark: SparkSession, old: str, new: str, level_bits: Sequence[int] = LEVEL_BITS) -> DataFrame:
    """(node): leaves whose count or digest differ, found through the levels above them."""
    bits, frontier = list(level_bits), None
    for i in range(len(bits)):
        sides = []
        for path, sign in ((old, -1), (new, 1)):
            level = spark.read.parquet(f"{path}/levels/level={i}")
            if frontier is not None:
                parents = frontier.select(F.col("node").alias("parent"))
                level = level.join(parents, F.shiftrightunsigned(level["node"], bits[i] - bits[i - 1]) == F.col("parent"), "left_semi")
            sides.append(level.select("node", (F.col("rows") * sign).alias("rows"), (F.col("digest").cast("decimal(38,0)") * sign).alias("digest")))
        both = sides[0].unionByName(sides[1]).groupBy("node").agg(F.sum("rows").alias("rows"), F.sum("digest").alias("digest"))
        frontier = both.where((F.col("rows") != 0) | (F.col("digest") != 0)).select("node")
    return frontier


def differing(spark: SparkSession, old: str, new: str, keys: Sequence[str], content: Sequence[str] | None = None,
              level_bits: Sequence[int] = LEVEL_BITS) -> DataFrame:
    """The change set of two written versions; equal ranges are not read."""
    bits = list(level_bits)
    leaves = unequal_leaves(spark, old, new, bits)
    # a few bits a node: at most 2^bits[0] directories come to the driver, and at most NAMED_LEAVES + 1 leaves
    some = [r[0] for r in leaves.limit(NAMED_LEAVES + 1).collect()]
    ranges = sorted({x >> (bits[-1] - bits[0]) for x in some})
    if len(some) > NAMED_LEAVES:
        ranges = sorted(r[0] for r in leaves.select(F.shiftrightunsigned("node", bits[-1] - bits[0])).distinct().collect())

    def part(path: str) -> DataFrame:
        whole = read_rows(spark, path)
        if len(some) <= NAMED_LEAVES:
            rows = whole.where(F.col("range").isin(ranges) & F.col("__leaf").isin(some))
        else:
            rows = whole.where(F.col("range").isin(ranges)).join(leaves.withColumnRenamed("node", "__leaf"), "__leaf", "left_semi")
        return rows.drop("range", "__leaf")

    return change_set(part(old), part(new), keys, content)
