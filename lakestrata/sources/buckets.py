"""Tables bucketed by a key: joins and groupings on it need no shuffle (SNK-1, JN-1).

Both sides of a join are written in the same number of buckets, sorted by key. Bucketing pays for tables that are joined
again and again; a key with a third of the rows makes a large bucket, so it is for keys that are nearly unique, as an
order's number is.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

#: rows of a bucket
BUCKET_ROWS = 2_000_000


def bucket_count(rows: int) -> int:
    """A power of two, so that tables of unlike size fit: Spark joins n with 2n buckets without a shuffle of the larger."""
    return 1 << max(2, math.ceil(math.log2(max(1, rows) / BUCKET_ROWS)) if rows > BUCKET_ROWS else 2)


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int, name: str | None = None) -> str:
    """Write ``df`` below ``path`` in ``buckets`` buckets of ``keys``; returns the name of the table in the catalog. One
    exchange on the keys before the write gives one file per bucket."""
    name = name or f"bucketed_{uuid.uuid4().hex}"
    (df.repartition(buckets, *keys).write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
       .option("path", path).format("parquet").saveAsTable(name))
    return name


def read_bucketed(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
