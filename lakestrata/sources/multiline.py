"""CSV with line breaks inside quoted fields, read by as many tasks as the files have blocks (SRC-2).

Spark's own multi-line reader takes a whole file in one task. Here the files are read as lines, in splits, and records are
rebuilt from them:

1. a block's parity is the parity of its quotes; a prefix sum over the blocks of a file, a few numbers each, says which
   blocks begin inside a quoted field;
2. inside a block, the running parity of quotes marks the lines that begin a record, and the lines from one mark to the
   next are a piece. Blocks are dealt out by one exchange, which also spreads the rows for what follows;
3. a piece with an odd number of quotes is unfinished: it goes on in the first piece of the next block that has one. Only
   these pieces, two per block at most, meet once more, per file;
4. each record is parsed as one CSV line, line breaks included.

Files are RFC 4180: a quote inside a field is doubled and such fields are quoted. Lines end with LF or CRLF; inside a
field they stay as they are. Every file begins with a header, and the first file's names hold for all. Empty lines between
records are skipped. A compressed file is one block.
"""

from __future__ import annotations

import csv
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def csv_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, at, line, quotes): the lines of the files, ``at`` ascending inside a block."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                        F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"),
                        (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).alias("quotes"))


def _joined(pieces: str, *order: str):
    """The collected pieces in order, with the line breaks between them."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, pieces))), lambda x: x[pieces]), "\n")


def csv_records(lines: DataFrame) -> DataFrame:
    """(file, block, record, text): the records of :func:`csv_lines`, numbered from 1 in the block where they begin."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = lines.groupBy("file", "block").agg((F.sum("quotes") % 2).alias("odd"))
    blocks = blocks.select("file", "block", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).alias("inside"))
    in_block = Window.partitionBy("file", "block").orderBy("at")
    upto = in_block.rowsBetween(Window.unboundedPreceding, -1)
    rows = lines.join(blocks, ["file", "block"])
    rows = rows.withColumn("begins", ((F.col("inside") + F.coalesce(F.sum("quotes").over(upto), F.lit(0))) % 2 == 0).cast("int"))
    rows = rows.withColumn("record", F.sum("begins").over(in_block.rowsBetween(Window.unboundedPreceding, 0)))
    # record 0 of a block goes on from an earlier one
    pieces = rows.groupBy("file", "block", "record").agg(_joined("line", "at").alias("text"), F.sum("quotes").alias("quotes"))
    cut = (F.col("record") == 0) | (F.col("quotes") % 2 == 1)
    whole = pieces.where(~cut).select("file", "block", "record", "text")
    across = Window.partitionBy("file").orderBy("block", "record").rowsBetween(Window.unboundedPreceding, 0)
    parts = pieces.where(cut).withColumn("group", F.sum((F.col("record") > 0).cast("int")).over(across))
    begins = F.min(F.struct("block", "record"))
    rejoined = parts.groupBy("file", "group").agg(begins.alias("first"), _joined("text", "block", "record").alias("text"))
    records = whole.unionByName(rejoined.select("file", F.col("first.block").alias("block"), F.col("first.record").alias("record"), "text"))
    return records.withColumn("text", F.regexp_replace("text", "\r$", "")).where(F.col("text") != "")


def read_multiline_csv(spark: SparkSession, path: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """All-string columns of the CSV files at ``path``, named by the header. ``options`` are those of ``spark.read.csv``
    that concern a record (``sep``, ``nullValue``, ...)."""
    records = csv_records(csv_lines(spark, path))
    first = spark.read.option("lineSep", "\n").text(path).where((F.col("_metadata.file_block_start") == 0) & (F.col("value") != "")).select("value").first()
    if first is None:
        return spark.createDataFrame([], T.StructType([]))
    sep = dict(options or {}).get("sep", ",")
    names = next(csv.reader([first[0].rstrip("\r")], delimiter=sep))  # a header holds no line breaks
    header = (F.col("block") == 0) & (F.col("record") == 1)
    keep = {"quote": '"', "escape": '"', "multiLine": "true", **{k: v for k, v in dict(options or {}).items() if k not in ("header", "inferSchema")}}
    parsed = records.where(~header).select(F.from_csv("text", ", ".join(f"`{n}` string" for n in names), keep).alias("r"))
    return parsed.select("r.*")
