"""Multi-line CSV read in blocks, against Spark's one-task reader and Python's csv module."""

import csv
import os
import random

import pytest

from lakestrata.sources.multiline import csv_lines, csv_records, read_multiline_csv

PIECES = ['plain', 'two words', '"quoted"', 'line\nbreak', 'a "b" c\n\n"d"', ',comma,', '\n', 'é ü 日本\nx', '""', 'cr\r\nlf', ' lead', "'", '"\n"']


@pytest.fixture()
def small_blocks(spark):
    """Blocks of a few bytes: every record is cut somewhere."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def set_bytes(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield set_bytes
    for k, v in old.items():
        spark.conf.set(k, v)


def write(path, rows, terminator="\n", header=("id", "text", "more")):
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, lineterminator=terminator, quoting=csv.QUOTE_MINIMAL)
        w.writerow(header)
        w.writerows(rows)


def table(n, seed):
    rnd = random.Random(seed)
    return [(f"{i}", "".join(rnd.choice(PIECES) for _ in range(rnd.randint(1, 4))), rnd.choice(PIECES)) for i in range(n)]


def collect(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("block", [17, 64, 1000, 1 << 20])
@pytest.mark.parametrize("terminator", ["\n", "\r\n"], ids=["lf", "crlf"])
def test_equal_at_every_block_size(spark, scratch, small_blocks, block, terminator):
    rows = table(60, block)
    write(f"{scratch}/one.csv", rows, terminator)
    small_blocks(block)
    got = read_multiline_csv(spark, f"{scratch}/one.csv")
    assert got.columns == ["id", "text", "more"]
    assert collect(got) == sorted(rows)


def test_one_file_is_read_by_many_tasks(spark, scratch, small_blocks):
    write(f"{scratch}/one.csv", table(200, 3))
    small_blocks(200)
    blocks = csv_lines(spark, f"{scratch}/one.csv").select("block").distinct().count()
    assert blocks > 10
    assert csv_records(csv_lines(spark, f"{scratch}/one.csv")).count() == 201


def test_record_over_many_blocks_and_no_final_line_end(spark, scratch, small_blocks):
    rows = [("1", "x", "y"), ("2", "line\n" * 500, "end"), ("3", "", "z")]
    write(f"{scratch}/one.csv", rows)
    with open(f"{scratch}/one.csv", "rb+") as f:
        f.seek(-1, os.SEEK_END)
        f.truncate()
    small_blocks(100)
    assert collect(read_multiline_csv(spark, f"{scratch}/one.csv")) == [(a, b or None, c) for a, b, c in rows]


def test_several_files_each_with_a_header(spark, scratch, small_blocks):
    os.mkdir(f"{scratch}/d")
    tables = [table(30, i) for i in range(3)]
    for i, rows in enumerate(tables):
        write(f"{scratch}/d/{i}.csv", rows)
    write(f"{scratch}/d/empty.csv", [])
    small_blocks(90)
    assert collect(read_multiline_csv(spark, f"{scratch}/d")) == sorted(r for rows in tables for r in rows)


def test_as_the_one_task_reader(spark, scratch, small_blocks):
    rows = [("1", 'a\n"b"', ""), ("2", "", "only"), ("3", "x,y\r\nz", " t ")]
    write(f"{scratch}/one.csv", rows)
    options = {"multiLine": "true", "quote": '"', "escape": '"'}
    whole = spark.read.options(header=True, **options).csv(f"{scratch}/one.csv")
    small_blocks(20)
    got = read_multiline_csv(spark, f"{scratch}/one.csv", options)
    assert collect(got.fillna("~")) == collect(whole.fillna("~")) and got.schema == whole.schema


def test_short_and_long_records(spark, scratch):
    with open(f"{scratch}/one.csv", "w") as f:
        f.write("a,b\n1\n2,3,4\n\n5,6\n")
    assert collect(read_multiline_csv(spark, f"{scratch}/one.csv").fillna("~")) == [("1", "~"), ("2", "3"), ("5", "6")]
