import os

import pytest

from lakestrata.sources import landing
from lakestrata.specs import TableSpec, table_spec

MULTILINE = 'review_id,review_score,review_comment_message\n' \
            'r1,5,"linha 1\nlinha ""2"", fim"\n' \
            'r2,4,simples\n' \
            'r3,1,"a\nb\nc"\n' \
            'r4,3,""\n'


def _drop(root, table, date, text, name="part-0.csv"):
    d = os.path.join(root, table, f"ingestion_date={date}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w", encoding="utf-8") as f:
        f.write(text)


def test_naive_vs_multiline_row_count(spark, scratch):
    _drop(scratch, "reviews", "2024-01-01", MULTILINE)
    base = os.path.join(scratch, "reviews", "ingestion_date=2024-01-01")
    naive = landing.csv_reader(spark).csv(base).count()
    proper = landing.csv_reader(spark, table_spec("reviews")).csv(base).count()
    assert proper == 4 and naive > proper
    rows = {r.review_id: r.review_comment_message
            for r in landing.read_landing(spark, scratch, table_spec("reviews"), "2024-01-01").collect()}
    assert rows["r1"] == 'linha 1\nlinha "2", fim'


def test_only_newest_partition_is_read(spark, scratch):
    spec = TableSpec("customers")
    _drop(scratch, "customers", "2024-01-01", "customer_id,customer_city\nold1,a\nold2,b\n")
    _drop(scratch, "customers", "2024-02-01", "customer_id,customer_city\nnew1,c\n")
    df, d = landing.read_landing_latest(spark, scratch, spec)
    assert d == "2024-02-01"
    assert [r.customer_id for r in df.collect()] == ["new1"]
    assert df.columns == ["customer_id", "customer_city"]
    assert all(t == "string" for _, t in df.dtypes)
    assert {f.rsplit("/", 2)[1] for f in df.inputFiles()} == {"ingestion_date=2024-02-01"}


def test_newest_drop_counts_whatever_its_files_are_called(spark, scratch):
    _drop(scratch, "sellers", "2024-01-01", "seller_id\nold\n")
    _drop(scratch, "sellers", "2024-02-01", "seller_id\nnew\n", name="a.txt")
    df, d = landing.read_landing_latest(spark, scratch, TableSpec("sellers"))
    assert d == "2024-02-01" and [r[0] for r in df.collect()] == ["new"]


def test_half_landed_drop_is_an_error(spark, scratch):
    """One date for all tables; a table without it stops the run, and no older drop is taken."""
    for t in ("sellers", "customers"):
        _drop(scratch, t, "2024-01-01", "a\n1\n")
    assert landing.latest_ingestion(spark, scratch, ["sellers", "customers"]) == "2024-01-01"
    _drop(scratch, "sellers", "2024-02-01", "a\n2\n")
    with pytest.raises(landing.NoLandingPartitionError, match="2024-02-01.*customers"):
        landing.latest_ingestion(spark, scratch, ["sellers", "customers"])


def test_missing_landing_raises(spark, scratch):
    with pytest.raises(landing.NoLandingPartitionError):
        landing.latest_ingestion(spark, scratch, ["nothing"])
    os.makedirs(os.path.join(scratch, "flat"))
    with open(os.path.join(scratch, "flat", "a.csv"), "w") as f:
        f.write("a\n1\n")
    with pytest.raises(landing.NoLandingPartitionError):
        landing.latest_ingestion(spark, scratch, ["flat"])


def test_write_landing_rerun_is_idempotent(spark, scratch):
    df = spark.createDataFrame([("1", "x"), ("2", "y")], "a string, b string")
    landing.write_landing(df, scratch, "t", "2024-01-01")
    landing.write_landing(df, scratch, "t", "2024-01-01")
    landing.write_landing(df.limit(1), scratch, "t", "2024-01-02")
    spec = TableSpec("t")
    assert landing.read_landing(spark, scratch, spec, "2024-01-01").count() == 2
    df2, d = landing.read_landing_latest(spark, scratch, spec)
    assert d == "2024-01-02" and df2.count() == 1


def test_write_landing_roundtrips_multiline_text(spark, scratch):
    df = spark.createDataFrame([("r1", 'a\n"b", c')], "review_id string, review_comment_message string")
    landing.write_landing(df, scratch, "reviews", "2024-03-01")
    back, _ = landing.read_landing_latest(spark, scratch, table_spec("reviews"))
    assert back.collect()[0].review_comment_message == 'a\n"b", c'


def test_newest_header_defines_the_columns(spark, scratch):
    spec = TableSpec("sellers")
    _drop(scratch, "sellers", "2024-01-01", "seller_id,old_col\ns1,x\n")
    _drop(scratch, "sellers", "2024-02-01", "seller_id,seller_city,seller_state\ns2,rio,RJ\n")
    df, _ = landing.read_landing_latest(spark, scratch, spec)
    assert df.columns == ["seller_id", "seller_city", "seller_state"]
    assert [tuple(r) for r in df.collect()] == [("s2", "rio", "RJ")]


def test_drops_are_compressed_files_of_bounded_rows(spark, scratch, monkeypatch):
    """A compressed file is one task's, so none holds more than FILE_ROWS rows; multi-line texts come back whole."""
    monkeypatch.setattr(landing, "FILE_ROWS", 10)
    df = spark.range(25).selectExpr("CAST(id AS STRING) AS review_id", "CONCAT('a\n\"', id, '\", b') AS review_comment_message").coalesce(1)
    landing.write_landing(df, scratch, "reviews", "2024-03-01")
    folder = os.path.join(scratch, "reviews", "ingestion_date=2024-03-01")
    files = [f for f in os.listdir(folder) if f.startswith("part-")]
    assert len(files) == 3 and all(f.endswith(".csv.gz") for f in files)
    back = landing.read_landing(spark, scratch, table_spec("reviews"), "2024-03-01")
    assert sorted(back.collect()) == sorted(df.collect())
