"""Streams over landed drops, bucketed tables and stratified samples."""

import datetime as dt
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from lakestrata.operators import sampling
from lakestrata.plans import analytics as qa
from lakestrata.sources import buckets, landing
from lakestrata.streaming import landing_stream as ls

SCHEMA, SUMS = "k string, at timestamp, v long", "window_start timestamp, k string, n long, total long"


def land(spark, root, day, rows):
    df = spark.createDataFrame([(k, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m), v) for k, m, v in rows], "k string, at timestamp_ntz, v long")
    landing.write_landing(df, root, "t", day)


def run(spark, root, watermark="10 days"):
    sums = ls.window_sums(ls.landing_stream(spark, f"{root}/landing", "t", SCHEMA), "at", "1 hour", ["k"], {"n": F.count(F.lit(1)), "total": F.sum("v")}, watermark)
    return ls.run_available(sums, f"{root}/out", f"{root}/checkpoint")


def state(spark, root):
    return {(r["window_start"].hour, r["k"]): (r["n"], r["total"]) for r in ls.read_published(spark, f"{root}/out", SUMS, ["window_start", "k"]).collect()}


def test_restart_late_rows_and_nothing_new(spark, scratch):
    land(spark, f"{scratch}/landing", "2024-01-01", [("a", 5, 1), ("a", 65, 2), ("b", 10, 3)])
    assert run(spark, scratch) == 3
    assert state(spark, scratch) == {(0, "a"): (1, 1), (1, "a"): (1, 2), (0, "b"): (1, 3)}
    land(spark, f"{scratch}/landing", "2024-01-02", [("a", 50, 10), ("c", 300, 4)])
    assert run(spark, scratch) == 2
    want = {(0, "a"): (2, 11), (1, "a"): (1, 2), (0, "b"): (1, 3), (5, "c"): (1, 4)}
    assert state(spark, scratch) == want
    batches = sorted(os.listdir(f"{scratch}/out"))
    assert run(spark, scratch) == 0 and sorted(os.listdir(f"{scratch}/out")) == batches and state(spark, scratch) == want


def test_rows_behind_the_watermark_are_dropped(spark, scratch):
    land(spark, f"{scratch}/landing", "2024-01-01", [("a", 5, 1), ("a", 600, 2)])
    run(spark, scratch, "1 hour")
    land(spark, f"{scratch}/landing", "2024-01-02", [("a", 6, 100), ("a", 601, 5)])
    run(spark, scratch, "1 hour")
    assert state(spark, scratch) == {(0, "a"): (1, 1), (10, "a"): (2, 7)}


def test_a_batch_that_is_published_again_replaces_itself(spark, scratch):
    land(spark, f"{scratch}/landing", "2024-01-01", [("a", 5, 1)])
    run(spark, scratch)
    # a try that died after publishing: its commit is missing, the batch runs again
    for d, _, names in os.walk(f"{scratch}/checkpoint/commits"):
        for n in names:
            os.rename(os.path.join(d, n), os.path.join(scratch, n))
    run(spark, scratch)
    assert state(spark, scratch) == {(0, "a"): (1, 1)}


def test_no_output_yet(spark, scratch):
    assert ls.read_published(spark, f"{scratch}/none", SUMS, ["window_start", "k"]).count() == 0


# ------------------------------------------------------------------ buckets

def test_bucketed_join_has_no_exchange(spark, scratch):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        items = spark.range(5000).selectExpr("cast(id % 1200 as string) AS order_id", "cast(id % 7 as double) AS price")
        orders = spark.range(1000).selectExpr("cast(id as string) AS order_id", "if(id % 3 = 0, 'x', 'y') AS order_status")
        a, b = (buckets.read_bucketed(spark, buckets.write_bucketed(df, f"{scratch}/{n}", ["order_id"], 8)) for df, n in ((items, "items"), (orders, "orders")))
        got = qa.items_by_status(a, b)
        rows = sorted(map(tuple, got.collect()))
        plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        # the one exchange left adds up a few rows per status
        assert plan.count("Exchange hashpartitioning") == 1 and "hashpartitioning(order_status" in plan and "SortMergeJoin" in plan
        assert rows == sorted(map(tuple, qa.items_by_status(items, orders).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("rows,want", [(0, 4), (10, 4), (buckets.BUCKET_ROWS * 3, 4), (buckets.BUCKET_ROWS * 100, 128)])
def test_bucket_count(rows, want):
    assert buckets.bucket_count(rows) == want


# ------------------------------------------------------------------ samples

def brute(rows, k):
    out = []
    for s in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == s), key=lambda r: (int(hashlib.md5(f"sample|{r[1]}".encode()).hexdigest()[:15], 16), r[1]))
        out += own[:k]
    return sorted(out, key=str)


@pytest.mark.parametrize("k", [1, 5, 60])
@pytest.mark.parametrize("spare", [6.0, -2.0], ids=["spare", "too narrow first"])
def test_k_smallest_per_stratum(spark, k, spare):
    rows = [(s, i) for i in range(900) for s in [["hot", "hot", "b", None][i % 4]]] + [("tiny", 5000), ("tiny", 5001)]
    df = spark.createDataFrame(rows, "s string, id long").repartition(5)
    got = sampling.stratified_sample(df, ["s"], ["id"], k, spare=spare)
    assert got.columns == ["s", "id"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, k)
    assert sampling.stratified_sample(df.limit(0), ["s"], ["id"], k).count() == 0


def test_a_hot_stratum_is_thinned_before_it_is_ranked(spark, monkeypatch):
    sizes = {}
    keep = sampling.materialize
    monkeypatch.setattr(sampling, "materialize", lambda df, tag: sizes.setdefault(tag, keep(df, tag)))
    df = spark.range(20_000).selectExpr("'hot' AS s", "id")
    assert sampling.stratified_sample(df, ["s"], ["id"], 10).count() == 10
    assert 10 <= sizes["candidates"].count() <= 100
