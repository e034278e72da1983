"""Change sets, checksum trees and months brought up to date, against plain Python."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from lakestrata.operators import changes, checksum_tree
from lakestrata.sources import monthly
from lakestrata.specs import Check

SCHEMA = "a string, b int, v double, note string"


def versions(seed=2, n=400):
    rnd = random.Random(seed)
    old = [(rnd.choice(["x", "y", None]), i, rnd.choice([1.0, 2.5, None]), rnd.choice(["", None, "n"])) for i in range(n)]
    new = [r if rnd.random() < 0.8 else (r[0], r[1], (r[2] or 0.0) + 1, r[3]) for r in old if rnd.random() < 0.9]
    new += [("z", n + i, None, None) for i in range(20)]
    rnd.shuffle(new)
    return old, new


def brute(old, new):
    def bag(rows):
        out = {}
        for r in rows:
            out.setdefault(r[:2], []).append(r[2:])
        return {k: sorted(v, key=str) for k, v in out.items()}

    a, b = bag(old), bag(new)
    out = []
    for k in set(a) | set(b):
        x, y = a.get(k, []), b.get(k, [])
        if x != y:
            out.append((*k, "insert" if not x else "delete" if not y else "update", len(x), len(y)))
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_change_set(spark, ansi):
    old, new = versions()
    old += [("copies", 1, 1.0, "p")] * 3 + [(None, None, 1.0, "null key")]
    new += [("copies", 1, 1.0, "p")] * 2 + [(None, None, 2.0, "null key")]
    a, b = (spark.createDataFrame(x, SCHEMA).repartition(3) for x in (old, new))
    assert rows(changes.change_set(a, b, ["a", "b"])) == brute(old, new)
    assert changes.change_set(a, a.orderBy("v"), ["a", "b"]).count() == 0
    assert rows(changes.change_set(a.limit(0), b, ["a", "b"])) == brute([], new)
    assert rows(changes.change_set(a, b, ["a", "b"], ["note"])) == brute([(*r[:2], None, r[3]) for r in old], [(*r[:2], None, r[3]) for r in new])


def test_change_set_shuffles_once_with_a_partial_step(spark):
    a = spark.range(1000).selectExpr("id % 10 AS k", "id AS v")
    plan = changes.change_set(a, a, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_sum" in plan and "Join" not in plan


def test_contents(spark):
    old, new = versions(5, 50)
    a, b = spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA)
    both = changes.with_contents(changes.change_set(a, b, ["a", "b"]), a, b, ["a", "b"], ["v"])
    was, now = {r[:2]: r[2] for r in old}, {r[:2]: r[2] for r in new}
    for r in both.collect():
        k = (r["a"], r["b"])
        assert (r["before"] and r["before"]["v"]) == was.get(k) and (r["after"] and r["after"]["v"]) == now.get(k)
        assert (r["before"] is None) == (r["change"] == "insert") and (r["after"] is None) == (r["change"] == "delete")


def test_tree_finds_all_changes(spark, scratch):
    old, new = versions(3, 2000)
    a, b = spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA).repartition(5)
    at = [checksum_tree.write_tree(df, f"{scratch}/{i}", ["a", "b"]) for i, df in enumerate((a, b, a.limit(0), a.orderBy("v")))]
    assert rows(checksum_tree.differing(spark, at[0], at[1], ["a", "b"])) == brute(old, new)
    assert rows(checksum_tree.differing(spark, at[2], at[1], ["a", "b"])) == brute([], new)
    assert rows(checksum_tree.differing(spark, at[0], at[2], ["a", "b"])) == brute(old, [])
    assert checksum_tree.differing(spark, at[0], at[3], ["a", "b"]).count() == 0


def test_tree_with_more_leaves_than_are_named(spark, scratch, monkeypatch):
    monkeypatch.setattr(checksum_tree, "NAMED_LEAVES", 3)
    old, new = versions(4, 300)
    at = [checksum_tree.write_tree(spark.createDataFrame(x, SCHEMA), f"{scratch}/{i}", ["a", "b"]) for i, x in enumerate((old, new))]
    assert rows(checksum_tree.differing(spark, *at, ["a", "b"])) == brute(old, new)


def _files_read(df):
    """Directories that the plan's scans open."""
    df.collect()
    return sorted({os.path.dirname(f).rsplit("/", 1)[-1] for f in df.inputFiles()})


def test_tree_leaves_equal_ranges_unread(spark, scratch):
    old = [("k", i, float(i), None) for i in range(5000)]
    new = [r if r[1] != 77 else ("k", 77, -1.0, "changed") for r in old]
    at = [checksum_tree.write_tree(spark.createDataFrame(x, SCHEMA), f"{scratch}/{i}", ["a", "b"]) for i, x in enumerate((old, new))]
    found = checksum_tree.differing(spark, *at, ["a", "b"])
    assert rows(found) == [("k", 77, "update", 1, 1)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "range" in plan
    leaves = checksum_tree.unequal_leaves(spark, *at)
    assert leaves.count() == 1
    assert len(os.listdir(f"{scratch}/0/rows")) > 50  # 64 ranges, of which one is opened in each version
    assert _files_read(found) == _files_read(checksum_tree.read_rows(spark, at[0]).where(
        F.col("range") == leaves.first()[0] >> (checksum_tree.LEVEL_BITS[-1] - checksum_tree.LEVEL_BITS[0])))


# ------------------------------------------------------------------ months

FACT = "id string, d date, v int"


def _fact(spark, rows_):
    return spark.createDataFrame([(i, d and dt.date.fromisoformat(d), v) for i, d, v in rows_], FACT)


def _state(spark, root):
    return {r["month"]: (r["run"], r["rows"]) for r in monthly.read_months(spark, root, "gold", "t").collect()}


def _publish(spark, root, rows_, run, **kw):
    return monthly.publish_changes(spark, _fact(spark, rows_), root, "gold", "t", run, ["id"], "d", **kw)


def _files(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(root) for f in names}


V1 = [("a", "2020-01-05", 1), ("b", "2020-01-09", 2), ("c", "2020-02-01", 3), ("d", "2020-03-31", 4), ("e", None, 5)]


def test_only_touched_months_are_written(spark, scratch):
    root = f"{scratch}/lake"
    first = _publish(spark, root, V1, "r1")
    assert first.changes == {"insert": 5} and first.written == ["2020-01-01", "2020-02-01", "2020-03-01", "none"] and first.published
    before = _files(f"{root}/gold/t/data")
    v2 = [("a", "2020-01-05", 1), ("b", "2020-02-09", 2), ("c", "2020-02-01", 3), ("e", None, 5), ("f", "2020-06-01", 9)]
    second = _publish(spark, root, v2, "r2")
    # b moves from January to February, d goes with its month, f comes with a new one
    assert second.changes == {"update": 1, "delete": 1, "insert": 1}
    assert second.written == ["2020-01-01", "2020-02-01", "2020-06-01"] and second.dropped == ["2020-03-01"]
    assert _state(spark, root) == {"2020-01-01": ("r2", 1), "2020-02-01": ("r2", 2), "2020-06-01": ("r2", 1), "none": ("r1", 1)}
    after = _files(f"{root}/gold/t/data")
    assert {f: t for f, t in after.items() if f in before and "_SUCCESS" not in f} == {f: t for f, t in before.items() if "_SUCCESS" not in f}
    assert rows(monthly.read_monthly(spark, root, "gold", "t")) == rows(_fact(spark, v2))
    assert rows(monthly.read_monthly(spark, root, "gold", "t", run_id="r1")) == rows(_fact(spark, V1))


def test_nothing_is_written_again(spark, scratch):
    root = f"{scratch}/lake"
    _publish(spark, root, V1, "r1")
    before = _files(root)
    again = _publish(spark, root, V1[::-1], "r2")
    assert not again.published and not again.written and not again.changes and _files(root) == before


def test_ranges_open_their_months_only(spark, scratch):
    root = f"{scratch}/lake"
    _publish(spark, root, V1, "r1")
    part = monthly.read_monthly(spark, root, "gold", "t", "2020-01-20", "2020-02-02")
    assert {f.split("layout_month=")[1][:10] for f in part.inputFiles()} == {"2020-01-01", "2020-02-01"}
    assert monthly.read_monthly(spark, root, "gold", "t", "1999-01-01", "1999-02-02").count() == 0


def test_a_failing_check_keeps_the_version_and_a_retry_converges(spark, scratch):
    root, check = f"{scratch}/lake", [Check("range", ("v",), lo=0)]
    _publish(spark, root, V1, "r1", checks=check)
    bad = [("a", "2020-01-05", -1), *V1[1:]]
    failed = _publish(spark, root, bad, "r2", checks=check)
    assert not failed.published and [f.check for f in failed.failures] == ["range:v[0,None]"]
    assert rows(monthly.read_monthly(spark, root, "gold", "t")) == rows(_fact(spark, V1))
    good = [("a", "2020-01-05", 7), *V1[1:]]
    assert _publish(spark, root, good, "r2", checks=check).published
    assert rows(monthly.read_monthly(spark, root, "gold", "t")) == rows(_fact(spark, good))


def test_everything_can_go(spark, scratch):
    root = f"{scratch}/lake"
    _publish(spark, root, V1, "r1")
    gone = _publish(spark, root, [], "r2")
    assert gone.changes == {"delete": 5} and gone.published and len(gone.dropped) == 4
    assert monthly.read_monthly(spark, root, "gold", "t").count() == 0
    assert _publish(spark, root, V1, "r3").changes == {"insert": 5}


@pytest.mark.parametrize("start,end,months", [("2020-02-15", None, {"2020-02-01", "2020-03-01"}), (None, "2020-01-31", {"2020-01-01"})])
def test_open_ranges(spark, scratch, start, end, months):
    root = f"{scratch}/lake"
    _publish(spark, root, V1, "r1")
    assert {f.split("layout_month=")[1][:10] for f in monthly.read_monthly(spark, root, "gold", "t", start, end).inputFiles()} == months
