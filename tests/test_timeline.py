"""As-of join, interval join and sessions against plain Python, with and without cuts of a hot key."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lakestrata.operators import timeline

T0 = dt.datetime(2024, 1, 1)


def at(minutes):
    return None if minutes is None else T0 + dt.timedelta(minutes=minutes)


def points(n, seed, span=3000):
    rnd = random.Random(seed)
    # key 0 has most rows, times repeat, some are null
    return [(i, rnd.choice([0, 0, 0, 1, 2, 3, None]), at(rnd.choice([None, *range(0, span, 7)])), rnd.randint(0, 99)) for i in range(n)]


def frame(spark, rows, names="id long, k long, t timestamp_ntz, v long"):
    return spark.createDataFrame(rows, names).repartition(4)


def collect(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


@pytest.mark.parametrize("max_rows", [timeline.MAX_ROWS, 40, 3], ids=["whole", "cut", "fine"])
def test_as_of(spark, max_rows):
    left, right = points(300, 1), points(200, 2)
    expected = []
    for i, k, t, _ in left:
        before = [r for r in right if k is not None and r[1] == k and t is not None and r[2] is not None and r[2] <= t]
        best = max(before, key=lambda r: (r[2], r[0])) if before else None
        expected.append((i, best and best[0], best and best[3]))
    r = frame(spark, right).withColumnsRenamed({"id": "rid", "t": "rt", "v": "rv"})
    got = timeline.as_of_join(frame(spark, left), r, "k", "t", "rt", ["rid", "rv"], "rid", max_rows=max_rows)
    assert got.columns == ["id", "k", "t", "v", "rid", "rv"]
    assert collect(got, "id", "rid", "rv") == sorted(expected, key=str)


def test_as_of_with_an_empty_side(spark):
    left = frame(spark, points(20, 3))
    r = left.limit(0).withColumnsRenamed({"id": "rid", "t": "rt"}).drop("v")
    assert {x["rid"] for x in timeline.as_of_join(left, r, "k", "t", "rt", ["rid"], "rid").collect()} == {None}
    assert timeline.as_of_join(left.limit(0), r, "k", "t", "rt", ["rid"], "rid").count() == 0


def test_hot_key_is_cut(spark):
    rows, hot = timeline.time_ranges(frame(spark, [(i, 0, at(i), 0) for i in range(1000)] + [(5000, 1, at(1), 0)]), "k", "t", 100)
    sizes = {r["__range"]: r["count"] for r in rows.groupBy("__range").count().collect()}
    assert hot and sizes.pop(-1) == 1 and len(sizes) == 10 and max(sizes.values()) <= 130


@pytest.mark.parametrize("keyed", [True, False])
def test_interval_join(spark, keyed):
    rnd = random.Random(4)
    ps = points(200, 5)
    spans = [(i, rnd.choice([0, 1, 2, None]), at(s := rnd.choice([None, *range(0, 3000, 11)])), at(None if s is None else s + rnd.choice([-5, 0, 1, 7, 60, 1000, 100_000]))) for i in range(80)]
    expected = sorted((p[0], s[0]) for p in ps for s in spans if p[2] and s[2] and s[3] and s[2] <= p[2] < s[3] and (not keyed or (p[1] is not None and p[1] == s[1])))
    right = spark.createDataFrame(spans, "sid long, k long, s timestamp_ntz, e timestamp_ntz")
    got = timeline.interval_join(frame(spark, ps), right if keyed else right.drop("k"), "t", "s", "e", ["k"] if keyed else [])
    assert collect(got, "id", "sid") == sorted(expected, key=str)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_interval_join_edges(spark):
    one = dt.timedelta(microseconds=1)
    spans = spark.createDataFrame([(1, T0, T0 + one), (2, T0, T0 + 4 * one), (3, dt.datetime(1960, 1, 1), dt.datetime(2100, 1, 1)), (4, T0, T0)], "sid long, s timestamp_ntz, e timestamp_ntz")
    ps = spark.createDataFrame([(1, T0), (2, T0 + one), (3, T0 + 4 * one), (4, dt.datetime(1960, 1, 1)), (5, dt.datetime(2100, 1, 1))], "id long, t timestamp_ntz")
    assert collect(timeline.interval_join(ps, spans, "t", "s", "e"), "id", "sid") == [(1, 1), (1, 2), (1, 3), (2, 2), (2, 3), (3, 3), (4, 3)]
    assert timeline.interval_join(ps, spans.limit(0), "t", "s", "e").count() == 0


@pytest.mark.parametrize("max_rows", [timeline.MAX_ROWS, 50, 2], ids=["whole", "cut", "fine"])
def test_sessions(spark, max_rows):
    rows = points(400, 6) + [(i, 9, at(i), 1) for i in range(1000, 1100)] + [(i, 9, at(20_000 + 500 * i), 1) for i in range(60)]
    expected = []
    for k in {r[1] for r in rows}:
        own = sorted((r for r in rows if r[1] == k and r[2]), key=lambda r: r[2])
        run = []
        for r in own:
            if run and r[2] - run[-1][2] > dt.timedelta(minutes=30):
                expected.append((k, run[0][2], run[-1][2], len(run), sum(x[3] for x in run)))
                run = []
            run.append(r)
        if run:
            expected.append((k, run[0][2], run[-1][2], len(run), sum(x[3] for x in run)))
    got = timeline.sessions(frame(spark, rows), "k", "t", 1800, max_rows, total=F.sum("v"))
    assert collect(got, "k", "session_start", "session_end", "events", "total") == sorted(expected, key=str)
