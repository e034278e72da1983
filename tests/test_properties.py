"""Property-based checks of the checksum (hypothesis, small frames)."""

import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lakestrata.operators import quality as dq

ROW = st.tuples(st.one_of(st.none(), st.text(max_size=6)), st.one_of(st.none(), st.integers(-10**12, 10**12)),
                st.one_of(st.none(), st.floats(allow_nan=False, width=64)))
SCHEMA = "s string, i bigint, d double"
FAST = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@FAST
@given(rows=st.lists(ROW, min_size=1, max_size=30), seed=st.integers(0, 1000))
def test_checksum_ignores_row_order_and_partitioning(spark, rows, seed):
    shuffled = rows[:]
    random.Random(seed).shuffle(shuffled)
    a = spark.createDataFrame(rows, SCHEMA)
    b = spark.createDataFrame(shuffled, SCHEMA).repartition(3)
    assert dq.checksum(a) == dq.checksum(b)


@FAST
@given(rows=st.lists(ROW, min_size=1, max_size=30), pick=st.integers(0, 10**6), new=st.text(min_size=1, max_size=6))
def test_checksum_sees_any_one_cell_edit(spark, rows, pick, new):
    i = pick % len(rows)
    if rows[i][0] == new:
        return
    edited = rows[:]
    edited[i] = (new, rows[i][1], rows[i][2])
    assert dq.checksum(spark.createDataFrame(rows, SCHEMA)) != dq.checksum(spark.createDataFrame(edited, SCHEMA))


CHECK_ROW = st.tuples(st.one_of(st.none(), st.sampled_from(["a", "b", "c", "d"])),
                      st.one_of(st.none(), st.floats(-20, 20, allow_nan=False), st.just(float("nan"))))


@FAST
@given(rows=st.lists(CHECK_ROW, min_size=0, max_size=40))
def test_fused_checks_equal_brute_force(spark, rows):
    import math

    from lakestrata.specs import Check

    df = spark.createDataFrame(rows, "k string, v double")
    checks = [Check("row_count_min", minimum=5), Check("not_null", ("k",)), Check("unique", ("k",)),
              Check("range", ("v",), lo=0, hi=10), Check("accepted_values", ("k",), values=("a", "b"))]
    got = {r.check: r.violations for r in dq.run_checks(df, checks, "t", "t")}
    ks = [r[0] for r in rows]
    vs = [r[1] for r in rows]
    exp = {
        "row_count_min>=5": max(5 - len(rows), 0),
        "not_null:k": sum(k is None for k in ks),
        "unique:k": len(ks) - len(set(ks)),  # NULL keys compare equal, like distinct
        # Spark orders NaN above every number: it passes a lower bound and fails an upper bound
        "range:v[0,10]": sum(v is not None and not math.isnan(v) and v < 0 for v in vs)
                         + sum(v is not None and (math.isnan(v) or v > 10) for v in vs),
        "accepted_values:k": sum(k is not None and k not in ("a", "b") for k in ks),
    }
    assert got == exp
