"""Operators along time: as-of join, interval join, session windows.

Rows of one key are ordered by time in one window task, so a key with a third of all rows would be one task. Keys with
more than ``max_rows`` rows are therefore cut into time ranges of about that many rows (:func:`time_ranges`); ranges are
worked on by themselves, and what goes over a cut, the last value or the open session, is carried by one small row per
range. Keys below the limit are one range. Results do not depend on the cuts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.session import materialize

#: rows of a key that one task orders
MAX_ROWS = 5_000_000
#: hot keys that are broadcast; more are joined by shuffle
NAMED_KEYS = 10_000
#: cuts of one key; a key with more rows has larger ranges, not fewer results
MAX_CUTS = 1000


def time_ranges(df: DataFrame, key: str, time: str, max_rows: int = MAX_ROWS) -> tuple[DataFrame, bool]:
    """``df`` with ``__range``, and whether there is any hot key: -1 for ordinary keys; for keys with more than ``max_rows``
    rows the number of the time range, by percentiles of the key's own times. Equal times of a key are in one range.

    Counting is a map-side aggregate; there are at most rows / ``max_rows`` hot keys. They are written and counted, and
    broadcast up to ``NAMED_KEYS`` of them."""
    hot = df.groupBy(F.col(key).alias("__hot")).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > max_rows)
    hot = materialize(hot.select("__hot", F.least(F.lit(MAX_CUTS), F.ceil(F.col("__n") / max_rows).cast("int")).alias("__cuts")), "hot-keys")
    n = hot.count()
    if not n:
        return df.withColumn("__range", F.lit(-1)), False
    few = F.broadcast if n <= NAMED_KEYS else lambda x: x
    is_hot = F.col(key).eqNullSafe(F.col("__hot"))
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    # percentiles at a fixed fine step, thinned to the number of cuts that the key needs
    fine = F.percentile_approx(micros, [i / 1000 for i in range(1, 1000)], 10_000)
    cuts = df.join(few(hot), is_hot).groupBy("__hot", "__cuts").agg(fine.alias("__fine"))
    cuts = cuts.select("__hot", F.array_distinct(F.filter("__fine", lambda x, i: (i + 1) * F.col("__cuts") % 1000 < F.col("__cuts"))).alias("__fine"))
    placed = df.join(few(materialize(cuts, "hot-cuts")), is_hot, "left")
    at = F.when(F.col("__hot").isNull() & F.col(key).isNotNull(), -1).when(F.col("__fine").isNull() | F.col(time).isNull(), 0)
    return placed.withColumn("__range", at.otherwise(F.size(F.filter("__fine", lambda c: c <= micros))).cast("int")).drop("__hot", "__fine"), True


def as_of_join(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, values: Sequence[str], tie: str | Column,
               max_rows: int = MAX_ROWS) -> DataFrame:
    """Each row of ``left`` with the ``values`` of the last row of ``right`` of the same key at or before its time.

    Among right rows of equal time the one with the largest ``tie`` counts (which has to be unique among them). Rows of
    ``left`` without such a row, a key or a time get NULLs; every row of ``left`` comes exactly once. Both sides are put
    one below the other and ordered by time once; the last right row is carried forward, over the cuts of a hot key by
    one row per range."""
    tie = F.col(tie) if isinstance(tie, str) else tie
    columns = [f"`{c}`" for c in left.columns]
    seen = F.struct(F.col(right_time).alias("at"), tie.alias("tie"), *(F.col(v).alias(v) for v in values))
    seen_type = right.select(seen.alias("x")).schema["x"].dataType
    placed = F.col(key).isNotNull() & F.col(left_time).isNotNull()
    a = left.where(placed).select(F.col(key).alias("__key"), F.col(left_time).alias("__time"), F.struct(*(F.col(c) for c in columns)).alias("__left"),
                                  F.lit(None).cast(seen_type).alias("__seen"))
    none = {"__time": F.lit(None).cast(a.schema["__time"].dataType), "__left": F.lit(None).cast(a.schema["__left"].dataType)}
    b = right.where(F.col(key).isNotNull() & F.col(right_time).isNotNull()).select(
        F.col(key).alias("__key"), F.col(right_time).alias("__time"), none["__left"].alias("__left"), seen.alias("__seen"))
    rows, any_hot = time_ranges(a.unionByName(b), "__key", "__time", max_rows)
    if any_hot:
        # the last right row of each range goes on to the ranges after it
        earlier = Window.partitionBy("__key").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
        ranges = rows.where(F.col("__range") >= 0).groupBy("__key", "__range").agg(F.max("__seen").alias("__last"))
        carried = ranges.withColumn("__seen", F.max("__last").over(earlier)).where(F.col("__seen").isNotNull()).drop("__last")
        rows = rows.unionByName(carried.withColumns(none))
    # at one time right rows come first, in the order of their ties; the carried row has no time and comes before all
    order = [F.col("__time").asc_nulls_first(), F.col("__left").isNotNull(), F.col("__seen.tie")]
    upto = Window.partitionBy("__key", "__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    found = rows.withColumn("__found", F.last("__seen", ignorenulls=True).over(upto)).where(F.col("__left").isNotNull())
    out = found.select("__left.*", *(F.col("__found")[v].alias(v) for v in values))
    return out.unionByName(left.where(~placed).select(*columns, *(F.lit(None).cast(out.schema[v].dataType).alias(v) for v in values)))


def interval_join(points: DataFrame, intervals: DataFrame, time: str, start: str, end: str, on: Sequence[str] = ()) -> DataFrame:
    """Every pair of a point and an interval with ``start <= time < end`` and equal columns ``on``, with the columns of
    both (all others named apart).

    Time is cut into bins on several levels, each level's bins being four times as wide as those of the one below. An
    interval belongs to the least level whose bins are as long as itself, so it lies in two bins at most, however long
    it is; a point looks into one bin of each level that the intervals use. Bins are joined by hash, then the bounds are
    tested exactly. Intervals without a bound or that end before they start hold nothing. A bin that many points and
    intervals share is split by AQE like any hot join key."""
    def micros(c: str) -> Column:
        return F.unix_micros(F.col(c).cast("timestamp"))

    spans = intervals.where(F.col(start) < F.col(end)).withColumns({"__s": micros(start), "__e": micros(end)})
    # the least level whose bins are as long as the interval: half the bits of its length less one, rounded up
    spans = spans.withColumn("__level", F.expr("cast((length(bin(__e - __s - 1)) + 1) div 2 as int)"))
    spans = spans.withColumn("__bin", F.explode(F.expr("sequence(shiftright(__s, 2 * __level), shiftright(__e - 1, 2 * __level))")))
    levels = [r[0] for r in spans.select("__level").distinct().collect()]  # 32 at most
    at = points.withColumns({"__t": micros(time), "__level": F.explode(F.array(*(F.lit(x) for x in levels or [0])))})
    at = at.withColumn("__bin", F.expr("shiftright(__t, 2 * __level)"))
    both = at.join(spans, [*on, "__level", "__bin"]).where((F.col("__s") <= F.col("__t")) & (F.col("__t") < F.col("__e")))
    return both.drop("__level", "__bin", "__t", "__s", "__e")


def sessions(events: DataFrame, key: str, time: str, gap_seconds: int, max_rows: int = MAX_ROWS, **measures: Column) -> DataFrame:
    """(key, session_start, session_end, events, measures...): runs of a key's events with no more than ``gap_seconds``
    between neighbours; events without a time are left out.

    ``measures`` are aggregate expressions that can be added up (sums); a hot key is cut into time ranges, each gives its
    own sessions, and those that touch over a cut are merged."""
    gap = F.lit(gap_seconds * 1_000_000).cast("long")
    rows, any_hot = time_ranges(events.where(F.col(time).isNotNull()), key, time, max_rows)
    rows = rows.withColumn("__t", F.unix_micros(F.col(time).cast("timestamp")))
    by_time = Window.partitionBy(key, "__range").orderBy("__t")
    new = F.coalesce((F.col("__t") - F.lag("__t").over(by_time) > gap).cast("int"), F.lit(1))
    rows = rows.withColumn("__new", new).withColumn("__session", F.sum("__new").over(by_time.rowsBetween(Window.unboundedPreceding, 0)))
    local = rows.groupBy(key, "__range", "__session").agg(F.min(time).alias("session_start"), F.max(time).alias("session_end"), F.min("__t").alias("__from"),
                                                          F.max("__t").alias("__to"), F.count(F.lit(1)).alias("events"), *(m.alias(n) for n, m in measures.items()))
    columns = [key, "session_start", "session_end", "events", *measures]
    if not any_hot:
        return local.select(*columns)
    # a range's first and last session can touch those of its neighbours: two rows a range meet in the key's order
    local = local.withColumn("__last", F.max("__session").over(Window.partitionBy(key, "__range")))
    at_edge = (F.col("__range") >= 0) & ((F.col("__session") == 1) | (F.col("__session") == F.col("__last")))
    by_start = Window.partitionBy(key).orderBy("__from")
    begun = F.coalesce((F.col("__from") - F.lag("__to").over(by_start) > gap).cast("int"), F.lit(1))
    edge = local.where(at_edge).withColumn("__begun", begun).withColumn("__session", F.sum("__begun").over(by_start.rowsBetween(Window.unboundedPreceding, 0)))
    merged = edge.groupBy(key, "__session").agg(F.min("session_start").alias("session_start"), F.max("session_end").alias("session_end"),
                                                F.sum("events").alias("events"), *(F.sum(n).alias(n) for n in measures))
    return local.where(~at_edge).select(*columns).unionByName(merged.select(*columns))
