"""Registered queries along time (as-of join, interval join, sessions, a stream), over several groupings at once, stored
sketches, bucketed tables and samples.

The tables' orders and events lie years apart, so orders are replayed in the month of the events: a fixed rule on the
order date and number, stated in both engines."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakestrata.operators import sampling, timeline
from lakestrata.plans import analytics as qa
from lakestrata.plans.frames import Layers
from lakestrata.plans.oracle_sql import MONEY
from lakestrata.plans.registry import fresh_folder, register
from lakestrata.sources import buckets, landing
from lakestrata.streaming import landing_stream

#: rows of one key that one task orders in these queries: less than the hot key has
HOT_ROWS = 500


def _events(spark, sf_dir: str):
    """Events with a key that holds a third of them."""
    key = F.when(F.col("user_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id"))
    return spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("k", key.cast("long"))


def _replayed(spark, sf_dir: str):
    at = F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(datediff(o_orderdate, date'1995-01-01') % 30, cast(o_orderkey % 24 as int))")
    key = F.when(F.col("o_custkey") % 3 == 0, F.lit(0)).otherwise(F.col("o_custkey"))
    return spark.read.parquet(f"{sf_dir}/orders.parquet").withColumns({"at": at, "k": key.cast("long")})


_EVENTS = "ev AS (SELECT *, CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id END AS k FROM events)"
_REPLAYED = """rep AS (SELECT *, TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(datediff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) % 30 AS INTEGER)) + to_hours(o_orderkey % 24) AS since,
  CASE WHEN o_custkey % 3 = 0 THEN 0 ELSE o_custkey END AS k FROM orders)"""


@register("asof_events_orders", f"""
WITH {_EVENTS}, {_REPLAYED},
last_one AS (SELECT k, since, max(o_orderkey) AS o_orderkey, arg_max(o_totalprice, o_orderkey) AS o_totalprice FROM rep GROUP BY k, since)
SELECT e.event_id, o.o_orderkey, o.o_totalprice FROM ev AS e ASOF LEFT JOIN last_one AS o ON e.k = o.k AND e.ts >= o.since""")
def asof_events_orders(spark, sf_dir):
    """Each event with its customer's last order so far; at one time the largest order number counts."""
    events, orders = _events(spark, sf_dir).select("event_id", "ts", "k"), _replayed(spark, sf_dir)
    found = timeline.as_of_join(events, orders, "k", "ts", "at", ["o_orderkey", "o_totalprice"], "o_orderkey", max_rows=HOT_ROWS)
    return found.select("event_id", "o_orderkey", "o_totalprice")


@register("interval_events_in_delivery", f"""
WITH {_REPLAYED}
SELECT e.event_id, o.o_orderkey FROM events AS e JOIN rep AS o ON e.user_id = o.o_custkey AND e.ts >= o.since AND e.ts < o.since + to_hours(o.o_orderkey % 97)""")
def interval_events_in_delivery(spark, sf_dir):
    """Events of a customer while an order of theirs was on its way (0 to 96 hours)."""
    orders = _replayed(spark, sf_dir).withColumn("until", F.expr("at + make_dt_interval(0, cast(o_orderkey % 97 as int))"))
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", F.col("user_id").alias("customer"))
    windows = orders.select("o_orderkey", "at", "until", F.col("o_custkey").alias("customer"))
    return timeline.interval_join(events, windows, "ts", "at", "until", ["customer"]).select("event_id", "o_orderkey")


@register("interval_open_orders", f"""
WITH {_REPLAYED},
edge AS (SELECT since AS t, 1 AS d FROM rep WHERE o_orderkey % 97 > 0 UNION ALL SELECT since + to_hours(o_orderkey % 97), -1 FROM rep WHERE o_orderkey % 97 > 0),
moves AS (SELECT t, sum(d) AS d FROM edge GROUP BY t),
level AS (SELECT t, CAST(sum(d) OVER (ORDER BY t) AS BIGINT) AS n FROM moves)
SELECT e.event_id, coalesce(l.n, 0) AS open_orders FROM events AS e ASOF LEFT JOIN level AS l ON e.ts >= l.t WHERE e.event_type = 'error' AND coalesce(l.n, 0) > 0""")
def interval_open_orders(spark, sf_dir):
    """How many orders of all customers were on their way at each error event: bins alone, no key."""
    orders = _replayed(spark, sf_dir).withColumn("until", F.expr("at + make_dt_interval(0, cast(o_orderkey % 97 as int))"))
    # equal windows are one, with their number
    windows = orders.groupBy("at", "until").agg(F.count(F.lit(1)).alias("n"))
    errors = spark.read.parquet(f"{sf_dir}/events.parquet").where("event_type = 'error'").select("event_id", "ts")
    return timeline.interval_join(errors, windows, "ts", "at", "until").groupBy("event_id").agg(F.sum("n").alias("open_orders"))


@register("session_events", f"""
WITH {_EVENTS},
marked AS (SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 1 HOUR THEN 0 ELSE 1 END AS new FROM ev WINDOW w AS (PARTITION BY k ORDER BY ts)),
numbered AS (SELECT *, sum(new) OVER (PARTITION BY k ORDER BY ts) AS s FROM marked)
SELECT k, min(ts) AS session_start, max(ts) AS session_end, count(*) AS events, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents FROM numbered GROUP BY k, s""")
def session_events(spark, sf_dir):
    """Sessions with gaps of an hour at most; the hot key is cut into time ranges and merged again."""
    cents = F.sum(F.round(F.col("value") * 100).cast("long"))
    return timeline.sessions(_events(spark, sf_dir), "k", "ts", 3600, HOT_ROWS, cents=cents)


# ------------------------------------------------------------------ several groupings in one scan (QRY-2, QRY-3)

_SALES = """sales AS (
  SELECT d.customer_state, p.product_category_name, CAST(date_trunc('month', f.data_pedido) AS DATE) AS mes, CAST(f.price AS DECIMAL(18,2)) AS price
  FROM gold_fato_pedidos_itens f JOIN gold_dim_cliente d USING (customer_id) JOIN gold_dim_produto p USING (product_id))"""


@register("q_revenue_grouping_sets", f"""
WITH {_SALES}
SELECT customer_state, product_category_name, mes, CAST(grouping_id(customer_state, product_category_name, mes) AS BIGINT) AS nivel,
       CAST(sum(price) AS DOUBLE) AS receita, count(*) AS itens
FROM sales GROUP BY GROUPING SETS ((customer_state, product_category_name, mes), (customer_state, product_category_name), (customer_state), (product_category_name, mes), (mes), ())""")
def q_revenue_grouping_sets(spark, sf_dir):
    """State x category x month totals and their subtotals."""
    L = Layers(spark, sf_dir)
    sales = qa.sales_by_state_category_month(L.gold("fato_pedidos_itens"), L.gold("dim_cliente"), L.gold("dim_produto"))
    return qa.totals(sales, [("customer_state", "product_category_name", "mes"), ("customer_state", "product_category_name"), ("customer_state",),
                             ("product_category_name", "mes"), ("mes",), ()])


@register("q_revenue_rollup", f"""
WITH {_SALES}
SELECT customer_state, product_category_name, mes, CAST(grouping_id(customer_state, product_category_name, mes) AS BIGINT) AS nivel,
       CAST(sum(price) AS DOUBLE) AS receita, count(*) AS itens
FROM sales GROUP BY ROLLUP (customer_state, product_category_name, mes)""")
def q_revenue_rollup(spark, sf_dir):
    L = Layers(spark, sf_dir)
    sales = qa.sales_by_state_category_month(L.gold("fato_pedidos_itens"), L.gold("dim_cliente"), L.gold("dim_produto"))
    dims = ("customer_state", "product_category_name", "mes")
    return qa.totals(sales, [dims[:n] for n in range(4)])


@register("q_payment_pivot", f"""
SELECT payment_installments, {', '.join(f"{MONEY(f"CASE WHEN payment_type = '{t}' THEN payment_value END")} AS {t}" for t in ('boleto', 'credit_card', 'voucher'))}
FROM gold_fato_pagamentos GROUP BY payment_installments""")
def q_payment_pivot(spark, sf_dir):
    """Payment value by instalments, one column per payment type."""
    return qa.payment_pivot(Layers(spark, sf_dir).gold("fato_pagamentos"), ["boleto", "credit_card", "voucher"])


# ------------------------------------------------------------------ stored sketches (AGG-7)

@register("q_sketch_by_quarter", """
WITH f AS (SELECT coalesce(CAST(date_trunc('quarter', data_pedido) AS DATE), NULL) AS trimestre, customer_id, price FROM gold_fato_pedidos_itens)
SELECT trimestre, count(*) AS itens, count(DISTINCT customer_id) AS clientes, true AS clientes_ok, true AS mediana_ok, true AS p95_ok FROM f GROUP BY trimestre""")
def q_sketch_by_quarter(spark, sf_dir):
    """Distinct customers and price quantiles per quarter, merged from sketches stored per month, beside the exact
    figures: the distinct count is within 5 percent, the quantiles within 2 percent of the ranks."""
    L = Layers(spark, sf_dir)
    return qa.sketch_errors(L.gold("fato_pedidos_itens"))


# ------------------------------------------------------------------ streams over landed drops (SRC-3)

@register("stream_daily_sums", """
SELECT date_trunc('day', ts) AS window_start, event_type, count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents
FROM events GROUP BY 1, 2""")
def stream_daily_sums(spark, sf_dir):
    """Daily sums by a stream that is stopped and started again: two drops, the second one with rows of all days, a month
    late at most, which the watermark allows."""
    at = fresh_folder(spark, "stream")
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("cents", F.round(F.col("value") * 100).cast("long")).select("event_id", "ts", "event_type", "cents")
    schema, sums = "event_id long, ts timestamp, event_type string, cents long", "window_start timestamp, event_type string, n long, cents long"
    for day, part in (("2024-02-01", F.col("event_id") % 3 > 0), ("2024-02-02", F.col("event_id") % 3 == 0)):
        landing.write_landing(events.where(part), f"{at}/landing", "events", day)
        stream = landing_stream.landing_stream(spark, f"{at}/landing", "events", schema)
        daily = landing_stream.window_sums(stream, "ts", "1 day", ["event_type"], {"n": F.count(F.lit(1)), "cents": F.sum("cents")}, "40 days")
        landing_stream.run_available(daily, f"{at}/out", f"{at}/checkpoint")
    current = landing_stream.read_published(spark, f"{at}/out", sums, ["window_start", "event_type"])
    return current.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


# ------------------------------------------------------------------ bucketed tables (SNK-1, JN-1)

@register("bucketed_items_by_status", f"""
SELECT o.order_status, count(*) AS itens, {MONEY('i.price')} AS receita, count(DISTINCT i.order_id) AS pedidos
FROM silver_items i JOIN silver_orders o USING (order_id) GROUP BY o.order_status""")
def bucketed_items_by_status(spark, sf_dir):
    """Items and orders, both bucketed by order: they meet, and are added up per order, without a shuffle."""
    L, at = Layers(spark, sf_dir), fresh_folder(spark, "buckets")
    n = buckets.bucket_count(spark.read.parquet(f"{sf_dir}/lineitem.parquet").count())
    items, orders = (spark.table(buckets.write_bucketed(L.silver(t), f"{at}/{t}", ["order_id"], n)) for t in ("items", "orders"))
    return qa.items_by_status(items, orders)


# ------------------------------------------------------------------ samples

@register("sample_orders_by_status", """
SELECT order_id, order_status, customer_id FROM silver_orders
QUALIFY row_number() OVER (PARTITION BY order_status ORDER BY CAST('0x' || substr(md5('sample|' || order_id), 1, 15) AS BIGINT), order_id) <= 200""")
def sample_orders_by_status(spark, sf_dir):
    """200 orders of each status, the same ones in every run."""
    return sampling.stratified_sample(Layers(spark, sf_dir).silver("orders"), ["order_status"], ["order_id"], 200).select("order_id", "order_status", "customer_id")
