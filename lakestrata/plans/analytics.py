"""Business queries the Gold layer answers (QRY-1..15).

Every function takes the frames it needs (never paths) and returns a lazy DataFrame. Money is summed as
decimal, so totals are exact and independent of the order of the rows at any size; results are doubles.

Facts meet dimensions one row per key: items are added up per order, and orders per customer, with a map-side
partial step before each join, so an order or a customer with a third of all items is one row when a join sees
it. Questions about orders take ``order_grain`` and ``order_totals`` of the layer frames;
the fan-out measurement counts ``sum(items_o * payments_o)`` instead of making the pairs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.session import materialize


def _money(c) -> Column:
    return F.round(c, 2)


def _total(col: str) -> Column:
    """An exact sum of cents."""
    return F.sum(F.col(col).cast("decimal(18,2)"))


def _cents(total: Column) -> Column:
    return total.cast("double")


def _per(total: Column, n: Column) -> Column:
    """Ratio of a money total to a count, rounded to cents."""
    return F.round(_cents(total) / n, 2)


def _position(df: DataFrame, *order) -> DataFrame:
    """The rank of each row of a small result (one row per group)."""
    return df.withColumn("posicao", F.row_number().over(Window.orderBy(*order)))


# QRY-1 -------------------------------------------------------------------------------------------
def revenue_by_state(order_totals: DataFrame, dim_cliente: DataFrame, k: int | None = 5) -> DataFrame:
    """Revenue (sum of item price) by customer state, highest first; top ``k`` (None = all)."""
    if k is not None and k < 0:
        raise ValueError("k must not be negative")
    by_customer = order_totals.groupBy("customer_id").agg(F.sum("total").alias("total"))
    by_state = (by_customer.join(dim_cliente.select("customer_id", "customer_state"), "customer_id")
                .groupBy("customer_state").agg(F.sum("total").alias("total"))
                .select("customer_state", _cents(F.col("total")).alias("receita")))
    order = (F.desc("receita"), F.asc("customer_state"))
    top = by_state.orderBy(*order)
    return _position(top if k is None else top.limit(k), *order)


# QRY-2 -------------------------------------------------------------------------------------------
def ticket_by_state(order_totals: DataFrame, dim_cliente: DataFrame) -> DataFrame:
    """Revenue, average item price (the published "ticket"), orders, items and revenue per order. An order
    belongs to one customer, so orders add up over customers."""
    by_customer = order_totals.groupBy("customer_id").agg(F.sum("total").alias("total"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("orders"))
    by_state = (by_customer.join(dim_cliente.select("customer_id", "customer_state"), "customer_id")
                .groupBy("customer_state").agg(*(F.sum(c).alias(c) for c in ("total", "n", "orders"))))
    total = F.col("total")
    return by_state.select("customer_state", _cents(total).alias("receita"), _per(total, F.col("n")).alias("ticket_medio_item"),
                           F.col("orders").alias("pedidos"), F.col("n").alias("itens"),
                           _per(total, F.col("orders")).alias("receita_por_pedido")).orderBy(F.desc("receita"), F.asc("customer_state"))


# QRY-3 -------------------------------------------------------------------------------------------
def _added_up(fato_itens: DataFrame, *by: str) -> DataFrame:
    """Exact revenue and items of an order within ``by``: what meets a dimension is one row per order, not per item.
    The key is one struct: rows that a join left by order would serve separate keys as they lie, and one task would then
    hold every group twice, for the partial and for the final sums, beside the join's sorts."""
    keys = (*by, "order_id")
    sums = fato_itens.groupBy(F.struct(*keys).alias("key")).agg(_total("price").alias("total"), F.count(F.lit(1)).alias("n"))
    return sums.select(*(F.col(f"key.{k}").alias(k) for k in keys), "total", "n")


def revenue_by_category(fato_itens: DataFrame, dim_produto: DataFrame) -> DataFrame:
    j = _added_up(fato_itens, "product_id").join(
        dim_produto.select("product_id", "product_category_name", "product_category_name_english"), "product_id")
    return (j.groupBy("product_category_name", "product_category_name_english")
            .agg(_cents(F.sum("total")).alias("receita"),
                 _per(F.sum("total"), F.sum("n")).alias("ticket_medio_item"),
                 F.count_distinct("order_id").alias("pedidos"),
                 F.sum("n").alias("itens"))
            .orderBy(F.desc("receita"), F.asc("product_category_name")))


def revenue_by_period(fato_itens: DataFrame, dim_tempo: DataFrame) -> DataFrame:
    cal = dim_tempo.select(F.col("data").alias("data_pedido"), "ano", "mes", "trimestre")
    j = _added_up(fato_itens, "data_pedido").join(cal, "data_pedido")
    return (j.groupBy("ano", "trimestre", "mes")
            .agg(_cents(F.sum("total")).alias("receita"),
                 F.count_distinct("order_id").alias("pedidos"),
                 F.sum("n").alias("itens"),
                 _per(F.sum("total"), F.count_distinct("order_id")).alias("receita_por_pedido"))
            .orderBy("ano", "mes"))


def sales_by_state_category_month(fato_itens: DataFrame, dim_cliente: DataFrame, dim_produto: DataFrame) -> DataFrame:
    """(customer_state, product_category_name, mes, total, n): the finest totals, for :func:`totals`. Items are added up
    per customer, product and month before they meet a dimension."""
    month = F.trunc("data_pedido", "month").alias("mes")
    sums = fato_itens.groupBy("customer_id", "product_id", month).agg(_total("price").alias("total"), F.count(F.lit(1)).alias("n"))
    by_state = sums.join(dim_cliente.select("customer_id", "customer_state"), "customer_id").groupBy("customer_state", "product_id", "mes").agg(
        F.sum("total").alias("total"), F.sum("n").alias("n"))
    named = by_state.join(dim_produto.select("product_id", "product_category_name"), "product_id")
    return named.groupBy("customer_state", "product_category_name", "mes").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def totals(sales: DataFrame, sets: Sequence[Sequence[str]]) -> DataFrame:
    """Totals of every grouping in ``sets`` at once: one expanded aggregate over the finest totals. ``nivel`` has a bit
    for each dimension that a row leaves out."""
    dims = ["customer_state", "product_category_name", "mes"]
    return sales.groupingSets(sets, *dims).agg(F.grouping_id().alias("nivel"), _cents(F.sum("total")).alias("receita"), F.sum("n").alias("itens"))


def payment_pivot(fato_pagamentos: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """Payment value by instalments, a column per kind; ``kinds`` are given, so no pass looks for them."""
    return fato_pagamentos.groupBy("payment_installments").pivot("payment_type", list(kinds)).agg(_cents(_total("payment_value")))


def items_by_status(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Items, revenue and orders by status, from one row per order: what an order has is added up before it meets its
    header. Over tables bucketed by order neither step needs a shuffle."""
    per_order = items.groupBy("order_id").agg(_total("price").alias("total"), F.count(F.lit(1)).alias("n"))
    both = per_order.join(orders.select("order_id", "order_status"), "order_id")
    return both.groupBy("order_status").agg(F.sum("n").alias("itens"), _cents(F.sum("total")).alias("receita"), F.count(F.lit(1)).alias("pedidos"))


# AGG-7, approximate ------------------------------------------------------------------------------
HLL_LOG_BUCKETS, KLL_K = 13, 1000


def monthly_sketches(fato_itens: DataFrame) -> DataFrame:
    """(mes, itens, clientes, precos): per month a sketch of its distinct customers and one of its prices' quantiles, a
    few kilobytes each, to be stored and merged over any range of months without reading items again."""
    return fato_itens.groupBy(F.trunc("data_pedido", "month").alias("mes")).agg(
        F.count(F.lit(1)).alias("itens"), F.hll_sketch_agg("customer_id", HLL_LOG_BUCKETS).alias("clientes"), F.kll_sketch_agg_double("price", KLL_K).alias("precos"))


def merged_sketches(stored: DataFrame, by: Column) -> DataFrame:
    """Stored sketches merged per ``by``: items, estimated customers, estimated median and 95th percentile of the price."""
    return stored.groupBy(by).agg(F.sum("itens").alias("itens"), F.hll_union_agg("clientes").alias("c"), F.kll_merge_agg_double("precos", KLL_K).alias("p")).withColumns({
        "clientes_estimados": F.hll_sketch_estimate("c"), "mediana": F.kll_sketch_get_quantile_double("p", F.lit(0.5)),
        "p95": F.kll_sketch_get_quantile_double("p", F.lit(0.95))}).drop("c", "p")


def sketch_errors(fato_itens: DataFrame) -> DataFrame:
    """The quarters of :func:`merged_sketches` beside the exact figures. A quantile is held against the share of prices
    below and up to it."""
    quarter = F.trunc("data_pedido", "quarter").alias("trimestre")
    merged = merged_sketches(materialize(monthly_sketches(fato_itens), "sketches"), F.trunc("mes", "quarter").alias("trimestre"))
    estimates = merged.drop("itens").withColumnRenamed("trimestre", "q")
    prices = fato_itens.select(quarter, "customer_id", "price").join(estimates, F.col("trimestre").eqNullSafe(F.col("q")))

    def near(q: float, name: str) -> Column:
        below, upto = F.avg((F.col("price") < F.col(name)).cast("int")), F.avg((F.col("price") <= F.col(name)).cast("int"))
        return (below <= q + 0.02) & (upto >= q - 0.02)

    exact = F.count_distinct("customer_id")
    return prices.groupBy("trimestre").agg(F.count(F.lit(1)).alias("itens"), exact.alias("clientes"), (F.abs(F.first("clientes_estimados") - exact) <= 0.05 * exact).alias("clientes_ok"),
                                           near(0.5, "mediana").alias("mediana_ok"), near(0.95, "p95").alias("p95_ok"))


# QRY-4 -------------------------------------------------------------------------------------------
def delivery_kpis(orders: DataFrame) -> DataFrame:
    """Over one row per order that has an item (``order_grain``)."""
    late = F.col("entregue_com_atraso")
    return orders.agg(
        F.count(F.lit(1)).alias("pedidos"),
        F.count(late).alias("pedidos_entregues"),
        F.count_if(late).alias("pedidos_com_atraso"),
        F.round(F.avg(late.cast("int")), 4).alias("taxa_atraso"),
        _money(F.avg("prazo_entrega_dias")).alias("prazo_medio_dias"),
        _money(F.avg("atraso_entrega_dias")).alias("atraso_medio_dias"),
    )


# QRY-5 -------------------------------------------------------------------------------------------
def score_by_delay(fato_avaliacoes: DataFrame, orders: DataFrame) -> DataFrame:
    """Average review score by delivery situation: on time / late / not delivered. Reviews are added up per
    order before they meet the order."""
    late = F.col("entregue_com_atraso")
    situation = F.when(late.isNull(), "nao_entregue").when(late, "com_atraso").otherwise("no_prazo")
    per_order = fato_avaliacoes.groupBy("order_id").agg(F.sum("review_score").alias("score"), F.count("review_score").alias("scored"),
                                                        F.count(F.lit(1)).alias("n"))
    return (per_order.join(orders.select("order_id", "entregue_com_atraso"), "order_id")
            .groupBy(situation.alias("situacao_entrega"))
            .agg(_money(F.sum("score") / F.sum("scored")).alias("nota_media"), F.sum("n").alias("avaliacoes"))
            .orderBy(F.desc("nota_media"), F.asc("situacao_entrega")))


# QRY-6 -------------------------------------------------------------------------------------------
def payment_mix(fato_pagamentos: DataFrame) -> DataFrame:
    return (fato_pagamentos.groupBy("payment_type", "payment_installments")
            .agg(F.count(F.lit(1)).alias("pagamentos"),
                 F.count_distinct("order_id").alias("pedidos"),
                 _cents(_total("payment_value")).alias("valor_total"))
            .orderBy("payment_type", "payment_installments"))


# QRY-7 -------------------------------------------------------------------------------------------
def recurring_customers(orders: DataFrame, dim_cliente: DataFrame) -> DataFrame:
    """Persons (``customer_unique_id``) versus per-order customer ids.

    ``ids_extras`` = distinct customer ids − persons (the published "recurring" figure, an upper bound);
    ``clientes_recorrentes`` = persons with more than one order (the actual count).
    """
    per_customer = orders.select("order_id", "customer_id").distinct().groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))
    ids = dim_cliente.select("customer_id", "customer_unique_id").join(per_customer, "customer_id", "left")
    p = ids.groupBy("customer_unique_id").agg(F.count(F.lit(1)).alias("n_ids"), F.sum("n").alias("n_pedidos"))
    return p.agg(
        F.sum("n_ids").alias("customer_ids"),
        F.count(F.lit(1)).alias("pessoas"),
        (F.sum("n_ids") - F.count(F.lit(1))).alias("ids_extras"),
        F.count_if(F.col("n_pedidos") >= 1).alias("pessoas_com_pedido"),
        F.count_if(F.col("n_pedidos") > 1).alias("clientes_recorrentes"),
    )


# QRY-8 -------------------------------------------------------------------------------------------
def fanout_factor(items: DataFrame, payments: DataFrame) -> DataFrame:
    """Rows a naive items × payments join on ``order_id`` would produce, without producing them.

    One shuffle: per order, count items and payments (partial aggregation first), then sum the
    products. ``fator_inflacao`` = naive rows / item rows.
    """
    tagged = (items.select("order_id", F.lit(1).alias("i"), F.lit(0).alias("p"))
              .unionByName(payments.select("order_id", F.lit(0).alias("i"), F.lit(1).alias("p"))))
    per_order = tagged.groupBy("order_id").agg(F.sum("i").cast("bigint").alias("n_i"),
                                               F.sum("p").cast("bigint").alias("n_p"))
    return per_order.agg(
        F.sum("n_i").alias("linhas_itens"),
        F.sum(F.col("n_i") * F.col("n_p")).alias("linhas_join_ingenuo"),
        F.round(F.sum(F.col("n_i") * F.col("n_p")) / F.sum("n_i"), 4).alias("fator_inflacao"),
        F.count_if(F.col("n_p") > 1).alias("pedidos_multi_pagamento"),
    )


# QRY-9 -------------------------------------------------------------------------------------------
def undelivered_share(orders: DataFrame) -> DataFrame:
    nd = F.col("order_delivered_customer_date").isNull()
    return orders.agg(
        F.count(F.lit(1)).alias("pedidos"),
        F.count_if(nd).alias("nao_entregues"),
        F.round(100 * F.count_if(nd) / F.count(F.lit(1)), 2).alias("pct_nao_entregues"),
    )


# QRY-10 ------------------------------------------------------------------------------------------
def score_histogram(reviews: DataFrame) -> DataFrame:
    counts = reviews.groupBy("review_score").agg(F.count(F.lit(1)).alias("avaliacoes"))
    return _position(counts, F.asc_nulls_first("review_score")).orderBy("posicao")


# QRY-11 ------------------------------------------------------------------------------------------
def dedup_impact(raw_geo: DataFrame, cleaned_cols: dict[str, F.Column]) -> DataFrame:
    """Rows before, after an exact de-duplication of the raw text, and after cleaning + de-duplication.

    The first aggregate groups identical raw rows (collapsing copies map-side); the cleaned tuple is
    then counted distinct over those groups, so no step sees more rows than the raw distinct count.
    """
    raw_cols = raw_geo.columns
    g = raw_geo.groupBy(*raw_cols).agg(F.count(F.lit(1)).alias("n"))
    cleaned = F.struct(*[e.alias(c) for c, e in cleaned_cols.items()])
    return g.agg(
        F.sum("n").alias("linhas_antes"),
        F.count(F.lit(1)).alias("linhas_sem_copias_exatas"),
        F.count_distinct(cleaned).alias("linhas_depois"),
    ).withColumn("reducao_pct", F.round(100 * (1 - F.col("linhas_depois") / F.col("linhas_antes")), 1))


# QRY-12 ------------------------------------------------------------------------------------------
def value_profile(frames: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Distinct values of selected columns with their row counts: ``{label: (frame, column)}``."""
    parts = [df.groupBy(F.col(col).cast("string").alias("valor")).agg(F.count(F.lit(1)).alias("linhas"))
               .select(F.lit(label).alias("coluna"), "valor", "linhas")
             for label, (df, col) in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# QRY-13 ------------------------------------------------------------------------------------------
def key_uniqueness(df: DataFrame, key: str) -> DataFrame:
    """Row count versus distinct key count (a translation table must be 1:1 on its key)."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.sum("n").alias("linhas"), F.count(F.lit(1)).alias("chaves_distintas"),
                       (F.sum("n") - F.count(F.lit(1))).alias("linhas_duplicadas"))


# QRY-15 ------------------------------------------------------------------------------------------
def review_response_time(fato_avaliacoes: DataFrame) -> DataFrame:
    d = F.col("dias_ate_resposta")
    return (fato_avaliacoes.groupBy("review_score")
            .agg(F.count(F.lit(1)).alias("avaliacoes"), _money(F.avg(d)).alias("resposta_media_dias"),
                 F.min(d).alias("resposta_min_dias"), F.max(d).alias("resposta_max_dias"))
            .orderBy("review_score"))
