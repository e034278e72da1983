"""Business queries against brute force on the smallest data set (the join is materialised here,
which the queries themselves never do)."""

import pandas as pd
import pytest

from lakestrata.operators import gold
from lakestrata.plans import analytics as qa
from lakestrata.plans.frames import Layers

from small_data import SMALL_SF


@pytest.fixture(scope="module")
def L(spark):
    return Layers(spark, SMALL_SF)


def test_fanout_counts_equal_the_materialised_join(L):
    items, payments = L.silver("items"), L.silver("payments")
    r = qa.fanout_factor(items, payments).collect()[0]
    naive = items.select("order_id").join(payments.select("order_id"), "order_id").count()
    assert r.linhas_itens == items.count()
    assert r.linhas_join_ingenuo == naive
    multi = payments.groupBy("order_id").count().where("count > 1").count()
    assert r.pedidos_multi_pagamento == multi


def test_delivery_kpis_brute_force(L):
    fact = L.gold("fato_pedidos_itens").select("order_id", "prazo_entrega_dias", "atraso_entrega_dias",
                                               "entregue_com_atraso").toPandas()
    orders = fact.drop_duplicates("order_id")
    r = qa.delivery_kpis(L.order_grain()).collect()[0]
    assert r.pedidos == len(orders)
    assert r.pedidos_entregues == orders["entregue_com_atraso"].notna().sum()
    assert r.pedidos_com_atraso == (orders["entregue_com_atraso"] == True).sum()  # noqa: E712
    assert r.prazo_medio_dias == pytest.approx(round(orders["prazo_entrega_dias"].mean(), 2), abs=0.006)


def test_score_by_delay_brute_force(L):
    fact = L.gold("fato_pedidos_itens").select("order_id", "entregue_com_atraso").toPandas()
    reviews = L.gold("fato_avaliacoes").select("order_id", "review_score").toPandas()
    flags = fact.drop_duplicates("order_id")
    j = reviews.merge(flags, on="order_id")
    j["situ"] = j["entregue_com_atraso"].map({True: "com_atraso", False: "no_prazo"}).fillna("nao_entregue")
    exp = j.groupby("situ")["review_score"].agg(["count", "mean"])
    got = {r.situacao_entrega: r for r in qa.score_by_delay(L.gold("fato_avaliacoes"), L.order_grain()).collect()}
    assert set(got) == set(exp.index)
    for s, row in exp.iterrows():
        assert got[s].avaliacoes == row["count"]
        assert got[s].nota_media == pytest.approx(row["mean"], abs=0.006)


def test_recurring_customers_brute_force(L):
    dim = L.gold("dim_cliente").select("customer_id", "customer_unique_id").toPandas()
    orders = L.silver("orders").select("order_id", "customer_id").toPandas()
    per_person = orders.merge(dim, on="customer_id").groupby("customer_unique_id")["order_id"].nunique()
    r = qa.recurring_customers(L.silver("orders"), L.gold("dim_cliente")).collect()[0]
    assert r.customer_ids == len(dim)
    assert r.pessoas == dim["customer_unique_id"].nunique()
    assert r.clientes_recorrentes == int((per_person > 1).sum())
    assert isinstance(per_person, pd.Series)


def test_money_is_exact_at_any_size(spark):
    """Cents survive totals beyond what a sum of doubles keeps."""
    items = spark.range(1000).selectExpr("'o' AS order_id", "IF(id = 0, 0.01D, 9999999999999.99D) AS price")
    orders = spark.createDataFrame([("o", "k")], "order_id string, customer_id string")
    totals = gold.order_totals({"items": items, "orders": orders})
    dim = spark.createDataFrame([("k", "S")], "customer_id string, customer_state string")
    total = qa.revenue_by_state(totals, dim).collect()[0]["receita"]
    assert total == float("9989999999999990.02")


def test_top_k(L):
    every = qa.revenue_by_state(L.order_totals(), L.gold("dim_cliente"), k=None).collect()
    assert [r["posicao"] for r in every] == list(range(1, len(every) + 1))
    assert qa.revenue_by_state(L.order_totals(), L.gold("dim_cliente"), k=2).collect() == every[:2]
    assert qa.revenue_by_state(L.order_totals(), L.gold("dim_cliente"), k=0).collect() == []
