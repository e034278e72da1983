"""Registered queries (Spark) and their DuckDB oracles, one key per inventory item.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLES[name] -> SQL``. Column names and types
agree between the two; technical timestamp columns are never output.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.operators import quality as dq
from lakestrata.operators.silver import SILVER_COLUMNS, SILVER_RULES, to_silver
from lakestrata.functions.clean import to_double, to_int, to_ts
from lakestrata.functions.hashing import checksum_agg, portable_checksum, row_hash
from lakestrata.operators import gold as gold_ops
from lakestrata.plans import analytics as qa
from lakestrata.plans import jobs
from lakestrata.plans.frames import Layers
from lakestrata.plans.oracle_sql import (CHECKSUM_SQL, GOLD_CTES, GOLD_MANIFEST, MANIFEST, MANIFEST_SQL, MONEY, RAW_MANIFEST, RAW_ORDER_MANIFEST, SUITES, R,
                                         check_sql, suite_sql)
from lakestrata.plans.registry import ORACLES, QUERIES, Query, fresh_folder, register
from lakestrata.session import materialize
from lakestrata.sources import landing, layers
from lakestrata.sources.layers import schema_strings
from lakestrata.specs import CHECKS, ORDER_STATUSES, TABLES, Check, table_spec

__all__ = ["ORACLES", "QUERIES"]

# ------------------------------------------------------------------------------ Silver (SLV-1..9)

def _silver_query(table: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return Layers(spark, sf_dir).silver(table).select(*SILVER_COLUMNS[table])
    q.__name__ = f"silver_{table}"
    return q


for _t in SILVER_RULES:
    register(f"silver_{_t}", f"SELECT * FROM silver_{_t}")(_silver_query(_t))


# ------------------------------------------------------------------------------- Gold (GLD-1..7)

def _gold_query(name: str, dirty: bool = False) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return Layers(spark, sf_dir, dirty).gold(name)
    q.__name__ = f"gold_{name}"
    return q


for _g in GOLD_CTES:
    _name = _g[len("gold_"):]
    register(_g, f"SELECT * FROM {_g}")(_gold_query(_name))

# over tables with repeated keys, NULL and unparsable dates, and items without an order
for _name in ("dim_cliente", "dim_vendedor", "dim_tempo", "fato_pedidos_itens"):
    register(f"gold_dirty_{_name}", f"SELECT * FROM gold_{_name}", dirty=True)(_gold_query(_name, dirty=True))


# ----------------------------------------------------------------------------- queries (QRY-*)

@register("q_revenue_by_state", f"""
SELECT *, CAST(row_number() OVER (ORDER BY receita DESC, customer_state) AS INTEGER) AS posicao FROM (
  SELECT d.customer_state, {MONEY('f.price')} AS receita
  FROM gold_fato_pedidos_itens f JOIN gold_dim_cliente d ON f.customer_id = d.customer_id
  GROUP BY d.customer_state ORDER BY receita DESC, d.customer_state LIMIT 5)""")
def q_revenue_by_state(spark, sf_dir):
    L = Layers(spark, sf_dir)
    return qa.revenue_by_state(L.order_totals(), L.gold("dim_cliente"), k=5)


@register("q_ticket_by_state", f"""
SELECT d.customer_state, {MONEY('f.price')} AS receita,
       {R(MONEY('f.price') + ' / count(*)', 2)} AS ticket_medio_item,
       count(DISTINCT f.order_id) AS pedidos, count(*) AS itens,
       {R(MONEY('f.price') + ' / count(DISTINCT f.order_id)', 2)} AS receita_por_pedido
FROM gold_fato_pedidos_itens f JOIN gold_dim_cliente d ON f.customer_id = d.customer_id
GROUP BY d.customer_state""")
def q_ticket_by_state(spark, sf_dir):
    L = Layers(spark, sf_dir)
    return qa.ticket_by_state(L.order_totals(), L.gold("dim_cliente"))


@register("q_revenue_by_category", f"""
SELECT p.product_category_name, p.product_category_name_english, {MONEY('f.price')} AS receita,
       {R(MONEY('f.price') + ' / count(*)', 2)} AS ticket_medio_item, count(DISTINCT f.order_id) AS pedidos, count(*) AS itens
FROM gold_fato_pedidos_itens f JOIN gold_dim_produto p ON f.product_id = p.product_id
GROUP BY p.product_category_name, p.product_category_name_english""")
def q_revenue_by_category(spark, sf_dir):
    L = Layers(spark, sf_dir)
    return qa.revenue_by_category(L.gold("fato_pedidos_itens"), L.gold("dim_produto"))


@register("q_revenue_by_period", f"""
SELECT t.ano, t.trimestre, t.mes, {MONEY('f.price')} AS receita, count(DISTINCT f.order_id) AS pedidos,
       count(*) AS itens, {R(MONEY('f.price') + ' / count(DISTINCT f.order_id)', 2)} AS receita_por_pedido
FROM gold_fato_pedidos_itens f JOIN gold_dim_tempo t ON f.data_pedido = t.data
GROUP BY t.ano, t.trimestre, t.mes""")
def q_revenue_by_period(spark, sf_dir):
    L = Layers(spark, sf_dir)
    return qa.revenue_by_period(L.gold("fato_pedidos_itens"), L.gold("dim_tempo"))


@register("q_delivery_kpis", f"""
SELECT count(*) AS pedidos, count(entregue_com_atraso) AS pedidos_entregues,
       CAST(count_if(entregue_com_atraso) AS BIGINT) AS pedidos_com_atraso,
       {R('avg(CAST(entregue_com_atraso AS INTEGER))', 4)} AS taxa_atraso,
       {R('avg(prazo_entrega_dias)', 2)} AS prazo_medio_dias, {R('avg(atraso_entrega_dias)', 2)} AS atraso_medio_dias
FROM (SELECT DISTINCT order_id, prazo_entrega_dias, atraso_entrega_dias, entregue_com_atraso
      FROM gold_fato_pedidos_itens)""")
def q_delivery_kpis(spark, sf_dir):
    return qa.delivery_kpis(Layers(spark, sf_dir).order_grain())


@register("q_score_by_delay", f"""
SELECT CASE WHEN o.entregue_com_atraso IS NULL THEN 'nao_entregue'
            WHEN o.entregue_com_atraso THEN 'com_atraso' ELSE 'no_prazo' END AS situacao_entrega,
       {R('avg(a.review_score)', 2)} AS nota_media, count(*) AS avaliacoes
FROM gold_fato_avaliacoes a
JOIN (SELECT DISTINCT order_id, entregue_com_atraso FROM gold_fato_pedidos_itens) o ON a.order_id = o.order_id
GROUP BY 1""")
def q_score_by_delay(spark, sf_dir):
    L = Layers(spark, sf_dir)
    return qa.score_by_delay(L.gold("fato_avaliacoes"), L.order_grain())


@register("q_payment_mix", f"""
SELECT payment_type, payment_installments, count(*) AS pagamentos, count(DISTINCT order_id) AS pedidos,
       {MONEY('payment_value')} AS valor_total
FROM gold_fato_pagamentos GROUP BY payment_type, payment_installments""")
def q_payment_mix(spark, sf_dir):
    return qa.payment_mix(Layers(spark, sf_dir).gold("fato_pagamentos"))


@register("q_recurring_customers", """
WITH ids AS (SELECT customer_unique_id, count(*) AS n_ids FROM gold_dim_cliente GROUP BY customer_unique_id),
ords AS (SELECT d.customer_unique_id, count(DISTINCT o.order_id) AS n_pedidos
         FROM silver_orders o JOIN gold_dim_cliente d ON o.customer_id = d.customer_id
         GROUP BY d.customer_unique_id)
SELECT CAST(sum(n_ids) AS BIGINT) AS customer_ids, count(*) AS pessoas,
       CAST(sum(n_ids) - count(*) AS BIGINT) AS ids_extras,
       CAST(count_if(n_pedidos >= 1) AS BIGINT) AS pessoas_com_pedido,
       CAST(count_if(n_pedidos > 1) AS BIGINT) AS clientes_recorrentes
FROM ids LEFT JOIN ords ON ids.customer_unique_id = ords.customer_unique_id""")
def q_recurring_customers(spark, sf_dir):
    L = Layers(spark, sf_dir)
    return qa.recurring_customers(L.silver("orders"), L.gold("dim_cliente"))


@register("q_fanout_factor", f"""
WITH per_order AS (
  SELECT order_id, sum(i) AS n_i, sum(p) AS n_p FROM (
    SELECT order_id, 1 AS i, 0 AS p FROM silver_items UNION ALL SELECT order_id, 0, 1 FROM silver_payments)
  GROUP BY order_id)
SELECT CAST(sum(n_i) AS BIGINT) AS linhas_itens, CAST(sum(n_i * n_p) AS BIGINT) AS linhas_join_ingenuo,
       {R('sum(n_i * n_p) / sum(n_i)', 4)} AS fator_inflacao,
       CAST(count_if(n_p > 1) AS BIGINT) AS pedidos_multi_pagamento
FROM per_order""")
def q_fanout_factor(spark, sf_dir):
    L = Layers(spark, sf_dir)
    return qa.fanout_factor(L.silver("items"), L.silver("payments"))


@register("q_undelivered_share", f"""
SELECT count(*) AS pedidos, CAST(count_if(order_delivered_customer_date IS NULL) AS BIGINT) AS nao_entregues,
       {R('100 * count_if(order_delivered_customer_date IS NULL) / count(*)', 2)} AS pct_nao_entregues
FROM silver_orders""")
def q_undelivered_share(spark, sf_dir):
    return qa.undelivered_share(Layers(spark, sf_dir).silver("orders"))


@register("q_score_histogram", """
SELECT review_score, count(*) AS avaliacoes, CAST(row_number() OVER (ORDER BY review_score NULLS FIRST) AS INTEGER) AS posicao
FROM silver_reviews GROUP BY review_score""")
def q_score_histogram(spark, sf_dir):
    return qa.score_histogram(Layers(spark, sf_dir).silver("reviews"))


@register("q_review_response_time", f"""
SELECT review_score, count(*) AS avaliacoes, {R('avg(dias_ate_resposta)', 2)} AS resposta_media_dias,
       min(dias_ate_resposta) AS resposta_min_dias, max(dias_ate_resposta) AS resposta_max_dias
FROM gold_fato_avaliacoes GROUP BY review_score""")
def q_review_response_time(spark, sf_dir):
    return qa.review_response_time(Layers(spark, sf_dir).gold("fato_avaliacoes"))


@register("q_dedup_impact", f"""
WITH g AS (SELECT geolocation_zip_code_prefix, geolocation_lat, geolocation_lng, geolocation_city,
                  geolocation_state, count(*) AS n
           FROM raw_geolocation GROUP BY ALL)
SELECT CAST(sum(n) AS BIGINT) AS linhas_antes, count(*) AS linhas_sem_copias_exatas,
       (SELECT count(*) FROM silver_geolocation) AS linhas_depois,
       {R('100 * (1 - (SELECT count(*) FROM silver_geolocation) / sum(n))', 1)} AS reducao_pct
FROM g""")
def q_dedup_impact(spark, sf_dir):
    L = Layers(spark, sf_dir)
    cleaned = {c: f(c) for c, f in SILVER_RULES["geolocation"].items()}
    return qa.dedup_impact(L.raw("geolocation"), cleaned)


_PROFILE = [("order_status", "orders"), ("payment_type", "payments"), ("product_category_name", "products"),
            ("seller_state", "sellers"), ("customer_state", "customers")]


@register("q_value_profile", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS coluna, CAST({c} AS VARCHAR) AS valor, count(*) AS linhas FROM silver_{t} GROUP BY {c}"
    for c, t in _PROFILE))
def q_value_profile(spark, sf_dir):
    L = Layers(spark, sf_dir)
    return qa.value_profile({c: (L.silver(t), c) for c, t in _PROFILE})


@register("q_translation_uniqueness", """
SELECT CAST(sum(n) AS BIGINT) AS linhas, count(*) AS chaves_distintas, CAST(sum(n) - count(*) AS BIGINT) AS linhas_duplicadas
FROM (SELECT product_category_name, count(*) AS n FROM silver_category_name GROUP BY product_category_name)""")
def q_translation_uniqueness(spark, sf_dir):
    return qa.key_uniqueness(Layers(spark, sf_dir).silver("category_name"), "product_category_name")


# ------------------------------------------------------------------------------ checks (DQ-*)
# Each report is a list of (layer, table, relation, checks). A relation is "raw_x", "silver_x",
# "gold_x" or one of the defect frames; references resolve to "{ref_layer}_{ref_table}".

def _relation(L: Layers, rel: str) -> DataFrame:
    if rel == "gold_fato_itens_dup_header":
        orders = L.silver("orders")
        dup = orders.unionByName(orders.where(F.col("order_status") == "created"))
        return gold_ops.build("fato_pedidos_itens", {"orders": dup, "items": L.silver("items")})
    layer, _, name = rel.partition("_")
    return {"raw": L.raw, "silver": L.silver, "gold": L.gold}[layer](name)


def _ref_rel(c: Check) -> str:
    return f"{'silver' if c.ref_layer == 'silver' else c.ref_layer}_{c.ref_table}"


Report = list[tuple[str, str, str, list[Check]]]


#: relations that a join makes; the others are projections of one table, which every pass can read anew
_JOINED = ("gold_fato_pedidos_itens", "gold_fato_itens_dup_header")
#: check kinds that share one aggregate over the relation
_FUSED = ("row_count_min", "not_null", "accepted_values", "range", "cast_audit")


def _passes(checks: list[Check]) -> int:
    """How often a report reads a relation: once for all fused checks, and once for each of the others."""
    return any(c.kind in _FUSED for c in checks) + sum(c.kind not in _FUSED for c in checks)


def _report_frame(spark: SparkSession, sf_dir: str, report: Report, dirty: bool = False) -> DataFrame:
    """The report's rows. A joined relation that several passes read is written once below the checkpoint folder, with
    the checked columns alone; a relation that is read once or twice, or is a projection, is never copied."""
    L = Layers(spark, sf_dir, dirty)
    plain: dict[str, DataFrame] = {}

    def relation(rel: str) -> DataFrame:
        if rel not in plain:
            plain[rel] = _relation(L, rel)
        return plain[rel]

    parts = []
    for layer, table, rel, checks in report:
        refs = {f"{c.ref_layer}/{c.ref_table}": relation(_ref_rel(c)) for c in checks if c.ref_table}
        df = relation(rel)
        if rel in _JOINED and _passes(checks) > 2:
            df = materialize(df.select(*sorted({c for check in checks for c in check.columns})), rel)
        frame = dq.check_frame(df, checks, layer, table, refs)
        parts.append(frame.select("layer", "table_name", "check", "passed", "violations"))
    return reduce(DataFrame.unionByName, parts)


def _report_sql(report: Report) -> str:
    return "\nUNION ALL\n".join(
        check_sql(c, rel, layer, table, _ref_rel(c) if c.ref_table else None)
        for layer, table, rel, checks in report for c in checks)


def _register_report(name: str, report: Report, sql: str | None = None, dirty: bool = False) -> None:
    def q(spark, sf_dir):
        return _report_frame(spark, sf_dir, report, dirty)
    q.__name__ = name
    register(name, sql or _report_sql(report), dirty)(q)


_nn = lambda *cols: [Check("not_null", (c,)) for c in cols]
_rng = lambda col, lo, hi: Check("range", (col,), lo=lo, hi=hi)

_register_report("dq_row_count_min", [
    ("bronze", t.name, f"raw_{t.name}", [Check("row_count_min", minimum=1)]) for t in TABLES
] + [("bronze", "category_name", "raw_category_name", [Check("row_count_min", minimum=10)])])

_register_report("dq_not_null", [
    ("silver", "orders", "silver_orders", _nn(*SILVER_COLUMNS["orders"])),
    ("silver", "reviews", "silver_reviews", _nn("review_comment_title", "review_comment_message")),
])

_register_report("dq_unique", [
    ("silver", "customers", "silver_customers", [Check("unique", ("customer_id",)),
                                                 Check("unique", ("customer_unique_id",))]),
    ("silver", "items", "silver_items", [Check("unique", ("order_id", "order_item_id"))]),
    ("silver", "payments", "silver_payments", [Check("unique", ("order_id",))]),
    ("silver", "geolocation", "silver_geolocation", [Check("unique", ("geolocation_zip_code_prefix",))]),
    ("gold", "dim_tempo", "gold_dim_tempo", [Check("unique", ("data",))]),
])

_register_report("dq_accepted_values", [
    ("silver", "orders", "silver_orders", [Check("accepted_values", ("order_status",), values=ORDER_STATUSES)]),
    ("silver", "payments", "silver_payments",
     [Check("accepted_values", ("payment_type",), values=("credit_card", "boleto", "debit_card"))]),
    ("silver", "reviews", "silver_reviews",
     [Check("accepted_values", ("review_comment_title",), values=("1-URGENT", "2-HIGH"))]),
])

_register_report("dq_range", [
    ("silver", "items", "silver_items", [_rng("price", 0, None), _rng("freight_value", 0, None)]),
    ("silver", "reviews", "silver_reviews", [_rng("review_score", 1, 5)]),
    ("silver", "payments", "silver_payments", [_rng("payment_installments", 1, 7)]),
    ("gold", "fato_pedidos_itens", "gold_fato_pedidos_itens",
     [_rng("prazo_entrega_dias", 0, None), _rng("atraso_entrega_dias", None, 0)]),
    ("gold", "fato_avaliacoes", "gold_fato_avaliacoes", [_rng("dias_ate_resposta", 0, 5)]),
])

_register_report("dq_row_count_equals_source", [
    ("gold", "fato_pedidos_itens", "gold_fato_pedidos_itens", [Check("row_count_equals_source", ref_table="items")]),
    ("gold", "fato_pagamentos", "gold_fato_pagamentos", [Check("row_count_equals_source", ref_table="payments")]),
    ("gold", "fato_avaliacoes", "gold_fato_avaliacoes", [Check("row_count_equals_source", ref_table="reviews")]),
    ("gold", "fato_itens_dup_header", "gold_fato_itens_dup_header",
     [Check("row_count_equals_source", ref_table="items")]),
])

_register_report("dq_referential", [
    ("gold", "fato_pedidos_itens", "gold_fato_pedidos_itens", [
        Check("referential", ("product_id",), ref_table="products"),
        Check("referential", ("seller_id",), ref_table="sellers"),
        Check("referential", ("customer_id",), ref_table="customers"),
        Check("referential", ("data_pedido",), ref_table="dim_tempo", ref_layer="gold", ref_column="data"),
        Check("referential", ("order_id",), ref_table="reviews"),
    ]),
    ("gold", "fato_avaliacoes", "gold_fato_avaliacoes", [Check("referential", ("order_id",), ref_table="items")]),
])

_CAST_TYPES = {to_int: "int", to_double: "double", to_ts: "timestamp_ntz"}
_register_report("dq_cast_audit", [
    ("bronze", t, f"raw_{t}", [Check("cast_audit", (c,), cast_type=_CAST_TYPES[f])
                               for c, f in rules.items() if f in _CAST_TYPES])
    for t, rules in SILVER_RULES.items() if any(f in _CAST_TYPES for f in rules.values())
], dirty=True)

# the declared suites over the faulty tables; their oracles list the 55 checks on their own
for _layer, _prefix in (("bronze", "raw"), ("silver", "silver"), ("gold", "gold")):
    _register_report(f"dq_suite_{_layer}", [(_layer, t, f"{_prefix}_{t}", checks) for t, checks in CHECKS[_layer].items()],
                     suite_sql(_layer), dirty=True)


@register("dq_accepted_values_offenders", """
SELECT 'silver' AS layer, 'customers' AS table_name, 'accepted_values:customer_city' AS "check", customer_city AS value, count(*) AS rows
FROM silver_customers WHERE customer_city NOT IN ('city of brazil', 'city of france') GROUP BY customer_city
UNION ALL
SELECT 'silver', 'orders', 'accepted_values:order_status', order_status, count(*) FROM silver_orders
WHERE order_status NOT IN ('delivered', 'shipped', 'canceled', 'unavailable', 'invoiced', 'processing', 'created', 'approved') GROUP BY order_status
""", dirty=True)
def dq_accepted_values_offenders(spark, sf_dir):
    L = Layers(spark, sf_dir, dirty=True)
    cities = Check("accepted_values", ("customer_city",), values=("city of brazil", "city of france"))
    return dq.offenders(L.silver("customers"), [cities], "silver", "customers").unionByName(
        dq.offenders(L.silver("orders"), CHECKS["silver"]["orders"], "silver", "orders"))


# ------------------------------------------------------------------ checksum and manifest (DQ-10, SNK-3)

@register("dq_checksum", CHECKSUM_SQL)
def dq_checksum(spark, sf_dir):
    """Rows and portable checksum of every Silver table, one aggregate over one scan each."""
    L = Layers(spark, sf_dir)
    return reduce(DataFrame.unionByName, [
        L.silver(t).agg(F.count(F.lit(1)).alias("linhas"), portable_checksum(L.silver(t), SILVER_COLUMNS[t]).alias("checksum"))
        .select(F.lit(t).alias("table_name"), "linhas", "checksum") for t in SILVER_RULES])


@register("dq_manifest", MANIFEST_SQL)
def dq_manifest(spark, sf_dir):
    """What the audit row of each Silver table says about its columns and rows."""
    L = Layers(spark, sf_dir)
    parts = []
    for t in SILVER_RULES:
        df = L.silver(t).select(*SILVER_COLUMNS[t])
        parts.append(df.agg(F.count(F.lit(1)).alias("linhas")).select(
            F.lit("silver").alias("layer"), F.lit(t).alias("table_name"), "linhas", F.lit(",".join(schema_strings(df))).alias("colunas")))
    return reduce(DataFrame.unionByName, parts)


_PLANTED = {
    "reordered": lambda df, c: df.orderBy(F.desc(c)).repartition(7),
    "one cell": lambda df, c: df.withColumn(c, F.when(F.col(c) == F.lit(df.agg(F.min(c)).first()[0]), F.concat(c, F.lit("x"))).otherwise(F.col(c))),
    "a cell is null": lambda df, c: df.withColumn(c, F.when(F.col(c) != F.lit(df.agg(F.min(c)).first()[0]), F.col(c))),
    "a row is gone": lambda df, c: df.where(F.col(c) != F.lit(df.agg(F.min(c)).first()[0])),
    "a row comes twice": lambda df, c: df.unionByName(df.where(F.col(c) == F.lit(df.agg(F.min(c)).first()[0]))),
    "columns exchanged": lambda df, c: df.withColumns({c: F.col("seller_city"), "seller_city": F.col(c)}),
}


@register("dq_content_checksum", "\nUNION ALL\n".join(
    f"SELECT '{case}' AS \"case\", {'true' if case == 'reordered' else 'false'} AS equal, count(*) > 0 AS any_row FROM silver_sellers" for case in _PLANTED) + """
UNION ALL SELECT 'known hash', true, count(*) > 0 FROM silver_sellers
UNION ALL SELECT 'nulls keep their place', true, count(*) > 0 FROM silver_sellers""")
def dq_content_checksum(spark, sf_dir):
    """AGG-3, FN-13, DQ-10: the checksum that audit rows carry, over a table and over copies of it with one planted
    change each; and two known answers of the row hash, stated as constants."""
    sellers = Layers(spark, sf_dir).silver("sellers").select(*SILVER_COLUMNS["sellers"])

    def total(df: DataFrame):
        return df.agg(checksum_agg(sellers.columns).alias("x"), F.count(F.lit(1)).alias("n")).first()

    whole = total(sellers)
    rows = [(case, total(plant(sellers, "seller_id"))["x"] == whole["x"], whole["n"] > 0) for case, plant in _PLANTED.items()]
    # fixed values: the documented hash of ('Spark', array(123), 2)
    known = spark.range(1).select(row_hash([F.lit("Spark"), F.array(F.lit(123)), F.lit(2)], compat=True).alias("h"),
                                  row_hash([F.lit("a"), F.lit(None).cast("string")]).alias("an"), row_hash([F.lit(None).cast("string"), F.lit("a")]).alias("na")).first()
    rows += [("known hash", known["h"] == 5602566077635097486, whole["n"] > 0), ("nulls keep their place", known["an"] != known["na"], whole["n"] > 0)]
    return spark.createDataFrame(rows, "case string, equal boolean, any_row boolean")


# ------------------------------------------------------------------ landing and jobs, over written files
# Each query makes a landing zone and a lake below the session's checkpoint folder.

RUN_TS = dt.datetime(2024, 3, 1, 12, 0, 0)
_LANDED = ("customers", "sellers", "geolocation")


def _zone(spark: SparkSession) -> jobs.LakePaths:
    root = fresh_folder(spark, "zone")
    return jobs.LakePaths(f"{root}/landing", f"{root}/lake")


def _land(spark: SparkSession, sf_dir: str, paths: jobs.LakePaths, tables=_LANDED) -> Layers:
    """Two drops: an older one with other columns and fewer rows, and the newest, written twice."""
    L = Layers(spark, sf_dir)
    for t in tables:
        first = L.raw(t).columns[0]
        jobs.land_tables({t: L.raw(t).where(F.length(first) % 2 == 0).withColumn("antiga", F.lit("x"))}, paths.landing, "2024-01-31")
    for _ in range(2):
        jobs.land_tables({t: L.raw(t) for t in tables}, paths.landing, "2024-02-29")
    return L


@register("src_landing_latest", "SELECT * FROM silver_sellers")
def src_landing_latest(spark, sf_dir):
    """SRC-1/3, FLT-5: only the newest drop, as strings, through the Silver rule."""
    paths = _zone(spark)
    _land(spark, sf_dir, paths, ("sellers",))
    return to_silver("sellers", landing.read_landing_latest(spark, paths.landing, table_spec("sellers"))[0])


@register("sink_landing", """
SELECT 'sellers' AS table_name, '2024-01-31' AS ingestion_date, CAST(count_if(length(seller_id) % 2 = 0) AS BIGINT) AS linhas, true AS antiga FROM raw_sellers
UNION ALL SELECT 'sellers', '2024-02-29', count(*), false FROM raw_sellers
UNION ALL SELECT 'customers', '2024-01-31', CAST(count_if(length(customer_id) % 2 = 0) AS BIGINT), true FROM raw_customers
UNION ALL SELECT 'customers', '2024-02-29', count(*), false FROM raw_customers""")
def sink_landing(spark, sf_dir):
    """SNK-2: a drop that is written again replaces its own date only."""
    paths = _zone(spark)
    _land(spark, sf_dir, paths, ("sellers", "customers"))
    parts = []
    for t in ("sellers", "customers"):
        for d in landing.landed_dates(spark, paths.landing, t):
            df = landing.read_landing(spark, paths.landing, table_spec(t), d)
            parts.append(df.agg(F.count(F.lit(1)).alias("linhas")).select(
                F.lit(t).alias("table_name"), F.lit(d).alias("ingestion_date"), "linhas", F.lit("antiga" in df.columns).alias("antiga")))
    return reduce(DataFrame.unionByName, parts)


@register("src_multiline_rows", """
SELECT count(*) + 2 * count(review_comment_message) AS linhas_ingenuas, count(*) AS linhas,
       count(review_comment_message) AS com_comentario FROM raw_reviews""")
def src_multiline_rows(spark, sf_dir):
    """SRC-2, QRY-14: reviews with line breaks and quotes inside a field, read by line and as declared."""
    paths, L = _zone(spark), Layers(spark, sf_dir)
    text = F.concat(F.lit('first, "quoted"\nsecond\n'), "review_comment_message")
    jobs.land_tables({"reviews": L.raw("reviews").withColumn("review_comment_message", text)}, paths.landing, "2024-02-29")
    plain = landing.csv_reader(spark).csv(f"{landing.landing_path(paths.landing, 'reviews')}/ingestion_date=2024-02-29")
    declared = landing.read_landing(spark, paths.landing, table_spec("reviews"), "2024-02-29")
    whole = F.col("review_comment_message").contains("second\n")
    none = F.lit(None).cast("bigint")
    both = plain.agg(F.count(F.lit(1)).alias("linhas_ingenuas"), F.first(none).alias("linhas"), F.first(none).alias("com_comentario")).unionByName(
        declared.agg(F.first(none).alias("linhas_ingenuas"), F.count(F.lit(1)).alias("linhas"), F.count_if(whole).alias("com_comentario")))
    return both.agg(*(F.max(c).alias(c) for c in both.columns))


def _run_layers(spark: SparkSession, sf_dir: str, dirty: bool = False) -> jobs.LakePaths:
    """landing -> bronze -> silver -> gold for all nine tables and seven Gold objects, gated. Every query makes a run of its
    own: its rows and its cost are those of the tables as they are, whatever ran before it in the application. Over tables
    with faults the run stops at the gate."""
    paths, L = _zone(spark), Layers(spark, sf_dir, dirty)
    raw = {t.name: L.raw(t.name) for t in TABLES}
    if dirty:  # its fault is to have no row, and a drop that lacks a table stops a run before any gate
        raw["category_name"] = Layers(spark, sf_dir).raw("category_name")
    jobs.land_tables(raw, paths.landing, "2024-02-29", max_parallel=4)
    try:
        jobs.run_all(spark, paths, run_ts=RUN_TS, max_parallel=4, log=None)
    except jobs.LayerGateError:
        if not dirty:
            raise
    return paths


def _audit_sql(layer: str, table: str, rel: str, columns: str, day: str) -> str:
    checks = sum(t == table for t, *_ in SUITES[layer])
    return (f"SELECT '{layer}' AS layer, '{table}' AS table_name, count(*) AS rows, '{columns}' AS columns, {checks} AS checks, true AS passed, "
            f"true AS published, {day} AS source_partition FROM {rel}")


_BRONZE_STAMP, _SILVER_STAMP, _GOLD_STAMP = (f"{c}:timestamp" for c in ("data_processamento_bronze", "dt_criacao_silver", "dt_criacao_gold"))
_AUDIT = "\nUNION ALL\n".join([
    *(_audit_sql("bronze", t, f"raw_{t}", ",".join(c.split(":")[0] + ":string" for c in cols.split(",")) + f",{_BRONZE_STAMP}", "'2024-02-29'") for t, cols in RAW_MANIFEST.items()),
    *(_audit_sql("silver", t, f"silver_{t}", f"{cols},{_BRONZE_STAMP},{_SILVER_STAMP}", "NULL") for t, cols in RAW_ORDER_MANIFEST.items()),
    *(_audit_sql("gold", t, f"gold_{t}", cols.replace("dt_criacao_gold", _GOLD_STAMP), "NULL") for t, cols in GOLD_MANIFEST.items())])


@register("job_audit", _AUDIT)
def job_audit(spark, sf_dir):
    """SNK-3, JOB-1..3: every audit row of a whole run, read back."""
    audit = layers.read_audit(spark, _run_layers(spark, sf_dir).lake)
    return audit.select("layer", "table_name", "rows", F.array_join("columns", ",").alias("columns"), F.size("checks").alias("checks"), "passed", "published", "source_partition")


@register("job_gate", "SELECT layer, table_name, bool_and(passed) AS passed, bool_and(passed) AS published, CAST(count_if(NOT passed) AS BIGINT) AS failed_checks FROM (\n"
          + suite_sql("bronze") + "\nUNION ALL\n" + suite_sql("silver") + ") AS c WHERE table_name <> 'category_name' GROUP BY layer, table_name\n"
          "UNION ALL SELECT unnest(['bronze', 'silver']), 'category_name', true, true, 0", dirty=True)
def job_gate(spark, sf_dir):
    """JOB-4: over tables with faults, what fails is not published and no Gold object is tried."""
    audit = layers.read_audit(spark, _run_layers(spark, sf_dir, dirty=True).lake)
    failed = F.size(F.filter("checks", lambda c: ~c["passed"])).cast("long")
    return audit.select("layer", "table_name", "passed", "published", failed.alias("failed_checks"))


@register("job_layers", "SELECT *, TIMESTAMP '2024-03-01 12:00:00' AS dt_criacao_gold FROM gold_dim_cliente")
def job_layers(spark, sf_dir):
    """SRC-4, SNK-1, PRJ-4, JOB-4: a published dimension, with the run's stamp."""
    dim = layers.read_layer(spark, _run_layers(spark, sf_dir).lake, "gold", "dim_cliente")
    return dim.withColumn("dt_criacao_gold", F.col("dt_criacao_gold").cast("timestamp_ntz"))


@register("job_fact", "SELECT *, CAST(date_trunc('month', data_pedido) AS DATE) AS data_pedido_mes FROM gold_fato_pedidos_itens")
def job_fact(spark, sf_dir):
    """SRC-4, SNK-1: the published item fact, with the layout column of its month."""
    return layers.read_layer(spark, _run_layers(spark, sf_dir).lake, "gold", "fato_pedidos_itens").drop("dt_criacao_gold")


@register("src_layers", "\nUNION ALL\n".join(f"SELECT '{t}' AS table_name, count(*) AS linhas, {len(cols.split(',')) + 2} AS colunas FROM silver_{t}" for t, cols in MANIFEST.items()))
def src_layers(spark, sf_dir):
    """SRC-5: all tables of a layer at once."""
    silver = layers.read_layers(spark, _run_layers(spark, sf_dir).lake, "silver", [t.name for t in TABLES])
    return reduce(DataFrame.unionByName, [
        df.agg(F.count(F.lit(1)).alias("linhas")).select(F.lit(t).alias("table_name"), "linhas", F.lit(len(df.columns)).alias("colunas"))
        for t, df in silver.items()])


@register("job_stamp", "SELECT 'sellers' AS table_name, count(*) AS linhas, CAST(1 AS BIGINT) AS carimbos, true AS no_intervalo FROM silver_sellers")
def job_stamp(spark, sf_dir):
    """FN-11: without a given time a run stamps its rows with the time it had, one for all of them."""
    paths = _zone(spark)
    _land(spark, sf_dir, paths, ("sellers",))
    before = dt.datetime.now(dt.timezone.utc)
    jobs.bronze_job(spark, paths, "sellers", log=None)
    after = dt.datetime.now(dt.timezone.utc)
    stamp = F.col(jobs.STAMP["bronze"])
    lo, hi = (F.lit(t.isoformat()).cast("timestamp") for t in (before, after))
    return layers.read_layer(spark, paths.lake, "bronze", "sellers").agg(
        F.lit("sellers").alias("table_name"), F.count(F.lit(1)).alias("linhas"), F.count_distinct(stamp).alias("carimbos"), F.bool_and(stamp.between(lo, hi)).alias("no_intervalo"))


@register("dq_run_comparison", """
WITH n AS (SELECT count(*) AS c FROM silver_sellers)
SELECT 1 AS run, true AS passed, true AS published, c AS rows, CAST(NULL AS BIGINT) AS previous_rows, CAST(NULL AS BOOLEAN) AS unchanged FROM n
UNION ALL SELECT 2, false, false, c + 1, c, false FROM n
UNION ALL SELECT 3, true, true, c, c, true FROM n
UNION ALL SELECT 4, true, true, (SELECT count(*) FROM silver_sellers WHERE seller_state <> 'BRAZIL'), c,
  (SELECT count(*) FROM silver_sellers WHERE seller_state = 'BRAZIL') = 0 FROM n""")
def dq_run_comparison(spark, sf_dir):
    """DQ-11: a failed run is compared with the published one before it, and no later run with it."""
    paths, good = _zone(spark), Layers(spark, sf_dir).silver("sellers")
    nobody = good.limit(1).withColumn("seller_id", F.lit(None).cast("string"))
    for i, df in enumerate((good, good.unionByName(nobody), good, good.where("seller_state <> 'BRAZIL'")), 1):
        jobs.stage_validate_publish(spark, paths, "silver", "sellers", df, f"{i}", log=None)
    runs = layers.compare_runs(layers.read_audit(spark, paths.lake))
    return runs.select(F.col("run_id").cast("int").alias("run"), "passed", "published", "rows", "previous_rows", "unchanged")


# queries over versions of tables and along time are in modules of their own
from lakestrata.plans import catalog_time, catalog_versions  # noqa: E402,F401
