"""DuckDB oracle SQL for every registered query (the correctness gate).

Only the driver's base tables exist as views, so each oracle inlines the raw frames (FIXTURES.md),
the Silver rules and the Gold builders as CTEs and then states the query in plain SQL. Dialect
notes: DuckDB ``year()``/``datediff`` return BIGINT and ``sum(int)`` HUGEINT, so results are cast to
Spark's types; DuckDB's ``dayofweek`` is 0-based (Sunday = 0), Spark's is 1-based.
"""

from __future__ import annotations

from lakestrata.operators.silver import SILVER_COLUMNS
from lakestrata.sources.adapter import DIRT, dirty_select
from lakestrata.specs import Check

RAW_CTES = {
    "raw_customers": """
SELECT '  ' || c_custkey || ' ' AS customer_id, ' u' || ((c_custkey * 9) // 10) AS customer_unique_id,
       ' ' || lpad('' || c_nationkey, 5, '0') AS customer_zip_code_prefix,
       '  City Of ' || n_name || ' ' AS customer_city, ' ' || lower(n_name) || ' ' AS customer_state
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "raw_orders": """
SELECT ' ' || o_orderkey AS order_id, o_custkey || ' ' AS customer_id,
       CASE o_orderstatus WHEN 'F' THEN ' DELIVERED ' WHEN 'O' THEN 'Shipped' ELSE 'created' END AS order_status,
       CAST(o_orderdate AS VARCHAR) AS order_purchase_timestamp,
       CAST(o_orderdate + INTERVAL 1 DAY AS VARCHAR) AS order_approved_at,
       CASE WHEN o_orderstatus <> 'P' THEN CAST(mx AS VARCHAR) END AS order_delivered_carrier_date,
       CASE WHEN o_orderstatus = 'F' THEN CAST(mx AS VARCHAR) END AS order_delivered_customer_date,
       CAST(o_orderdate + INTERVAL 60 DAY AS VARCHAR) AS order_estimated_delivery_date
FROM orders LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS mx FROM lineitem GROUP BY l_orderkey) s
  ON o_orderkey = l_orderkey""",
    "raw_items": """
SELECT l_orderkey || ' ' AS order_id, '' || l_linenumber AS order_item_id,
       ' ' || l_partkey AS product_id, ' ' || l_suppkey AS seller_id,
       CAST(l_shipdate AS VARCHAR) AS shipping_limit_date,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS price,
       CAST(CAST(l_tax * 100 AS DECIMAL(18,2)) AS VARCHAR) AS freight_value
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                   ORDER BY l_partkey, l_suppkey, l_extendedprice, l_tax, l_shipdate) AS rn FROM lineitem)
WHERE rn = 1""",
    "raw_payments": """
SELECT l_orderkey || ' ' AS order_id,
       '' || row_number() OVER (PARTITION BY l_orderkey ORDER BY l_returnflag) AS payment_sequential,
       CASE l_returnflag WHEN 'A' THEN ' Credit_Card' WHEN 'N' THEN 'BOLETO ' ELSE 'voucher' END AS payment_type,
       '' || max(l_linenumber) AS payment_installments,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS VARCHAR) AS payment_value
FROM lineitem GROUP BY l_orderkey, l_returnflag""",
    "raw_reviews": """
SELECT ' r' || o_orderkey AS review_id, ' ' || o_orderkey AS order_id,
       substr(o_orderpriority, 1, 1) AS review_score,
       CASE WHEN o_orderkey % 3 = 0 THEN ' ' || o_orderpriority || ' ' END AS review_comment_title,
       CASE WHEN o_orderkey % 2 = 0 THEN ' status ' || o_orderstatus || ' ' END AS review_comment_message,
       CAST(o_orderdate AS VARCHAR) AS review_creation_date,
       CAST(o_orderdate + INTERVAL '1' DAY * (o_custkey % 10) AS VARCHAR) AS review_answer_timestamp
FROM orders""",
    "raw_products": """
SELECT ' ' || p_partkey AS product_id, ' ' || p_type || ' ' AS product_category_name,
       '' || length(p_name) AS product_name_lenght, '' || (length(p_name) * 10) AS product_description_lenght,
       '' || (p_partkey % 6) AS product_photos_qty, '' || (p_size * 100) AS product_weight_g,
       '' || p_size AS product_length_cm, '' || (p_size + 1) AS product_height_cm, '' || (p_size + 2) AS product_width_cm
FROM part""",
    "raw_sellers": """
SELECT ' ' || s_suppkey AS seller_id, lpad('' || s_nationkey, 5, '0') || ' ' AS seller_zip_code_prefix,
       '  City Of ' || n_name AS seller_city, lower(n_name) || ' ' AS seller_state
FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "raw_geolocation": """
SELECT lpad('' || c_nationkey, 5, '0') AS geolocation_zip_code_prefix,
       CAST(CAST(c_nationkey * -1.5 AS DECIMAL(9,2)) AS VARCHAR) AS geolocation_lat,
       CAST(CAST(c_nationkey * -2.5 AS DECIMAL(9,2)) AS VARCHAR) AS geolocation_lng,
       CASE WHEN c_custkey % 2 = 0 THEN ' City Of ' ELSE 'CITY OF ' END || n_name AS geolocation_city,
       ' ' || lower(n_name) AS geolocation_state
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "raw_category_name": """
SELECT DISTINCT p_type AS product_category_name, p_type || '_EN ' AS product_category_name_english
FROM part WHERE p_type <> 'PROMO'""",
}

SILVER_CTES = {
    "silver_customers": """
SELECT trim(customer_id) AS customer_id, trim(customer_unique_id) AS customer_unique_id,
       trim(customer_zip_code_prefix) AS customer_zip_code_prefix, lower(trim(customer_city)) AS customer_city,
       upper(trim(customer_state)) AS customer_state
FROM raw_customers""",
    "silver_orders": """
SELECT trim(order_id) AS order_id, trim(customer_id) AS customer_id, lower(trim(order_status)) AS order_status,
       TRY_CAST(order_purchase_timestamp AS TIMESTAMP) AS order_purchase_timestamp,
       TRY_CAST(order_approved_at AS TIMESTAMP) AS order_approved_at,
       TRY_CAST(order_delivered_carrier_date AS TIMESTAMP) AS order_delivered_carrier_date,
       TRY_CAST(order_delivered_customer_date AS TIMESTAMP) AS order_delivered_customer_date,
       TRY_CAST(order_estimated_delivery_date AS TIMESTAMP) AS order_estimated_delivery_date
FROM raw_orders""",
    "silver_items": """
SELECT trim(order_id) AS order_id, TRY_CAST(order_item_id AS INTEGER) AS order_item_id,
       trim(product_id) AS product_id, trim(seller_id) AS seller_id,
       TRY_CAST(shipping_limit_date AS TIMESTAMP) AS shipping_limit_date,
       TRY_CAST(price AS DOUBLE) AS price, TRY_CAST(freight_value AS DOUBLE) AS freight_value
FROM raw_items""",
    "silver_payments": """
SELECT trim(order_id) AS order_id, TRY_CAST(payment_sequential AS INTEGER) AS payment_sequential,
       lower(trim(payment_type)) AS payment_type, TRY_CAST(payment_installments AS INTEGER) AS payment_installments,
       TRY_CAST(payment_value AS DOUBLE) AS payment_value
FROM raw_payments""",
    "silver_reviews": """
SELECT trim(review_id) AS review_id, trim(order_id) AS order_id, TRY_CAST(review_score AS INTEGER) AS review_score,
       trim(review_comment_title) AS review_comment_title, trim(review_comment_message) AS review_comment_message,
       TRY_CAST(review_creation_date AS TIMESTAMP) AS review_creation_date,
       TRY_CAST(review_answer_timestamp AS TIMESTAMP) AS review_answer_timestamp
FROM raw_reviews""",
    "silver_products": """
SELECT trim(product_id) AS product_id, lower(trim(product_category_name)) AS product_category_name,
       TRY_CAST(product_name_lenght AS INTEGER) AS product_name_lenght,
       TRY_CAST(product_description_lenght AS INTEGER) AS product_description_lenght,
       TRY_CAST(product_photos_qty AS INTEGER) AS product_photos_qty,
       TRY_CAST(product_weight_g AS DOUBLE) AS product_weight_g, TRY_CAST(product_length_cm AS DOUBLE) AS product_length_cm,
       TRY_CAST(product_height_cm AS DOUBLE) AS product_height_cm, TRY_CAST(product_width_cm AS DOUBLE) AS product_width_cm
FROM raw_products""",
    "silver_sellers": """
SELECT trim(seller_id) AS seller_id, trim(seller_zip_code_prefix) AS seller_zip_code_prefix,
       lower(trim(seller_city)) AS seller_city, upper(trim(seller_state)) AS seller_state
FROM raw_sellers""",
    "silver_geolocation": """
SELECT DISTINCT trim(geolocation_zip_code_prefix) AS geolocation_zip_code_prefix,
       TRY_CAST(geolocation_lat AS DOUBLE) AS geolocation_lat, TRY_CAST(geolocation_lng AS DOUBLE) AS geolocation_lng,
       lower(trim(geolocation_city)) AS geolocation_city, upper(trim(geolocation_state)) AS geolocation_state
FROM raw_geolocation""",
    "silver_category_name": """
SELECT lower(trim(product_category_name)) AS product_category_name,
       lower(trim(product_category_name_english)) AS product_category_name_english
FROM raw_category_name""",
}

GOLD_CTES = {
    "gold_dim_cliente": """
SELECT customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, customer_state
FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY customer_unique_id NULLS FIRST,
             customer_zip_code_prefix NULLS FIRST, customer_city NULLS FIRST, customer_state NULLS FIRST) AS rn
      FROM silver_customers) WHERE rn = 1""",
    "gold_dim_vendedor": """
SELECT seller_id, seller_zip_code_prefix, seller_city, seller_state
FROM (SELECT *, row_number() OVER (PARTITION BY seller_id ORDER BY seller_zip_code_prefix NULLS FIRST,
             seller_city NULLS FIRST, seller_state NULLS FIRST) AS rn
      FROM silver_sellers) WHERE rn = 1""",
    "gold_dim_produto": """
SELECT p.product_category_name, p.product_id, p.product_weight_g, p.product_length_cm, p.product_height_cm,
       p.product_width_cm, c.product_category_name_english
FROM silver_products p LEFT JOIN silver_category_name c ON p.product_category_name = c.product_category_name""",
    "gold_dim_tempo": """
SELECT data, CAST(year(data) AS INTEGER) AS ano, CAST(month(data) AS INTEGER) AS mes,
       CAST(day(data) AS INTEGER) AS dia, CAST(quarter(data) AS INTEGER) AS trimestre,
       CAST(dayofweek(data) + 1 AS INTEGER) AS dia_semana
FROM (SELECT DISTINCT CAST(order_purchase_timestamp AS DATE) AS data FROM silver_orders
      WHERE order_purchase_timestamp IS NOT NULL)""",
    "gold_fato_pedidos_itens": """
SELECT i.order_id, i.order_item_id, i.product_id, i.seller_id, i.price, i.freight_value,
       o.customer_id, o.order_status, CAST(o.order_purchase_timestamp AS DATE) AS data_pedido,
       CAST(datediff('day', o.order_purchase_timestamp, o.order_delivered_customer_date) AS INTEGER) AS prazo_entrega_dias,
       CAST(datediff('day', o.order_estimated_delivery_date, o.order_delivered_customer_date) AS INTEGER) AS atraso_entrega_dias,
       datediff('day', o.order_estimated_delivery_date, o.order_delivered_customer_date) > 0 AS entregue_com_atraso
FROM silver_items i JOIN silver_orders o ON i.order_id = o.order_id""",
    "gold_fato_pagamentos": """
SELECT order_id, payment_sequential, payment_type, payment_installments, payment_value FROM silver_payments""",
    "gold_fato_avaliacoes": """
SELECT review_id, order_id, review_score, CAST(review_creation_date AS DATE) AS data_avaliacao,
       CAST(datediff('day', review_creation_date, review_answer_timestamp) AS INTEGER) AS dias_ate_resposta
FROM silver_reviews""",
}

# defect injection for the fan-out check: every 'created' order header appears twice
DEFECT_CTES = {
    "silver_orders_dup_header": """
SELECT * FROM silver_orders UNION ALL SELECT * FROM silver_orders WHERE order_status = 'created'""",
    "gold_fato_itens_dup_header": GOLD_CTES["gold_fato_pedidos_itens"].replace("silver_orders o",
                                                                               "silver_orders_dup_header o"),
}

ALL_CTES = {**RAW_CTES, **SILVER_CTES, **GOLD_CTES, **DEFECT_CTES}


def _dirty_ctes() -> dict[str, str]:
    """The raw tables with the faults of FIXTURES.md part C, over the clean ones."""
    out = {}
    for name, sql in RAW_CTES.items():
        table = name.removeprefix("raw_")
        dirt, columns = DIRT[table], SILVER_COLUMNS[table]
        rows = f"SELECT {', '.join(dirty_select(dirt, columns))} FROM clean_{table}"
        if dirt.repeat:
            rows += f" UNION ALL SELECT {', '.join(dirty_select(dirt, columns, second=True))} FROM clean_{table} WHERE {dirt.repeat}"
        out |= {f"clean_{table}": sql, name: f"SELECT * FROM ({rows}) AS t WHERE {dirt.where}" if dirt.where else rows}
    return out


def with_ctes(body: str, dirty: bool = False) -> str:
    """Prefix ``body`` with every layer CTE (DuckDB skips the unused ones); a body that starts with its own
    ``WITH`` continues the list. ``dirty``: over the raw tables with faults."""
    every = {**_dirty_ctes(), **SILVER_CTES, **GOLD_CTES, **DEFECT_CTES} if dirty else ALL_CTES
    ctes = ",\n".join(f"{name} AS ({sql.strip()}\n)" for name, sql in every.items())
    body = body.strip()
    if body[:4].upper() == "WITH":
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"


def MONEY(column: str) -> str:
    """An exact total of cents, as a double."""
    return f"CAST(sum(CAST({column} AS DECIMAL(18,2))) AS DOUBLE)"


def R(expr: str, digits: int) -> str:
    """Spark's ``round(double, d)``: HALF_UP on the shortest decimal representation of the double.
    DuckDB's own ``round`` works on the binary value and differs at ties (1.005 → 1.0, Spark 1.01)."""
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,12)), {digits}) AS DOUBLE)"


# ------------------------------------------------------------------------------------ checks

_DUCK_TYPES = {"int": "INTEGER", "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP", "bigint": "BIGINT"}


def _lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


def check_sql(c: Check, rel: str, layer: str, table: str, ref_rel: str | None = None) -> str:
    """One ``(layer, table_name, check, passed, violations)`` row for ``c`` over relation ``rel``."""
    k = c.kind
    if k == "row_count_min":
        v, src = f"greatest({c.minimum} - count(*), 0)", rel
    elif k == "not_null":
        v, src = f"count_if({c.column} IS NULL)", rel
    elif k == "accepted_values":
        vals = ", ".join(_lit(x) for x in c.values)
        v, src = f"count_if(NOT ({c.column} IN ({vals})))", rel
    elif k == "range":
        terms = ["0"]
        if c.lo is not None:
            terms.append(f"count_if({c.column} < {c.lo!r})")
        if c.hi is not None:
            terms.append(f"count_if({c.column} > {c.hi!r})")
        v, src = " + ".join(terms), rel
    elif k == "cast_audit":
        v = f"count_if({c.column} IS NOT NULL AND TRY_CAST({c.column} AS {_DUCK_TYPES[c.cast_type]}) IS NULL)"
        src = rel
    elif k == "unique":
        keys = ", ".join(c.columns)
        v, src = "coalesce(sum(n - 1), 0)", f"(SELECT count(*) AS n FROM {rel} GROUP BY {keys})"
    elif k == "row_count_equals_source":
        v = f"abs(count(*) - (SELECT count(*) FROM {ref_rel}))"
        src = rel
    elif k == "referential":
        col = c.column
        v = "count(*)"
        src = (f"(SELECT DISTINCT {col} FROM {rel}) a WHERE NOT EXISTS "
               f"(SELECT 1 FROM {ref_rel} b WHERE b.{c.ref_column or col} = a.{col})")
    else:
        raise ValueError(k)
    return (f"SELECT '{layer}' AS layer, '{table}' AS table_name, {_lit(c.name)} AS \"check\", "
            f"CAST({v} AS BIGINT) = 0 AS passed, CAST({v} AS BIGINT) AS violations FROM {src}")


# ---- the declared checks, stated here on their own: (table, check name, violation count, source) -------------
def _null(table: str, *cols: str) -> list[tuple[str, str, str, str]]:
    return [(table, f"not_null:{c}", f"count_if({c} IS NULL)", "") for c in cols]


def _once(table: str, *cols: str) -> tuple[str, str, str, str]:
    keys = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in cols)
    return (table, "unique:" + "+".join(cols), f"count(*) - count(DISTINCT ({keys}))", "")


def _from_zero(table: str, *cols: str) -> list[tuple[str, str, str, str]]:
    return [(table, f"range:{c}[0,None]", f"count_if({c} < 0)", "") for c in cols]


def _as_many(table: str, source: str) -> tuple[str, str, str, str]:
    return (table, f"row_count_equals_source:{source}", f"abs(count(*) - (SELECT count(*) FROM silver_{source}))", "")


def _known(table: str, col: str, ref: str) -> tuple[str, str, str, str]:
    return (table, f"referential:{col}->{ref}", "count(*)",
            f"(SELECT DISTINCT {col} FROM gold_{table} EXCEPT SELECT {col} FROM silver_{ref} WHERE {col} IS NOT NULL)")


_STATUS = "'delivered', 'shipped', 'canceled', 'unavailable', 'invoiced', 'processing', 'created', 'approved'"
_ITEMS = "fato_pedidos_itens"
SUITES: dict[str, list[tuple[str, str, str, str]]] = {
    "bronze": [(t, "row_count_min>=1", "CASE WHEN count(*) >= 1 THEN 0 ELSE 1 END", "") for t in (
        "customers", "orders", "items", "payments", "reviews", "products", "sellers", "geolocation", "category_name")],
    "silver": [
        *_null("customers", "customer_id", "customer_unique_id"), _once("customers", "customer_id"),
        *_null("orders", "order_id", "customer_id"), _once("orders", "order_id"),
        ("orders", "accepted_values:order_status", f"count_if(order_status NOT IN ({_STATUS}))", ""),
        *_null("items", "order_id", "product_id", "seller_id"), _once("items", "order_id", "order_item_id"),
        *_from_zero("items", "price", "freight_value"),
        *_null("payments", "order_id", "payment_type"), *_from_zero("payments", "payment_value"),
        *_null("reviews", "review_id", "order_id"),
        ("reviews", "range:review_score[1,5]", "count_if(review_score < 1 OR review_score > 5)", ""),
        *_null("products", "product_id"), _once("products", "product_id"),
        *_null("sellers", "seller_id"), _once("sellers", "seller_id"),
        *_null("geolocation", "geolocation_zip_code_prefix"), *_null("category_name", "product_category_name"),
    ],
    "gold": [
        _once("dim_cliente", "customer_id"), _once("dim_produto", "product_id"), _once("dim_vendedor", "seller_id"), _once("dim_tempo", "data"),
        *_null(_ITEMS, "order_id", "product_id", "seller_id", "customer_id"), _once(_ITEMS, "order_id", "order_item_id"),
        *_from_zero(_ITEMS, "price", "freight_value"), _as_many(_ITEMS, "items"),
        _known(_ITEMS, "product_id", "products"), _known(_ITEMS, "seller_id", "sellers"), _known(_ITEMS, "customer_id", "customers"),
        *_null("fato_pagamentos", "order_id"), *_from_zero("fato_pagamentos", "payment_value"), _as_many("fato_pagamentos", "payments"),
        *_null("fato_avaliacoes", "order_id"),
        ("fato_avaliacoes", "range:review_score[1,5]", "count_if(review_score < 1 OR review_score > 5)", ""), _as_many("fato_avaliacoes", "reviews"),
    ],
}


def suite_sql(layer: str) -> str:
    prefix = "raw" if layer == "bronze" else layer
    return "\nUNION ALL\n".join(
        f"SELECT '{layer}' AS layer, '{table}' AS table_name, '{name}' AS \"check\", CAST(coalesce({count}, 0) AS BIGINT) = 0 AS passed, "
        f"CAST(coalesce({count}, 0) AS BIGINT) AS violations FROM {source or f'{prefix}_{table}'}" for table, name, count, source in SUITES[layer])


# ---- the columns of Silver, stated here on their own ---------------------------------------------------------
MANIFEST = {
    "customers": "customer_id:string,customer_unique_id:string,customer_zip_code_prefix:string,customer_city:string,customer_state:string",
    "orders": "order_id:string,customer_id:string,order_status:string,order_purchase_timestamp:timestamp_ntz,order_approved_at:timestamp_ntz,"
              "order_delivered_carrier_date:timestamp_ntz,order_delivered_customer_date:timestamp_ntz,order_estimated_delivery_date:timestamp_ntz",
    "items": "order_id:string,order_item_id:int,product_id:string,seller_id:string,shipping_limit_date:timestamp_ntz,price:double,freight_value:double",
    "payments": "order_id:string,payment_sequential:int,payment_type:string,payment_installments:int,payment_value:double",
    "reviews": "review_id:string,order_id:string,review_score:int,review_comment_title:string,review_comment_message:string,"
               "review_creation_date:timestamp_ntz,review_answer_timestamp:timestamp_ntz",
    "products": "product_id:string,product_category_name:string,product_name_lenght:int,product_description_lenght:int,product_photos_qty:int,"
                "product_weight_g:double,product_length_cm:double,product_height_cm:double,product_width_cm:double",
    "sellers": "seller_id:string,seller_zip_code_prefix:string,seller_city:string,seller_state:string",
    "geolocation": "geolocation_zip_code_prefix:string,geolocation_lat:double,geolocation_lng:double,geolocation_city:string,geolocation_state:string",
    "category_name": "product_category_name:string,product_category_name_english:string",
}
MANIFEST_SQL = "\nUNION ALL\n".join(
    f"SELECT 'silver' AS layer, '{t}' AS table_name, count(*) AS linhas, '{cols}' AS colunas FROM silver_{t}" for t, cols in MANIFEST.items())

# ---- the columns of a run's audit rows: landing order for Bronze and Silver, Gold with its stamp and layout column ----
GOLD_MANIFEST = {
    "dim_cliente": "customer_id:string,customer_unique_id:string,customer_zip_code_prefix:string,customer_city:string,customer_state:string,dt_criacao_gold",
    "dim_produto": "product_category_name:string,product_id:string,product_weight_g:double,product_length_cm:double,product_height_cm:double,"
                   "product_width_cm:double,product_category_name_english:string,dt_criacao_gold",
    "dim_vendedor": "seller_id:string,seller_zip_code_prefix:string,seller_city:string,seller_state:string,dt_criacao_gold",
    "dim_tempo": "data:date,ano:int,mes:int,dia:int,trimestre:int,dia_semana:int,dt_criacao_gold",
    "fato_pedidos_itens": "order_id:string,order_item_id:int,product_id:string,seller_id:string,price:double,freight_value:double,customer_id:string,"
                          "order_status:string,data_pedido:date,prazo_entrega_dias:int,atraso_entrega_dias:int,entregue_com_atraso:boolean,dt_criacao_gold,data_pedido_mes:date",
    "fato_pagamentos": "order_id:string,payment_sequential:int,payment_type:string,payment_installments:int,payment_value:double,dt_criacao_gold",
    "fato_avaliacoes": "review_id:string,order_id:string,review_score:int,data_avaliacao:date,dias_ate_resposta:int,dt_criacao_gold,data_avaliacao_mes:date",
}
RAW_MANIFEST = RAW_ORDER_MANIFEST = MANIFEST


def _portable(column: str) -> str:
    name, kind = column.split(":")
    text = {"double": f"CAST(CAST({name} AS DECIMAL(18,2)) AS VARCHAR)", "timestamp_ntz": f"strftime({name}, '%Y-%m-%d %H:%M:%S')"}.get(
        kind, f"CAST({name} AS VARCHAR)")
    return f"coalesce({text}, '~')"


CHECKSUM_SQL = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS linhas, CAST(sum(CAST(('0x' || substr(md5(concat_ws('|', {', '.join(map(_portable, cols.split(',')))})), 1, 15)) "
    f"AS BIGINT)) % 9223372036854775807 AS BIGINT) AS checksum FROM silver_{t}" for t, cols in MANIFEST.items())
