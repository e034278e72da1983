"""Silver rules (bronze strings → typed, trimmed, case-normalised columns).

Each rule is a map ``column -> expression`` applied as ONE projection (``withColumns``), so a rule
never grows the plan by a chain of projects and never shuffles. Rules only overwrite columns; other
columns (e.g. the Bronze processing stamp) pass through. Geolocation is the one rule that also
de-duplicates: after cleaning, so copies that differ only in case or blanks collapse too. The
de-duplication is a hash aggregate with a map-side partial step, so even a zip prefix holding a third
of all rows is collapsed inside each map task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame

from lakestrata.functions.clean import clean_code, clean_id, clean_text, to_double, to_int, to_ts

Expr = Callable[[str], Column]

# ---- fixed values: per table, the columns each cleaning expression applies to (source column names,
# including the source dataset's own "lenght" spelling) ----------------------------------------------
SILVER_RULES: dict[str, dict[str, Expr]] = {
    "customers": {
        "customer_id": clean_id, "customer_unique_id": clean_id, "customer_zip_code_prefix": clean_id,
        "customer_city": clean_text, "customer_state": clean_code,
    },
    "orders": {
        "order_id": clean_id, "customer_id": clean_id, "order_status": clean_text,
        "order_purchase_timestamp": to_ts, "order_approved_at": to_ts,
        "order_delivered_carrier_date": to_ts, "order_delivered_customer_date": to_ts,
        "order_estimated_delivery_date": to_ts,
    },
    "items": {
        "order_id": clean_id, "order_item_id": to_int, "product_id": clean_id, "seller_id": clean_id,
        "shipping_limit_date": to_ts, "price": to_double, "freight_value": to_double,
    },
    "payments": {
        "order_id": clean_id, "payment_sequential": to_int, "payment_type": clean_text,
        "payment_installments": to_int, "payment_value": to_double,
    },
    "reviews": {
        "review_id": clean_id, "order_id": clean_id, "review_score": to_int,
        "review_comment_title": clean_id, "review_comment_message": clean_id,
        "review_creation_date": to_ts, "review_answer_timestamp": to_ts,
    },
    "products": {
        "product_id": clean_id, "product_category_name": clean_text,
        "product_name_lenght": to_int, "product_description_lenght": to_int, "product_photos_qty": to_int,
        "product_weight_g": to_double, "product_length_cm": to_double, "product_height_cm": to_double,
        "product_width_cm": to_double,
    },
    "sellers": {
        "seller_id": clean_id, "seller_zip_code_prefix": clean_id, "seller_city": clean_text,
        "seller_state": clean_code,
    },
    "geolocation": {
        "geolocation_zip_code_prefix": clean_id, "geolocation_lat": to_double, "geolocation_lng": to_double,
        "geolocation_city": clean_text, "geolocation_state": clean_code,
    },
    "category_name": {
        "product_category_name": clean_text, "product_category_name_english": clean_text,
    },
}

# Silver column order per table = the rule's declaration order (the source file's column order).
SILVER_COLUMNS: dict[str, list[str]] = {t: list(r) for t, r in SILVER_RULES.items()}

# Tables whose rule ends with a full-content de-duplication.
DEDUP_TABLES = frozenset({"geolocation"})


def rule_for(table: str) -> Callable[[DataFrame], DataFrame]:
    if table not in SILVER_RULES:
        raise ValueError(f"no Silver rule for {table!r}; known: {sorted(SILVER_RULES)}")

    def apply(df: DataFrame) -> DataFrame:
        exprs = SILVER_RULES[table]
        out = df.withColumns({c: f(c) for c, f in exprs.items()})
        if table in DEDUP_TABLES:
            out = out.dropDuplicates(list(exprs))
        return out

    apply.__name__ = f"silver_{table}"
    return apply


def to_silver(table: str, df: DataFrame) -> DataFrame:
    return df.transform(rule_for(table))

