"""Silver rules on generated raw rows: every column of every table is held against a plain Python cleaning of
the same cell."""

import datetime as dt
import random

import pytest

from lakestrata.operators.silver import to_silver

# table -> column kinds: i id, t text, c code, n int, d double, s timestamp
TABLES = {
    "customers": "customer_id:i customer_unique_id:i customer_zip_code_prefix:i customer_city:t customer_state:c",
    "orders": "order_id:i customer_id:i order_status:t order_purchase_timestamp:s order_approved_at:s order_delivered_carrier_date:s "
              "order_delivered_customer_date:s order_estimated_delivery_date:s",
    "items": "order_id:i order_item_id:n product_id:i seller_id:i shipping_limit_date:s price:d freight_value:d",
    "payments": "order_id:i payment_sequential:n payment_type:t payment_installments:n payment_value:d",
    "reviews": "review_id:i order_id:i review_score:n review_comment_title:i review_comment_message:i review_creation_date:s review_answer_timestamp:s",
    "products": "product_id:i product_category_name:t product_name_lenght:n product_description_lenght:n product_photos_qty:n product_weight_g:d "
                "product_length_cm:d product_height_cm:d product_width_cm:d",
    "sellers": "seller_id:i seller_zip_code_prefix:i seller_city:t seller_state:c",
    "geolocation": "geolocation_zip_code_prefix:i geolocation_lat:d geolocation_lng:d geolocation_city:t geolocation_state:c",
    "category_name": "product_category_name:t product_category_name_english:t",
}
TYPES = {"i": "string", "t": "string", "c": "string", "n": "int", "d": "double", "s": "timestamp_ntz"}
WORDS = ["Ärger", "ÇA va", "x", "", "00712", "\ttab", "a  b", "ÉTÉ", "ünï"]
NUMBERS = ["7", "-3", " 12 ", "1e3", "5.25", "-0.5", "12,5", "", "seven", "0x1f", "99999999999"]
TIMES = ["2021-03-04 05:06:07", "1999-12-31", "2020-02-30", "soon", "", "2021-03-04T05:06:07", " 2022-01-01 00:00:00 "]


def clean(kind, cell):
    if cell is None:
        return None
    if kind in "itc":
        text = cell.strip(" ")
        return text.lower() if kind == "t" else text.upper() if kind == "c" else text
    text = cell.strip()
    try:
        if kind == "n":
            value = int(text)
            return value if -2**31 <= value < 2**31 else None
        if kind == "d":
            return float(text)
        return dt.datetime.fromisoformat(text)
    except ValueError:
        return None


def cell(rnd, kind):
    if rnd.random() < 0.15:
        return None
    pool = {"n": [x for x in NUMBERS if "." not in x and "e" not in x], "d": [x for x in NUMBERS if "x" not in x], "s": TIMES}.get(kind, WORDS)
    return " " * rnd.randrange(3) + rnd.choice(pool) + " " * rnd.randrange(2)


@pytest.mark.parametrize("table", sorted(TABLES))
def test_every_cell(spark, ansi, table):
    rnd = random.Random(table)
    columns = [c.split(":") for c in TABLES[table].split()]
    rows = [tuple(cell(rnd, k) for _, k in columns) for _ in range(40)]
    out = to_silver(table, spark.createDataFrame(rows, ", ".join(f"{c} string" for c, _ in columns)))
    assert out.dtypes == [(c, TYPES[k]) for c, k in columns]
    want = [tuple(clean(k, x) for (_, k), x in zip(columns, r)) for r in rows]
    want = set(want) if table == "geolocation" else want
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, want))


def test_copies_fold_after_cleaning(spark):
    """Rows that differ in blanks and case only are one row; another coordinate is another one."""
    columns = [c.split(":")[0] for c in TABLES["geolocation"].split()]
    base = ("0900", "1.5", "2.5", "Köln", "nw")
    rows = [base, base, (" 0900", "1.50", "2.5 ", " KÖLN", "NW "), ("0900", "1.6", "2.5", "Köln", "nw")]
    assert to_silver("geolocation", spark.createDataFrame(rows, columns)).count() == 2


def test_other_columns_pass_through(spark):
    columns = [c.split(":")[0] for c in TABLES["sellers"].split()] + ["data_processamento_bronze"]
    out = to_silver("sellers", spark.createDataFrame([(" a", " 1", "B", "c", " stamp ")], columns))
    assert out.collect()[0]["data_processamento_bronze"] == " stamp "


def test_unknown_table(spark):
    with pytest.raises(ValueError):
        to_silver("nothing", spark.range(1))
