"""Driver tables → the nine raw landing frames (all strings, deliberately dirty).

The driver's tables are TPC-H shaped; the reference's entities are an e-commerce dataset. Each raw
frame below is a projection/aggregation of the driver tables (the mapping is fixed in FIXTURES.md),
so everything downstream grows with the given data. Dirt (blanks, mixed case) is there on purpose so
the Silver rules have work to do.

Scale notes: line items are dealt by ranges of (order, line number) into parts that follow the table's size
(:data:`PART_BYTES`), so a task holds as much of them at any size, a large order is spread over its line numbers, and
an order's items stay together, which the files and exchanges after it compress better. ``payments``
is first aggregated to one row per (order, return flag), with a map-side partial step, and those rows meet by order in
as many parts. The nation lookups join a 25-row table that Spark broadcasts after its own size check.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakestrata.sources.files import file_system

#: bytes of the line item file to a part; a part's rows take some ten times that in memory
PART_BYTES = 4 << 20
DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
RAW_TABLES = ("customers", "orders", "items", "payments", "reviews", "products", "sellers", "geolocation",
              "category_name")


def read_driver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def driver_parts(spark: SparkSession, sf_dir: str, name: str) -> int:
    """How many parts the rows of a driver table are dealt into: one for each :data:`PART_BYTES` of its files."""
    path, fs = file_system(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")
    return max(1, -(-fs.getContentSummary(path).getLength() // PART_BYTES))


def _s(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _ts_text(c: str) -> F.Column:
    return F.col(c).cast("timestamp_ntz").cast("string")


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_driver(spark, sf_dir, "customer")
    n = read_driver(spark, sf_dir, "nation")
    j = c.join(n, c.c_nationkey == n.n_nationkey)
    return j.select(
        F.concat(F.lit("  "), _s("c_custkey"), F.lit(" ")).alias("customer_id"),
        F.concat(F.lit(" u"), _s(F.expr("(c_custkey * 9) div 10"))).alias("customer_unique_id"),
        F.concat(F.lit(" "), F.lpad(_s("c_nationkey"), 5, "0")).alias("customer_zip_code_prefix"),
        F.concat(F.lit("  City Of "), F.col("n_name"), F.lit(" ")).alias("customer_city"),
        F.concat(F.lit(" "), F.lower("n_name"), F.lit(" ")).alias("customer_state"),
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_driver(spark, sf_dir, "orders")
    last_ship = (read_driver(spark, sf_dir, "lineitem")
                 .groupBy("l_orderkey").agg(F.max("l_shipdate").alias("mx")))
    j = o.join(last_ship, o.o_orderkey == last_ship.l_orderkey, "left")
    od = F.col("o_orderdate").cast("timestamp_ntz")
    return j.select(
        F.concat(F.lit(" "), _s("o_orderkey")).alias("order_id"),
        F.concat(_s("o_custkey"), F.lit(" ")).alias("customer_id"),
        F.when(F.col("o_orderstatus") == "F", " DELIVERED ")
         .when(F.col("o_orderstatus") == "O", "Shipped").otherwise("created").alias("order_status"),
        _s(od).alias("order_purchase_timestamp"),
        _s(F.timestamp_add("DAY", F.lit(1), od)).alias("order_approved_at"),
        F.when(F.col("o_orderstatus") != "P", _ts_text("mx")).alias("order_delivered_carrier_date"),
        F.when(F.col("o_orderstatus") == "F", _ts_text("mx")).alias("order_delivered_customer_date"),
        _s(F.timestamp_add("DAY", F.lit(60), od)).alias("order_estimated_delivery_date"),
    )


def raw_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_driver(spark, sf_dir, "lineitem")
    # one item per order and line number, the smallest of the rows that share them; the ranges serve the aggregate, so
    # no order is gathered in one place to number its items
    li = li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_tax", "l_shipdate")
    li = li.repartitionByRange(driver_parts(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")
    rest = F.struct("l_partkey", "l_suppkey", "l_extendedprice", "l_tax", "l_shipdate")
    li = li.groupBy("l_orderkey", "l_linenumber").agg(F.min(rest).alias("i")).select("l_orderkey", "l_linenumber", "i.*")
    return li.select(
        F.concat(_s("l_orderkey"), F.lit(" ")).alias("order_id"),
        _s("l_linenumber").alias("order_item_id"),
        F.concat(F.lit(" "), _s("l_partkey")).alias("product_id"),
        F.concat(F.lit(" "), _s("l_suppkey")).alias("seller_id"),
        _ts_text("l_shipdate").alias("shipping_limit_date"),
        _s(F.col("l_extendedprice").cast("decimal(18,2)")).alias("price"),
        _s((F.col("l_tax") * 100).cast("decimal(18,2)")).alias("freight_value"),
    )


def raw_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_driver(spark, sf_dir, "lineitem")
    per_flag = li.groupBy("l_orderkey", "l_returnflag").agg(
        F.max("l_linenumber").alias("mx_line"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("value"),
    ).repartition(driver_parts(spark, sf_dir, "lineitem"), "l_orderkey")  # the window's exchange, in parts by size
    w = Window.partitionBy("l_orderkey").orderBy("l_returnflag")
    return per_flag.select(
        F.concat(_s("l_orderkey"), F.lit(" ")).alias("order_id"),
        _s(F.row_number().over(w)).alias("payment_sequential"),
        F.when(F.col("l_returnflag") == "A", " Credit_Card")
         .when(F.col("l_returnflag") == "N", "BOLETO ").otherwise("voucher").alias("payment_type"),
        _s("mx_line").alias("payment_installments"),
        _s("value").alias("payment_value"),
    )


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_driver(spark, sf_dir, "orders")
    od = F.col("o_orderdate").cast("timestamp_ntz")
    return o.select(
        F.concat(F.lit(" r"), _s("o_orderkey")).alias("review_id"),
        F.concat(F.lit(" "), _s("o_orderkey")).alias("order_id"),
        F.substring("o_orderpriority", 1, 1).alias("review_score"),
        F.when(F.col("o_orderkey") % 3 == 0,
               F.concat(F.lit(" "), F.col("o_orderpriority"), F.lit(" "))).alias("review_comment_title"),
        F.when(F.col("o_orderkey") % 2 == 0,
               F.concat(F.lit(" status "), F.col("o_orderstatus"), F.lit(" "))).alias("review_comment_message"),
        _s(od).alias("review_creation_date"),
        _s(F.timestamp_add("DAY", F.col("o_custkey") % 10, od)).alias("review_answer_timestamp"),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_driver(spark, sf_dir, "part")
    return p.select(
        F.concat(F.lit(" "), _s("p_partkey")).alias("product_id"),
        F.concat(F.lit(" "), F.col("p_type"), F.lit(" ")).alias("product_category_name"),
        _s(F.length("p_name")).alias("product_name_lenght"),
        _s(F.length("p_name") * 10).alias("product_description_lenght"),
        _s(F.col("p_partkey") % 6).alias("product_photos_qty"),
        _s(F.col("p_size") * 100).alias("product_weight_g"),
        _s("p_size").alias("product_length_cm"),
        _s(F.col("p_size") + 1).alias("product_height_cm"),
        _s(F.col("p_size") + 2).alias("product_width_cm"),
    )


def raw_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_driver(spark, sf_dir, "supplier")
    n = read_driver(spark, sf_dir, "nation")
    j = s.join(n, s.s_nationkey == n.n_nationkey)
    return j.select(
        F.concat(F.lit(" "), _s("s_suppkey")).alias("seller_id"),
        F.concat(F.lpad(_s("s_nationkey"), 5, "0"), F.lit(" ")).alias("seller_zip_code_prefix"),
        F.concat(F.lit("  City Of "), F.col("n_name")).alias("seller_city"),
        F.concat(F.lower("n_name"), F.lit(" ")).alias("seller_state"),
    )


def raw_geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_driver(spark, sf_dir, "customer")
    n = read_driver(spark, sf_dir, "nation")
    j = c.join(n, c.c_nationkey == n.n_nationkey)
    return j.select(
        F.lpad(_s("c_nationkey"), 5, "0").alias("geolocation_zip_code_prefix"),
        _s(F.expr("CAST(c_nationkey * -1.5 AS DECIMAL(9,2))")).alias("geolocation_lat"),
        _s(F.expr("CAST(c_nationkey * -2.5 AS DECIMAL(9,2))")).alias("geolocation_lng"),
        F.concat(F.when(F.col("c_custkey") % 2 == 0, " City Of ").otherwise("CITY OF "),
                 F.col("n_name")).alias("geolocation_city"),
        F.concat(F.lit(" "), F.lower("n_name")).alias("geolocation_state"),
    )


def raw_category_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_driver(spark, sf_dir, "part")
    return (p.where(F.col("p_type") != "PROMO")
             .select(F.col("p_type").alias("product_category_name"),
                     F.concat(F.col("p_type"), F.lit("_EN ")).alias("product_category_name_english"))
             .distinct())


_BUILDERS = {
    "customers": raw_customers, "orders": raw_orders, "items": raw_items, "payments": raw_payments,
    "reviews": raw_reviews, "products": raw_products, "sellers": raw_sellers,
    "geolocation": raw_geolocation, "category_name": raw_category_name,
}


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in _BUILDERS:
        raise ValueError(f"unknown raw table {name!r}")
    return _BUILDERS[name](spark, sf_dir)


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: b(spark, sf_dir) for name, b in _BUILDERS.items()}


# ------------------------------------------------------------------------------ dirt (FIXTURES.md, part C)
# What rules and checks must find. Expressions are SQL over the raw columns, the same in every engine; the
# rows of ``repeat`` come a second time, with the columns of ``second`` replaced.

@dataclass(frozen=True)
class Dirt:
    columns: dict[str, str] = field(default_factory=dict)
    repeat: str | None = None
    second: dict[str, str] = field(default_factory=dict)
    where: str | None = None


def _every(n: int, key: str, then: str, column: str) -> str:
    return f"CASE WHEN CAST(trim({key}) AS BIGINT) % {n} = 0 THEN {then} ELSE {column} END"


DIRT = {
    "customers": Dirt(repeat="CAST(trim(customer_id) AS BIGINT) % 50 = 0", second={"customer_city": "' Elsewhere '"}),
    "orders": Dirt(
        columns={
            "order_status": _every(37, "order_id", "' LOST'", "order_status"),
            "customer_id": _every(43, "order_id", "'nobody'", "customer_id"),
            "order_purchase_timestamp": _every(40, "order_id", "'not a date'", _every(41, "order_id", "NULL", "order_purchase_timestamp")),
        }),
    "items": Dirt(
        columns={
            "order_id": _every(47, "order_id", "concat('x', order_id)", "order_id"),
            "product_id": _every(501, "product_id", "NULL", "product_id"),
            "seller_id": _every(19, "seller_id", "'none'", "seller_id"),
            "price": _every(50, "product_id", "'-5.00'", _every(51, "product_id", "'abc'", "price")),
            "freight_value": _every(53, "product_id", "'-1'", "freight_value"),
        },
        repeat="CAST(trim(order_id) AS BIGINT) % 59 = 0"),
    "payments": Dirt(columns={"payment_value": _every(31, "order_id", "'-1.00'", "payment_value"),
                              "payment_type": _every(29, "order_id", "NULL", "payment_type")}),
    "reviews": Dirt(columns={"review_score": _every(23, "order_id", "'9'", "review_score"), "order_id": _every(27, "order_id", "NULL", "order_id")}),
    "products": Dirt(columns={"product_weight_g": _every(11, "product_id", "'heavy'", "product_weight_g")},
                     repeat="CAST(trim(product_id) AS BIGINT) % 60 = 0"),
    "sellers": Dirt(repeat="CAST(trim(seller_id) AS BIGINT) % 10 = 0", second={"seller_city": "' Elsewhere '"}),
    "geolocation": Dirt(columns={"geolocation_zip_code_prefix": _every(3, "geolocation_zip_code_prefix", "NULL", "geolocation_zip_code_prefix")}),
    "category_name": Dirt(where="1 = 0"),
}


def dirty_select(dirt: Dirt, columns: list[str], second: bool = False) -> list[str]:
    """The select list of a dirty table: ``expression AS column``."""
    exprs = dirt.columns | (dirt.second if second else {})
    return [f"{exprs.get(c, c)} AS {c}" for c in columns]


def dirty_table(df: DataFrame, name: str) -> DataFrame:
    dirt = DIRT[name]
    out = df.selectExpr(*dirty_select(dirt, df.columns))
    if dirt.repeat:
        out = out.unionByName(df.where(dirt.repeat).selectExpr(*dirty_select(dirt, df.columns, second=True)))
    return out.where(dirt.where) if dirt.where else out
