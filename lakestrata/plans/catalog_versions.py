"""Registered queries over two versions of a table: change sets, checksum trees, months brought up to date, and records
of CSV files read in blocks.

The newer version is derived from the older one by fixed rules on the order number, stated in both engines: some orders
leave, some prices or scores change, some rows come."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.operators import changes, checksum_tree
from lakestrata.plans import jobs
from lakestrata.plans.frames import Layers
from lakestrata.plans.registry import fresh_folder, register
from lakestrata.sources import landing, monthly
from lakestrata.specs import Check, table_spec

ITEM_KEYS = ("order_id", "order_item_id")


def _number() -> Column:
    return F.col("order_id").cast("bigint")


def newer_items(items: DataFrame) -> DataFrame:
    stay = items.where(_number() % 11 != 3).withColumn("price", F.when(_number() % 7 == 2, F.col("price") + 1).otherwise(F.col("price")))
    return stay.unionByName(items.where(_number() % 13 == 5).withColumn("order_item_id", F.col("order_item_id") + 100))


_NEWER_ITEMS = """new_items AS (
  SELECT * REPLACE (CASE WHEN CAST(order_id AS BIGINT) % 7 = 2 THEN price + 1 ELSE price END AS price) FROM silver_items WHERE CAST(order_id AS BIGINT) % 11 <> 3
  UNION ALL SELECT * REPLACE (order_item_id + 100 AS order_item_id) FROM silver_items WHERE CAST(order_id AS BIGINT) % 13 = 5)"""
_ITEM_CHANGES = f"""
WITH {_NEWER_ITEMS}
SELECT coalesce(o.order_id, n.order_id) AS order_id, coalesce(o.order_item_id, n.order_item_id) AS order_item_id,
       CASE WHEN o.order_id IS NULL THEN 'insert' WHEN n.order_id IS NULL THEN 'delete' ELSE 'update' END AS change,
       CAST(o.order_id IS NOT NULL AS BIGINT) AS rows_before, CAST(n.order_id IS NOT NULL AS BIGINT) AS rows_after
FROM silver_items AS o FULL JOIN new_items AS n ON o.order_id = n.order_id AND o.order_item_id = n.order_item_id
WHERE o.order_id IS NULL OR n.order_id IS NULL
   OR (o.product_id, o.seller_id, o.shipping_limit_date, o.price, o.freight_value) IS DISTINCT FROM (n.product_id, n.seller_id, n.shipping_limit_date, n.price, n.freight_value)"""


@register("change_set_items", _ITEM_CHANGES)
def change_set_items(spark, sf_dir):
    """Keys of items that came, went or changed between two versions."""
    items = Layers(spark, sf_dir).silver("items")
    return changes.change_set(items, newer_items(items), ITEM_KEYS)


@register("change_set_reviews", """
WITH new_reviews AS (
  SELECT * REPLACE (CASE WHEN CAST(order_id AS BIGINT) % 5 = 1 THEN 6 - review_score ELSE review_score END AS review_score) FROM silver_reviews WHERE CAST(order_id AS BIGINT) % 9 <> 4)
SELECT o.review_id, CASE WHEN n.review_id IS NULL THEN 'delete' ELSE 'update' END AS change, o.review_score AS score_before, n.review_score AS score_after
FROM silver_reviews AS o LEFT JOIN new_reviews AS n USING (review_id) WHERE n.review_id IS NULL OR n.review_score <> o.review_score""")
def change_set_reviews(spark, sf_dir):
    """What changed reviews were and are: only the score is compared."""
    old = Layers(spark, sf_dir).silver("reviews")
    score = F.when(_number() % 5 == 1, 6 - F.col("review_score")).otherwise(F.col("review_score"))
    new = old.where(_number() % 9 != 4).withColumn("review_score", score)
    found = changes.change_set(old, new, ["review_id"], ["review_score"])
    both = changes.with_contents(found, old, new, ["review_id"], ["review_score"])
    return both.select("review_id", "change", F.col("before.review_score").alias("score_before"), F.col("after.review_score").alias("score_after"))


@register("checksum_tree_changes", _ITEM_CHANGES)
def checksum_tree_changes(spark, sf_dir):
    """The same changes through two written trees: equal ranges are not read."""
    items, at = Layers(spark, sf_dir).silver("items"), fresh_folder(spark, "trees")
    old, new = (checksum_tree.write_tree(df, f"{at}/{name}", ITEM_KEYS) for df, name in ((items, "old"), (newer_items(items), "new")))
    return checksum_tree.differing(spark, old, new, ITEM_KEYS)


@register("checksum_tree_one_order", """
SELECT order_id, order_item_id, 'update' AS change, CAST(1 AS BIGINT) AS rows_before, CAST(1 AS BIGINT) AS rows_after
FROM silver_items WHERE order_id = (SELECT min(order_id) FROM silver_items)""")
def checksum_tree_one_order(spark, sf_dir):
    """One changed order in a large table: its leaves alone are opened."""
    items, at = Layers(spark, sf_dir).silver("items"), fresh_folder(spark, "trees")
    first = items.agg(F.min("order_id")).first()[0]
    changed = items.withColumn("freight_value", F.when(F.col("order_id") == first, F.col("freight_value") - 1000).otherwise(F.col("freight_value")))
    old, new = (checksum_tree.write_tree(df, f"{at}/{name}", ITEM_KEYS) for df, name in ((items, "old"), (changed, "new")))
    return checksum_tree.differing(spark, old, new, ITEM_KEYS)


# ------------------------------------------------------------------ months brought up to date (incremental writes)
# Run 2 changes scores in one month, removes another one and brings reviews of a new one; run 3 brings the same again.

_CHANGED, _GONE, _CAME = "1997-03-01", "1996-05-01", "2031-01-01"


def newer_reviews(fact: DataFrame) -> DataFrame:
    month = F.trunc("data_avaliacao", "month").cast("string")
    here = fact.where(F.coalesce(month != _GONE, F.lit(True)))
    score = F.when(month == _CHANGED, 6 - F.col("review_score")).otherwise(F.col("review_score"))
    came = fact.where(month == _GONE).withColumns({"review_id": F.concat(F.lit("n"), "review_id"), "data_avaliacao": F.lit(_CAME).cast("date")})
    return here.withColumn("review_score", score).unionByName(came)


def _updated_table(spark, sf_dir: str, runs: int):
    root, fact = fresh_folder(spark, "monthly"), Layers(spark, sf_dir).gold("fato_avaliacoes")
    checks = [Check("not_null", ("order_id",)), Check("range", ("review_score",), lo=1, hi=5)]
    outcomes = [monthly.publish_changes(spark, df, root, "gold", "fato_avaliacoes", f"run-{i}", ["review_id"], "data_avaliacao", checks)
                for i, df in enumerate([fact, newer_reviews(fact), newer_reviews(fact)][:runs], 1)]
    return root, outcomes


_NEWER_REVIEWS = f"""new_reviews AS (
  SELECT * REPLACE (CASE WHEN date_trunc('month', data_avaliacao) = DATE '{_CHANGED}' THEN 6 - review_score ELSE review_score END AS review_score)
  FROM gold_fato_avaliacoes WHERE coalesce(date_trunc('month', data_avaliacao) <> DATE '{_GONE}', true)
  UNION ALL SELECT * REPLACE ('n' || review_id AS review_id, DATE '{_CAME}' AS data_avaliacao) FROM gold_fato_avaliacoes WHERE date_trunc('month', data_avaliacao) = DATE '{_GONE}')"""


@register("monthly_publish", f"""
WITH {_NEWER_REVIEWS},
months AS (SELECT CAST(CAST(date_trunc('month', data_avaliacao) AS DATE) AS VARCHAR) AS month, count(*) AS rows FROM new_reviews GROUP BY 1)
SELECT coalesce(month, 'none') AS month, rows,
       CASE WHEN month = '{_CAME}' OR (month = '{_CHANGED}' AND EXISTS (SELECT 1 FROM gold_fato_avaliacoes
              WHERE date_trunc('month', data_avaliacao) = DATE '{_CHANGED}' AND review_score <> 3)) THEN 'run-2' ELSE 'run-1' END AS run
FROM months""")
def monthly_publish(spark, sf_dir):
    """Which run holds each month after three runs: only months with changes are written again."""
    root, _ = _updated_table(spark, sf_dir, 3)
    return monthly.read_months(spark, root, "gold", "fato_avaliacoes")


@register("monthly_outcomes", f"""
WITH g AS (SELECT *, date_trunc('month', data_avaliacao) AS m FROM gold_fato_avaliacoes),
n AS (SELECT count(*) AS base, CAST(count_if(m = DATE '{_GONE}') AS BIGINT) AS gone, CAST(count_if(m = DATE '{_CHANGED}' AND review_score <> 3) AS BIGINT) AS changed, count(DISTINCT coalesce(m, DATE '1900-01-01')) AS months FROM g)
SELECT 1 AS run, base AS inserted, CAST(0 AS BIGINT) AS updated, CAST(0 AS BIGINT) AS deleted, months AS written, true AS published FROM n
UNION ALL SELECT 2, gone, changed, gone, CAST(changed > 0 AS BIGINT) + CAST(gone > 0 AS BIGINT), true FROM n
UNION ALL SELECT 3, 0, 0, 0, 0, false FROM n""")
def monthly_outcomes(spark, sf_dir):
    """What each run found and wrote; the third one writes nothing."""
    _, outcomes = _updated_table(spark, sf_dir, 3)
    rows = [(i, *(o.changes.get(k, 0) for k in ("insert", "update", "delete")), len(o.written), o.published) for i, o in enumerate(outcomes, 1)]
    return spark.createDataFrame(rows, "run int, inserted long, updated long, deleted long, written long, published boolean")


@register("monthly_between", f"""
WITH {_NEWER_REVIEWS} SELECT * FROM new_reviews WHERE data_avaliacao BETWEEN DATE '1996-04-15' AND DATE '1997-03-20'""")
def monthly_between(spark, sf_dir):
    """A date range of the table as it is now: months outside it are not opened."""
    root, _ = _updated_table(spark, sf_dir, 2)
    rows = monthly.read_monthly(spark, root, "gold", "fato_avaliacoes", "1996-04-15", "1997-03-20")
    return rows.where(F.col("data_avaliacao").between(F.lit("1996-04-15").cast("date"), F.lit("1997-03-20").cast("date")))


# ------------------------------------------------------------------ records of CSV files

@register("src_multiline_records", """
SELECT trim(review_id) AS review_id, review_score, trim(review_comment_title) AS review_comment_title,
       CASE WHEN review_comment_message IS NOT NULL THEN 'first, "quoted"' || chr(10) || chr(10) || 'third"' || review_comment_message || chr(10) || '.' END AS review_comment_message
FROM raw_reviews""")
def src_multiline_records(spark, sf_dir):
    """SRC-2: every record of CSV files with quotes, empty lines and line ends inside fields."""
    paths, reviews = jobs.LakePaths(fresh_folder(spark, "zone"), ""), Layers(spark, sf_dir).raw("reviews")
    text = F.concat(F.lit('first, "quoted"\n\nthird"'), "review_comment_message", F.lit("\n."))
    jobs.land_tables({"reviews": reviews.withColumn("review_comment_message", text)},
                     paths.landing, "2024-02-29")
    rows = landing.read_landing(spark, paths.landing, table_spec("reviews"), "2024-02-29")
    return rows.select(F.trim("review_id").alias("review_id"), "review_score", F.trim("review_comment_title").alias("review_comment_title"), "review_comment_message")
