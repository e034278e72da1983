"""Operator 6: benchmark decontamination.

The test items' normalised word windows become a small hash table that every executor holds; training
texts are scanned word by word, the hash of the next ten words is looked up, and a hit counts only if the
words are equal. Documents are dropped, or the covered words are cut out.

All of it is SQL expressions: a text becomes one array of words, the positions are generated from it and
never leave their task unless they hit. The window table is broadcast while it has at most
``MAX_BROADCAST_WINDOWS`` rows (it is counted); with a larger one, places go through a shuffle as id, place and hash, and
only what meets is compared with the text.

Defined results: null texts and texts without a word have no windows and no hits; an item shorter than
ten words is one window, an item without words none; items with a null id count as the id ``null``; a row
is judged by its id and text, so repeated rows get equal results; other columns do not matter.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.llm.tables import Scratch, documents, small

WINDOW = 10
MAX_BROADCAST_WINDOWS = 500_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: separators of words, after and before lower-casing A-Z
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def ascii_lower(text: Column) -> Column:
    """A-Z only; ``lower`` does just that to a text without other letters, and faster."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def normal_words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), _BETWEEN), "")


def _next_words(i: Column, length: int) -> list[Column]:
    return [F.get("words", i + j) for j in range(length)]


def benchmark_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Distinct (item, length, words joined by a space) of the items' windows."""
    words = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("item"), normal_words(F.col(text_col)).alias("words"))
    words = words.filter(F.size("words") > 0).withColumn("length", F.least(F.size("words"), F.lit(window)))
    at = words.select("item", "words", "length", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("length") + 1)).alias("i"))
    return at.select("item", "length", F.array_join(F.slice("words", F.col("i"), F.col("length")), " ").alias("phrase")).distinct()


def _place_hash(n: int) -> Column:
    """The hash of the n words from place ``i`` on, null where the text ends before."""
    return F.when(F.col("i") + n <= F.size("words"), F.xxhash64(F.col("word"), *_next_words(F.col("i"), n)[1:]))


def find_hits(docs: DataFrame, windows: DataFrame, lengths: list[int], small: bool) -> DataFrame:
    """(id, text_hash, i, length, phrase): the places (from 0) in ``docs`` (id, text_hash, text) where a
    phrase of ``windows`` (length, phrase) starts. ``small``: the windows are broadcast; else hashes of places meet hashes
    of windows, a few numbers a row, and what meets is verified at the text, one row per document."""
    at = docs.select("id", "text_hash", normal_words(F.col("text")).alias("words"))
    at = at.select("id", "text_hash", "words", F.posexplode("words").alias("i", "word"))
    # the phrases' hash is that of their words, as it is computed at each place
    words = windows.withColumn("__w", F.split("phrase", " "))
    hashed = {n: words.filter(F.col("length") == n).select(F.xxhash64(*(F.col("__w")[j] for j in range(n))).alias("h"), F.col("length"), F.col("phrase")) for n in lengths}
    if not small:
        return _verified_hits(docs, _met_places(at, hashed))
    for n in lengths:
        of_n = hashed[n].select(F.col("h").alias(f"h{n}"), F.col("phrase").alias(f"p{n}"))
        at = at.join(F.broadcast(of_n), _place_hash(n) == F.col(f"h{n}"), "inner" if len(lengths) == 1 else "left")
    found = F.array(*(F.when(F.col(f"p{n}") == F.array_join(F.slice("words", F.col("i") + 1, F.lit(n)), " "),
                             F.struct(F.lit(n).alias("length"), F.col(f"p{n}").alias("phrase"))) for n in lengths))
    if len(lengths) > 1:
        at = at.filter(F.coalesce(*(F.col(f"h{n}") for n in lengths)).isNotNull())
    hits = at.select("id", "text_hash", "i", F.explode(F.filter(found, lambda x: x.isNotNull())).alias("hit"))
    return hits.select("id", "text_hash", "i", "hit.length", "hit.phrase")


def _met_places(at: DataFrame, hashed: dict[int, DataFrame]) -> DataFrame:
    """(id, text_hash, i, length, phrase) of places and windows with equal hashes; no text goes through the shuffle."""
    lengths = list(hashed)
    keys = F.filter(F.array(*(F.struct(F.lit(n).alias("length"), _place_hash(n).alias("h")) for n in lengths)), lambda x: x["h"].isNotNull())
    places = at.select("id", "text_hash", "i", F.explode(keys).alias("key")).select("id", "text_hash", "i", "key.length", "key.h")
    return places.join(reduce(DataFrame.unionByName, hashed.values()), ["length", "h"]).drop("h")


def _verified_hits(docs: DataFrame, met: DataFrame) -> DataFrame:
    spots = met.groupBy("id", "text_hash").agg(F.collect_set(F.struct("i", "length", "phrase")).alias("spots"))
    spots = spots.select(F.col("id").alias("__id"), F.col("text_hash").alias("__hash"), "spots")
    both = docs.join(spots, F.col("id").eqNullSafe(F.col("__id")) & (F.col("text_hash") == F.col("__hash")))
    both = both.select("id", "text_hash", "spots", normal_words(F.col("text")).alias("words"))
    true = F.filter("spots", lambda x: F.array_join(F.slice("words", x["i"] + 1, x["length"]), " ") == x["phrase"])
    return both.select("id", "text_hash", F.explode(true).alias("hit")).select("id", "text_hash", "hit.i", "hit.length", "hit.phrase")


def _hits(docs: DataFrame, windows: DataFrame, scratch: Scratch, id_col: str, text_col: str) -> DataFrame:
    """The distinct (id, text_hash, i, length, phrase) of all hits, written."""
    lengths = sorted(r["length"] for r in windows.select("length").distinct().collect())  # at most a window's words
    text = _hashed(docs, id_col, text_col)
    if lengths:
        few = windows.count() <= MAX_BROADCAST_WINDOWS
        hits = find_hits(text, windows.select("length", "phrase").distinct(), lengths, few)
    else:
        hits = docs.sparkSession.createDataFrame([], f"id {docs.schema[id_col].dataType.simpleString()}, text_hash long, i int, length int, phrase string")
    return scratch.keep(hits.distinct(), "hits")


def _hashed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn("text_hash", F.xxhash64("text"))


def contamination(docs: DataFrame, items: DataFrame, scratch: Scratch, *, id_col: str = "doc_id", text_col: str = "text",
                  window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: id, text_hash, n_words, n_hit, n_items, items (sorted ids) and
    ``spans`` (sorted, disjoint (start, end) ranges of hit words)."""
    windows = scratch.keep(benchmark_windows(items, window=window), "windows")
    hits = _hits(docs, windows, scratch, id_col, text_col)
    every = _hashed(docs, id_col, text_col).select(
        "id", "text_hash", F.regexp_count(F.coalesce("text", F.lit("")), F.lit(_WORD_ANY_CASE)).cast("long").alias("n_words"))
    spot = F.array_sort(F.collect_set(F.struct("i", (F.col("i") + F.col("length")).alias("end"))))
    # ranges that touch or overlap become one
    joined = F.aggregate(
        "at", F.array().cast("array<struct<start:int,end:int>>"),
        lambda out, x: F.when((F.size(out) > 0) & (F.element_at(out, -1)["end"] >= x["i"]),
                              F.concat(F.slice(out, F.lit(1), F.size(out) - 1),
                                       F.array(F.struct(F.element_at(out, -1)["start"].alias("start"),
                                                        F.greatest(F.element_at(out, -1)["end"], x["end"]).alias("end")))))
        .otherwise(F.concat(out, F.array(F.struct(x["i"].alias("start"), x["end"].alias("end"))))))
    spans = hits.groupBy("id", "text_hash").agg(spot.alias("at")).select("id", "text_hash", joined.alias("spans"))
    # a phrase meets documents with the set of its items, so one that many of both share is a row per document
    of_phrase = windows.groupBy("length", "phrase").agg(F.collect_set("item").alias("of_phrase"))
    items_of = hits.select("id", "text_hash", "length", "phrase").distinct().join(of_phrase, ["length", "phrase"])
    items_of = items_of.groupBy("id", "text_hash").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("of_phrase")))).alias("items"))
    found = spans.join(items_of, spans["id"].eqNullSafe(items_of["id"]) & (spans["text_hash"] == items_of["text_hash"]), "left").select(
        spans["id"].alias("id2"), spans["text_hash"].alias("hash2"), "spans", "items")
    rows = every.join(found, F.col("id").eqNullSafe(F.col("id2")) & (F.col("text_hash") == F.col("hash2")), "left")
    spans_col = F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>"))
    items_col = F.coalesce("items", F.array().cast("array<string>"))
    return rows.select(
        F.col("id").alias(id_col), "text_hash", "n_words",
        F.aggregate(spans_col, F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"]).alias("n_hit"),
        F.size(items_col).cast("long").alias("n_items"), items_col.alias("items"), spans_col.alias("spans"))


def drop_contaminated(docs: DataFrame, items: DataFrame, scratch: Scratch, *, id_col: str = "doc_id", text_col: str = "text",
                      window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without a hit word, unchanged."""
    windows = scratch.keep(benchmark_windows(items, window=window), "windows")
    hits = _hits(docs, windows, scratch, id_col, text_col)
    bad = scratch.keep(hits.select(F.col("id").alias("__id"), F.col("text_hash").alias("__hash")).distinct(), "bad")
    return docs.join(small(bad), F.col(id_col).eqNullSafe(F.col("__id")) & (F.xxhash64(text_col) == F.col("__hash")), "left_anti")


def cut_spans(docs: DataFrame, items: DataFrame, scratch: Scratch, *, id_col: str = "doc_id", text_col: str = "text",
              window: int = WINDOW) -> DataFrame:
    """``docs`` with the hit words, and the separators behind them, cut out of the text."""
    found = contamination(docs, items, scratch, id_col=id_col, text_col=text_col, window=window).filter("n_hit > 0")
    bad = found.select(F.col(id_col).alias("__id"), F.col("text_hash").alias("__hash"), F.col("spans").alias("__spans"))
    bad = bad.dropDuplicates(["__id", "__hash"])
    rows = docs.join(bad, F.col(id_col).eqNullSafe(F.col("__id")) & (F.xxhash64(text_col) == F.col("__hash")), "left")
    # every piece is a word with the separators behind it; what comes before the first word stays
    piece = rf"{_WORD_ANY_CASE}[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"
    pieces = F.regexp_extract_all(F.col(text_col), F.lit(piece), F.lit(0))
    kept = F.filter(pieces, lambda x, i: ~F.exists("__spans", lambda s: (i >= s["start"]) & (i < s["end"])))
    text = F.when(F.col("__spans").isNull(), F.col(text_col)).otherwise(F.array_join(kept, ""))
    return rows.withColumn(text_col, text).select(*(F.col(f"`{c}`") for c in docs.columns))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"), Scratch(spark, "decontaminate"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


QUERIES = {"op6_decontaminate": op6_decontaminate}

ORACLES = {"op6_decontaminate": rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item,
         regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
starts AS (SELECT item, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS phrase FROM starts),
pos AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
spots AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS phrase
          FROM pos, (SELECT DISTINCT n FROM win) AS lengths WHERE i + n - 1 <= len(w)),
hit AS (SELECT DISTINCT doc_id, i, s.n, item FROM spots AS s JOIN win USING (n, phrase)),
cov AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN its USING (doc_id)
"""}
