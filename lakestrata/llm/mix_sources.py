"""Operator 2: mixing sources to target weights with a multivariate-hypergeometric splitting tree.

1. Every source's documents fall by hash into at least ``BLOCKS`` blocks, more in a table of so many rows that a block
   would exceed ``BLOCK_ROWS``, so even a source with a third of all rows is spread over thousands of keys. Only sums per
   block go on.
2. Sources get targets by weight; a target stops at ``MAX_REPEATS`` times the source's size and the excess
   goes to the others (water level). A source's quota is the number of blocks it draws: all blocks once per
   full pass, then blocks in permuted order until the target is met; the last block is trimmed to the word.
3. The quotas are split over the output shards by a binary tree: a node gives its left half a multivariate
   hypergeometric share of each source's blocks (selection sampling: exactly the law of drawing without
   replacement), down to one exact quota per shard and source.
4. Each source permutes its drawn blocks and deals them to the shards by these quotas: the draws are
   disjoint. Inside a shard, rows are ordered by hash.

All of it is SQL expressions. Everything that is not per document is bounded by sources x blocks. Texts stay where they
are read until ``mixed_documents`` sends each drawn one to its shard; only the rows of a trimmed block, one per source,
are ordered.
Randomness is hashes of the seed, so reruns agree.

Defined results: a null source is a source of its own, last in the order; a null or empty text has size 0
and is never drawn; a row's place follows from its id and text, so repeated rows fall into the same block;
an empty table gives an empty mix; columns of the input keep their values, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakestrata.llm.tables import Scratch, documents, small

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
BLOCKS = 4096
BLOCK_ROWS = 1 << 16
SHARD_WORDS = 1 << 23
SEED = 20240229

_WORD = r"[^\x20\x09-\x0D]+"


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the hash of the parts."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(1 << 53))


def blocks_for(rows: int) -> int:
    return max(BLOCKS, 1 << (max(rows - 1, 0) // BLOCK_ROWS).bit_length())


def placed(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int, columns: Sequence[str], blocks: int = BLOCKS) -> DataFrame:
    """``docs`` as one struct ``row`` of ``columns`` with its text, source key, block and place in the block."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("row"), F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                       text.alias("text"), F.xxhash64(F.lit(seed), F.col(id_col), text).alias("place"))
    return rows.withColumns({"skey": F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n")),
                             "block": F.pmod("place", F.lit(blocks)).cast("int")})


def sized(rows: DataFrame) -> DataFrame:
    """The rows with their size in words instead of the text."""
    return rows.withColumn("size", F.regexp_count("text", F.lit(_WORD)).cast("long")).drop("text")


def source_targets(blocks: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per source: skey, rank, source_size, target. Sorted by cap / weight, the water level is the
    largest level(j) = (total - caps before j) / (weights from j on) that stays below j's cap."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    s = blocks.groupBy("skey").agg(F.first("source").alias("source"), F.sum("words").alias("source_size"))
    s = s.withColumn("rank", F.row_number().over(by_name) - 1)
    s = s.withColumns({"weight": F.element_at(F.array(*map(F.lit, weights)), F.col("rank") % len(weights) + 1).cast("double"),
                       "cap": (F.col("source_size") * max_repeats).cast("double")})
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before, after = by_cap.rowsBetween(Window.unboundedPreceding, -1), by_cap.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    s = s.withColumn("level", level)
    s = s.withColumn("water", F.max(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))).over(everything))
    return s.select("skey", "rank", "source_size", F.least("cap", F.col("water") * F.col("weight")).alias("target"))


def block_draws(blocks: DataFrame, sources: DataFrame, seed: int) -> DataFrame:
    """(skey, rank, block, pass, words): a drawn block has its words, a trimmed one those up to the target."""
    b = blocks.join(sources, "skey").filter("words > 0")
    take = F.round("target").cast("long")
    b = b.withColumns({"passes": F.floor(take / F.col("source_size")).cast("int"), "rest": take % F.col("source_size")})
    order = Window.partitionBy("skey").orderBy(F.xxhash64(F.lit(seed), F.lit("draw"), "skey", "block"), "block")
    before = F.coalesce(F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    b = b.withColumn("part", F.least("words", F.greatest(F.lit(0).cast("long"), F.col("rest") - before)))
    b = b.withColumn("pass", F.explode(F.sequence(F.lit(0), F.col("passes"))))
    b = b.withColumn("drawn", F.when(F.col("pass") < F.col("passes"), F.col("words")).otherwise(F.col("part")))
    return b.filter("drawn > 0").select("skey", "rank", "block", "pass", F.col("drawn"), (F.col("drawn") < F.col("words")).alias("trimmed"))


def split_quotas(quotas: DataFrame, depth: int, seed: int) -> DataFrame:
    """(shard, rank, n) from (rank, n): the splitting tree over ``2 ** depth`` shards."""
    tree = quotas.agg(F.array_sort(F.collect_list(F.struct(F.col("rank").cast("int").alias("rank"), F.col("n").cast("long").alias("n")))).alias("q"))
    tree = tree.select(F.lit(1).cast("long").alias("node"), "q")
    for _ in range(depth):
        total = F.aggregate("q", F.lit(0).cast("long"), lambda s, x: s + x["n"])
        tree = tree.withColumn("total", total)

        def share(state: Column, x: Column) -> Column:
            """Of the ``x.n`` blocks of a source, in turn: each goes left with the chance needed / left over."""
            def one(s: Column, j: Column) -> Column:
                goes = _uniform(F.lit(seed), F.col("node"), x["rank"], j) * s["over"] < s["need"]
                step = F.when(goes, F.lit(1)).otherwise(F.lit(0)).cast("long")
                return F.struct((s["over"] - 1).alias("over"), (s["need"] - step).alias("need"), (s["got"] + step).alias("got"))

            start = F.struct(state["over"].alias("over"), state["need"].alias("need"), F.lit(0).cast("long").alias("got"))
            each = F.when(x["n"] > 0, F.sequence(F.lit(1).cast("long"), x["n"])).otherwise(F.array().cast("array<bigint>"))
            end = F.aggregate(each, start, one)
            return F.struct(end["over"].alias("over"), end["need"].alias("need"), F.concat(state["left"], F.array(end["got"])).alias("left"))

        start = F.struct(F.col("total").alias("over"), F.expr("(total + 1) div 2").alias("need"), F.array().cast("array<bigint>").alias("left"))
        tree = tree.withColumn("left", F.aggregate("q", start, share)["left"])
        halves = F.array(
            F.struct((F.col("node") * 2).alias("node"),
                     F.zip_with("q", "left", lambda x, n: F.struct(x["rank"].alias("rank"), n.alias("n"))).alias("q")),
            F.struct((F.col("node") * 2 + 1).alias("node"),
                     F.zip_with("q", "left", lambda x, n: F.struct(x["rank"].alias("rank"), (x["n"] - n).alias("n"))).alias("q")))
        tree = tree.select(F.explode(halves).alias("half")).select("half.node", "half.q")
    return tree.select((F.col("node") - (1 << depth)).cast("int").alias("shard"), F.explode("q").alias("x")).select("shard", "x.rank", "x.n")


def deal(draws: DataFrame, depth: int, seed: int) -> DataFrame:
    """``draws`` with the shard of each: a source's permuted draws go to the shards by their quotas."""
    leaves = split_quotas(draws.groupBy("rank").agg(F.count("*").alias("n")), depth, seed).filter("n > 0")
    before = Window.partitionBy("rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    leaves = leaves.withColumn("lo", F.coalesce(F.sum("n").over(before), F.lit(0)))
    places = leaves.select("rank", "shard", F.explode(F.sequence(F.col("lo"), F.col("lo") + F.col("n") - 1)).alias("place"))
    permuted = Window.partitionBy("rank").orderBy(F.xxhash64(F.lit(seed), F.lit("deal"), "skey", "block", "pass"), "block", "pass")
    return draws.withColumn("place", F.row_number().over(permuted).cast("long") - 1).join(places, ["rank", "place"]).drop("place")


def draw(docs: DataFrame, scratch: Scratch, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         weights: tuple[int, ...] = WEIGHTS, seed: int = SEED, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per row of ``docs``: row (the input row's ``columns``, by default all), place, size, source_size, target and
    ``draws``, an array of (shard, pass, words). At most one document of a source is drawn in part."""
    rows = placed(docs, id_col, text_col, source_col, seed, docs.columns if columns is None else columns, blocks_for(docs.count()))
    blocks = scratch.keep(sized(rows).groupBy("skey", "block").agg(F.first("source").alias("source"), F.sum("size").alias("words")), "blocks")
    sources = scratch.keep(source_targets(blocks, weights), "sources")
    total = blocks.agg(F.sum("words")).first()[0] or 0
    depth = max(0, (max(total, 1) - 1) // SHARD_WORDS).bit_length()
    draws = scratch.keep(block_draws(blocks, sources, seed), "draws")
    dealt = scratch.keep(deal(draws, depth, seed), "dealt")
    of_block = dealt.groupBy("skey", "block").agg(
        F.array_sort(F.collect_list(F.struct("pass", "shard", "drawn", "trimmed"))).alias("of_block"))  # at most MAX_REPEATS
    plan = blocks.select("skey", "block").join(sources, "skey").join(of_block, ["skey", "block"], "left")
    plan = scratch.keep(plan.drop("rank").withColumn("cut", F.coalesce(F.exists("of_block", lambda x: x["trimmed"]), F.lit(False))), "plan")
    # only the rows of trimmed blocks are ordered and added up, one block per source
    whole = sized(rows).join(small(plan.filter("not cut").drop("cut")), ["skey", "block"]).withColumn("before", F.lit(0).cast("long"))
    in_block = Window.partitionBy("skey", "block").orderBy("place", "id")
    before = F.coalesce(F.sum("size").over(in_block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    trimmed = sized(rows.join(small(plan.filter("cut").drop("cut")), ["skey", "block"])).withColumn("before", before)
    out = whole.unionByName(trimmed)
    got = F.transform("of_block", lambda x: F.struct(
        x["shard"].alias("shard"), x["pass"].alias("pass"),
        F.when(x["trimmed"], F.least("size", F.greatest(F.lit(0).cast("long"), x["drawn"] - F.col("before")))).otherwise(F.col("size")).alias("words")))
    got = F.filter(got, lambda x: x["words"] > 0)
    empty = F.array().cast("array<struct<shard:int,pass:int,words:bigint>>")
    return out.select("row", "place", "size", "source_size", "target", F.coalesce(got, empty).alias("draws"))


def mixed_documents(docs: DataFrame, scratch: Scratch, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    weights: tuple[int, ...] = WEIGHTS, seed: int = SEED, whole: bool = True) -> DataFrame:
    """The mix as rows of ``docs``, each as often as it is drawn, dealt by shard and ordered by hash inside
    it. A document drawn in part is taken whole if at least half of it is drawn (``whole``), else its text
    is cut behind the last drawn word."""
    out = draw(docs, scratch, id_col=id_col, text_col=text_col, source_col=source_col, weights=weights, seed=seed)
    out = out.select("row", "place", "size", F.explode("draws").alias("d"))
    if whole:
        out = out.filter(F.col("d.words") * 2 >= F.col("size"))
    out = out.repartition(F.col("d.shard")).sortWithinPartitions("d.shard", F.xxhash64(F.lit(seed), "place", "d.pass"))
    cols = [F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    if not whole:
        pieces = F.regexp_extract_all(F.col(f"row.`{text_col}`"), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
        text = F.when(F.col("d.words") < F.col("size"), F.array_join(F.slice(pieces, F.lit(1), F.col("d.words").cast("int")), "")).otherwise(
            F.col(f"row.`{text_col}`"))
        cols = [text.alias(text_col) if c == text_col else x for c, x in zip(docs.columns, cols)]
    return out.select(*cols)


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = draw(documents(spark, sf_dir), Scratch(spark, "mix"), columns=["doc_id"])
    return out.select(F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target",
                      F.aggregate("draws", F.lit(0).cast("long"), lambda s, x: s + x["words"]).alias("taken"),
                      F.transform("draws", lambda x: x["shard"]).alias("shards"))


QUERIES = {"op2_mix_sources": op2_mix_sources}
ORACLES: dict[str, str] = {}
