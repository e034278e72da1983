"""Operator 11: near-duplicate vectors by spherical k-means cells and blocked cosine products.

*Classes.* Rows with equal vectors are one class (128 bits of the vector); everything after this works on classes and
counts their copies.

*Cells.* Spherical k-means is fitted on at most ``SAMPLE`` classes, with about the square root of all classes as centres
and at most ``MAX_CELLS``; then of centres closer than ``APART`` only one stays, so that a tight group has one cell
however many centres it drew. Every class goes to its nearest cells, as many as it takes for vectors of the sample and
made-up partners of theirs, exactly at the limit in a random direction, to share a cell but for ``MISS`` of them.

*Cores.* A class nearer to its centre than half the angle of the limit is in the cell's core. Any two of a core are
linked, by the triangle inequality of angles: they are counted by the core's size and are one node of the components. A
group with a third of all rows is compared with nothing but the few classes around its core.

*Blocks.* What else can be linked in a cell lies in blocks of about ``BLOCK`` classes; every pair of blocks with one
outside the core is one group, one matrix product in double precision. A pair that meets in several cells counts in the
least of them. A group returns one number of links for each of its classes and a spanning forest of its links, so pairs
are never rows.

*Components.* Labels are exchanged over the forests' links in tables. One representative, the smallest id, is kept.

The search is approximate: a pair at the limit itself may share none of its probed cells. Measured recall against brute
force is in the README; no link below the limit is ever reported.

Defined results: vectors that are null, empty or zero, or hold null or non-finite components, have no links and are their
own component; vectors of different lengths are never linked; null ids count as larger than any other and give a
null component only among themselves; repeated rows are vectors of their own, linked with each other; other columns do
not matter; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.llm.near_dedup import NO_ID, components, label_of
from lakestrata.llm.tables import Scratch, documents, small

LIMIT = 0.9
SAMPLE = 32_768
MAX_CELLS = 4096
#: bytes of centres that tasks get
CENTRE_BYTES = 64 << 20
ROUNDS = 10
APART = 0.8
#: share of pairs at the limit that may share no probed cell
MISS = 1e-3
BLOCK = 1024
#: what bounds of angles are tightened by, far above the rounding of a product
SLACK = 1e-9


def unit_rows(values: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision (scaled first, so that no square overflows or vanishes)."""
    x = values.astype(np.float64)
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def vectors(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, unit rows) of each length of vector in a column without nulls."""
    offsets, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    length = np.diff(offsets)
    for d in np.unique(length).tolist():
        at = np.flatnonzero(length == d)
        yield at, unit_rows(values[offsets[at][:, None] + np.arange(d)])


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS, apart: float = APART) -> np.ndarray:
    """At most k centres of unit rows: Lloyd rounds by largest cosine, then without centres close to a kept one."""
    centres = x[np.random.default_rng(len(x)).permutation(len(x))[:k]]
    for _ in range(rounds):
        own = np.concatenate([(part @ centres.T).argmax(1) for part in np.array_split(x, len(x) // 4096 + 1)])
        order = np.argsort(own, kind="stable")
        some, first = np.unique(own[order], return_index=True)
        sums = np.add.reduceat(x[order], first)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = centres.copy()
        centres[some] = np.where(norm > 0, sums / np.maximum(norm, 1e-300), centres[some])
    size = np.bincount(own, minlength=len(centres))
    kept: list[int] = []
    for i in np.argsort(-size, kind="stable").tolist():
        if not kept or (centres[kept] @ centres[i]).max() < apart:
            kept.append(i)
    return centres[kept]


def probes_for(x: np.ndarray, centres: np.ndarray, limit: float, miss: float) -> int:
    """The least number of nearest centres by which unit rows and partners at the limit share one, but for ``miss``."""
    if len(centres) < 2 or x.shape[1] < 2:
        return 1
    rnd = np.random.default_rng(len(centres))
    shared = []
    for part in np.array_split(x[:8192], len(x[:8192]) // 512 + 1):
        away = rnd.normal(size=part.shape)
        away -= (away * part).sum(1, keepdims=True) * part
        away /= np.maximum(np.linalg.norm(away, axis=1, keepdims=True), 1e-300)
        ranks = [np.argsort(np.argsort(-(y @ centres.T), axis=1), axis=1) for y in (part, limit * part + (1 - limit ** 2) ** 0.5 * away)]
        shared.append(np.maximum(*ranks).min(1) + 1)
    return int(np.quantile(np.concatenate(shared), 1 - miss, method="higher"))


def fit_cells(classes: DataFrame, n: int, sample: int, max_cells: int, limit: float) -> dict[int, tuple[np.ndarray, int]]:
    """(centres, probes) by length of vector, fitted on about ``sample`` classes chosen by their hash."""
    part = classes.filter(F.pmod("k1", F.lit(1 << 20)) < min(1 << 20, max(1, (1 << 20) * sample // max(n, 1)))).select("vec").limit(2 * sample).toArrow()
    out: dict[int, list[np.ndarray]] = {}
    for chunk in part.column(0).chunks:
        for _, x in vectors(chunk):
            out.setdefault(x.shape[1], []).append(x)
    share = {d: np.concatenate(parts) for d, parts in out.items()}
    total = sum(map(len, share.values()))
    budget = {d: min(max_cells, CENTRE_BYTES // (8 * d * len(share)), int((n * len(x) / total) ** 0.5) + 1, len(x)) for d, x in share.items()}
    centres = {d: spherical_kmeans(x, max(1, budget[d])) for d, x in share.items()}
    return {d: (c, probes_for(share[d], c, limit, MISS)) for d, c in centres.items()}


def _placed(classes: DataFrame, cells, limit: float) -> DataFrame:
    """(cls, copies, vec, cells, core, dim): the probed cells of each class, and the cell in whose core it is (or -1)."""
    half = ((1 + limit) / 2) ** 0.5 + SLACK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = cells.value
        for batch in batches:
            vec = batch.column(2)
            near, core, dims = [[0]] * batch.num_rows, np.full(batch.num_rows, -1), np.zeros(batch.num_rows, np.int64)
            for at, x in vectors(vec):
                dims[at] = x.shape[1]
                if x.shape[1] not in fitted:
                    continue  # a length outside the sample: one cell
                c, probes = fitted[x.shape[1]]
                cos = x @ c.T
                best = np.argpartition(-cos, probes - 1, axis=1)[:, :probes]
                top = cos.argmax(1)
                core[at] = np.where(cos[np.arange(len(at)), top] >= half, top, -1)
                for i, row in zip(at.tolist(), best.tolist()):
                    near[i] = row
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), vec, pa.array(near, pa.list_(pa.int32())), pa.array(core.astype(np.int32)),
                                              pa.array(dims.astype(np.int32))], names=["cls", "copies", "vec", "cells", "core", "dim"])

    kind = classes.schema["vec"].dataType.simpleString()
    return classes.select("cls", "copies", "vec").mapInArrow(run, f"cls long, copies long, vec {kind}, cells array<int>, core int, dim int")


def block_links(table: pa.Table, cell: int, one: int, two: int, limit: float) -> pa.Table:
    """(cls, links, node, other): links of each class of two blocks with the other block (or inside one), and for every
    node but the first of a local component that first one as ``other``."""
    table = table.combine_chunks()
    blk = table.column("blk").to_numpy()
    node, cls, copies, core = (table.column(c).to_numpy() for c in ("node", "cls", "copies", "core"))
    near = table.column("cells").to_pylist()
    probed = np.full((len(near), max(map(len, near))), -1)
    for i, row in enumerate(near):
        probed[i, : len(row)] = row
    x = np.zeros((len(near), 0))
    for _, x in vectors(table.column("vec").chunk(0)):  # one length: it is part of the group's key
        pass
    left, right = np.flatnonzero(blk == one), np.flatnonzero(blk == two)
    found = []
    for rows in np.array_split(left, len(left) // 256 + 1):
        a, b = np.nonzero(x[rows] @ x[right].T >= limit)
        a, b = rows[a], right[b]
        if one == two:
            a, b = a[a < b], b[a < b]
        both = probed[a][:, :, None] == probed[b][:, None, :]
        least = np.where(both & (probed[a][:, :, None] >= 0), probed[a][:, :, None], 1 << 30).min(axis=(1, 2))
        new = (least == cell) & ((core[a] != core[b]) | (core[a] < 0))
        found.append((a[new], b[new]))
    a, b = (np.concatenate(z) for z in zip(*found)) if found else (np.zeros(0, int), np.zeros(0, int))
    links = np.bincount(a, weights=copies[b], minlength=len(cls)) + np.bincount(b, weights=copies[a], minlength=len(cls))
    root = label_of(len(cls), a, b)
    some = (links > 0) | (root != np.arange(len(cls)))
    return pa.table({"cls": cls[some], "links": links[some].astype(np.int64), "node": node[some], "other": node[root][some]})


def _met(placed: DataFrame, limit: float, block: int) -> DataFrame:
    """(cls, links, node, other) of every pair of blocks that has links; ``placed`` has each class's node."""
    in_cell = placed.select("*", F.explode("cells").alias("cell")).withColumn("inner", (F.col("core") == F.col("cell")).cast("int"))
    sizes = placed.select("dim", "core", F.explode("cells").alias("cell")).groupBy("dim", "cell").agg(
        F.count_if(F.col("core") != F.col("cell")).alias("outer"), F.count_if(F.col("core") == F.col("cell")).alias("inside"))
    sizes = sizes.filter("outer > 0").select("dim", "cell", F.ceil(F.col("outer") / block).cast("int").alias("n_outer"), F.ceil(F.col("inside") / block).cast("int").alias("n_inner"))
    # outer blocks are 0 .. n_outer - 1, the core's blocks follow
    blk = F.when(F.col("inner") == 0, F.pmod(F.xxhash64("cls"), F.col("n_outer"))).otherwise(F.col("n_outer") + F.pmod(F.xxhash64("cls"), F.greatest("n_inner", F.lit(1))))
    rows = in_cell.join(small(sizes), ["dim", "cell"]).withColumn("blk", blk.cast("int"))
    last = F.when(F.col("inner") == 0, F.col("n_outer") + F.col("n_inner")).otherwise(F.col("n_outer")) - 1
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), last)).alias("with"))
    rows = rows.withColumns({"one": F.least("blk", "with"), "two": F.greatest("blk", "with")})

    def run(key, table):
        _, cell, one, two = (k.as_py() for k in key)
        return block_links(table, cell, one, two, limit)

    rows = rows.select("dim", "cell", "one", "two", "blk", "cls", "node", "copies", "core", "cells", "vec")
    return rows.groupBy("dim", "cell", "one", "two").applyInArrow(run, "cls long, links long, node long, other long")


def near_vectors(docs: DataFrame, scratch: Scratch, *, id_col: str = "vec_id", vec_col: str = "embedding", limit: float = LIMIT,
                 block: int = BLOCK, sample: int = SAMPLE, max_cells: int = MAX_CELLS) -> DataFrame:
    """One row per row of ``docs``: id, n_links (other vectors with a cosine of ``limit`` and more), component_id, kept."""
    spark = docs.sparkSession
    vec = F.col(vec_col)
    if docs.schema[vec_col].dataType.simpleString() not in ("array<float>", "array<double>"):
        vec = vec.cast("array<double>")
    odd = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = F.coalesce(~odd & F.exists(vec, lambda x: x != 0), F.lit(False))
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.when(good, vec).alias("vec"))
    rows = rows.withColumns({"k1": F.when(F.col("vec").isNotNull(), F.xxhash64("vec")), "k2": F.when(F.col("vec").isNotNull(), F.xxhash64(F.lit(1), "vec", F.lit(2)))})
    classes = rows.filter(F.col("vec").isNotNull()).groupBy("k1", "k2").agg(F.min("id").alias("first_id"), F.count("*").alias("copies"), F.first("vec").alias("vec"))
    classes = scratch.keep(classes.withColumn("cls", F.monotonically_increasing_id()), "classes")
    n = classes.count()
    cells = spark.sparkContext.broadcast(fit_cells(classes, n, sample, max_cells, limit))
    placed = scratch.keep(_placed(classes, cells, limit), "placed")
    cores = placed.filter("core >= 0").groupBy("dim", "core").agg(F.min("cls").alias("node"), F.sum("copies").alias("inside"))
    cores = scratch.keep(cores, "cores")  # as many rows as there are cells at most
    placed = placed.join(small(cores), ["dim", "core"], "left").withColumn("node", F.coalesce("node", "cls"))
    met = scratch.keep(_met(placed, limit, block), "met")
    edges = met.filter("node != other").select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
    labels = components(scratch.keep(edges, "edges"), scratch, "labels").withColumnRenamed("cls", "node")
    links = met.groupBy("cls").agg(F.sum("links").alias("links"))
    # an own copy links with the others, a core with the rest of it
    whole = placed.select("cls", "node", "copies", "inside").join(classes.select("cls", "k1", "k2", "first_id"), "cls").join(links, "cls", "left").join(small(labels), "node", "left")
    whole = whole.select("k1", "k2", "first_id", F.coalesce("label", "node").alias("label"), (F.coalesce("links", F.lit(0)) + F.coalesce("inside", "copies") - 1).alias("n_links"))
    whole = scratch.keep(whole, "whole")
    first = scratch.keep(whole.groupBy("label").agg(F.min("first_id").alias("component"), F.count("*").alias("c")).filter("c > 1").drop("c"), "components")
    of_class = whole.join(small(first), "label", "left").select("k1", "k2", "n_links", F.coalesce("component", "first_id").alias("component"))
    out = rows.select("id", "k1", "k2").join(of_class, ["k1", "k2"], "left").withColumn("component", F.coalesce("component", "id"))
    back = {c: F.when(F.col(c) != NO_ID, F.col(c)) for c in ("id", "component")}
    return out.select(back["id"].alias(id_col), F.coalesce("n_links", F.lit(0)).alias("n_links"), back["component"].alias("component_id"),
                      (F.col("id") == F.col("component")).alias("kept"))


def op11_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(documents(spark, sf_dir, "embeddings"), Scratch(spark, "vectors"))


QUERIES = {"op11_embedding_dedup": op11_embedding_dedup}

ORACLES = {"op11_embedding_dedup": f"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v AS a JOIN v AS b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= {LIMIT}),
reach AS (SELECT vec_id, vec_id AS other FROM embeddings UNION SELECT r.vec_id, l.b FROM reach AS r JOIN links AS l ON l.a = r.other),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a), c AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, c.component_id, e.vec_id = c.component_id AS kept FROM embeddings AS e JOIN c USING (vec_id) LEFT JOIN n ON n.a = e.vec_id
"""}
