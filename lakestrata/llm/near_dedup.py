"""Operator 8: near duplicates by fast similarity sketching, banding and exact verification.

*Sketch.* A set of word shingles fills t bins: in round i every shingle falls into one bin with the value
(i, hash); a bin keeps its smallest value, and rounds go on until no bin is empty. From round t on every
shingle goes into one given bin, so each coordinate fills for any set; large sets need one round. Equal coordinates estimate the Jaccard similarity with concentration bounds.

*Classes.* Rows with equal shingle sets are one class; everything after this works on classes.

*Buckets.* Bands of ``ROWS`` coordinates; classes with an equal band meet in a bucket. There are so many bands
that two sets at the limit miss each other in all of them with a probability below ``MISS``.

*Verification.* Pairs are confirmed on the full shingle sets. A bucket never gives all its pairs: first its
centre (the class that meets most others) meets the rest. Then only classes in different components are left.
Of their shingles, those that at most ``RARE`` of them have are joined with each other: this counts what every
pair has in common of these. A pair without any has at most its cores, the other shingles, in common, which
rules out copies with edits of their own, and classes with a small core altogether. Of what remains each bucket
gives ``CENTRES`` more classes against its others, round after round, until no pair in different components
is unverified: no link is lost, however large the bucket.

*Components.* Links are joined by rounds of smallest-label exchange and pointer jumping, a few of them in one task; links
found later join labels, not classes. Links, components and sketches stay in tables; the driver sees counts only.

Defined results: a null or empty text has an empty set and is linked with nothing; null ids count as larger
than any other and give a null component id only among themselves; rows with equal ids are linked by their
texts; other columns do not matter. ``one_of_each`` leaves exactly one row of a component: the smallest id, among
equal or null ids the smallest hash of the text, among rows with equal ids and texts the smallest row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakestrata.llm.tables import MAX_BROADCAST_KEYS, Scratch, documents, small
from lakestrata.llm.words import Words, mix64, word_slices

SHINGLE, PERCENT = 5, 80
ROWS = 4
MISS = 1e-7  # chance that two sets at the limit share no band
CENTRES = 32
RARE = 8
#: links whose components are found in one task (16 bytes each)
ONE_TASK = 1 << 16
NO_ID = (1 << 63) - 1
_U = np.uint64


def bands_for(percent: int) -> int:
    return math.ceil(math.log(MISS) / math.log(1 - (percent / 100) ** ROWS))


def _seeds(n: int) -> np.ndarray:
    return mix64(np.arange(1, n + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))


def shingle_sets(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of all documents one after the other, where each document's begin).
    A document of fewer than k words is one shingle."""
    words = w.hashes()
    counts = w.counts
    at, h = w.windows(k, words)
    doc = np.searchsorted(w.first, at, side="right") - 1
    for n in range(1, k):
        short = counts == n
        if short.any():
            begin, g = w.windows(n, words)
            of = np.searchsorted(w.first, begin, side="right") - 1
            at_short = short[of]
            doc, h = np.concatenate([doc, of[at_short]]), np.concatenate([h, g[at_short]])
    order = np.argsort(doc, kind="stable")
    doc, h = doc[order], h[order]
    first = np.searchsorted(doc, np.arange(len(counts) + 1))
    for lo, hi in zip(first[:-1].tolist(), first[1:].tolist()):
        h[lo:hi].sort()
    if len(h):
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])])
        h, doc = h[new], doc[new]
    return h, np.searchsorted(doc, np.arange(len(counts) + 1))


def sketches(h: np.ndarray, first: np.ndarray, t: int) -> np.ndarray:
    """Fast similarity sketches of the sets, one row of t coordinates each; empty sets keep the largest value."""
    n = len(first) - 1
    out = np.full(n * t, np.iinfo(np.uint64).max, np.uint64)
    doc = np.repeat(np.arange(n), np.diff(first))
    seeds = _seeds(2 * t)
    for i in range(2 * t):
        if not len(h):
            break
        g = mix64(h ^ seeds[i])
        place = ((g >> _U(32)) * _U(t) >> _U(32)).astype(np.int64) if i < t else np.full(len(h), i - t)
        np.minimum.at(out, doc * t + place, (_U(i) << _U(56)) | (mix64(g) >> _U(8)))
        full = (out.reshape(n, t) != np.iinfo(np.uint64).max).all(1)
        live = ~full[doc]
        h, doc = h[live], doc[live]
    return out.reshape(n, t)


def band_keys(sketch: np.ndarray, bands: int) -> np.ndarray:
    key = np.repeat(_seeds(bands)[None, :], len(sketch), 0)
    parts = sketch.reshape(len(sketch), bands, sketch.shape[1] // bands)
    for j in range(parts.shape[2]):
        key = mix64((key ^ parts[:, :, j]) * _U(0x9E3779B97F4A7C15))
    return key


def _sum_by_set(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x)])
    return upto[first[1:]] - upto[first[:-1]]


def _signatures(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each set, independent of how the rows are sliced."""
    return (_sum_by_set(mix64(h ^ _U(0x1F83D9ABFB41BD6B)), first).view(np.int64),
            _sum_by_set(mix64(h * _U(0xD6E8FEB86659FD93) + _U(0x5BE0CD19137E2179)), first).view(np.int64))


def _sketch_rows(rows: DataFrame, k: int, bands: int) -> DataFrame:
    """(id, n, sig1, sig2, bands) of (id, text); further columns, all of them long, come along."""
    more = rows.columns[2:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, w in word_slices(batch.column(1), "space", True):
                h, first = shingle_sets(w, k)
                n = np.diff(first)
                some = n > 0
                keys = band_keys(sketches(h, first, bands * ROWS)[some], bands).view(np.int64)
                sig1, sig2 = _signatures(h, first)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(some * bands)]).astype(np.int32)), pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(n.astype(np.int64)), pa.array(sig1),
                                                  pa.array(sig2), lists, *(batch.column(c).slice(lo, hi - lo) for c in more)],
                                                 names=["id", "n", "sig1", "sig2", "bands", *more])

    return rows.mapInArrow(run, ", ".join(["id long, n long, sig1 long, sig2 long, bands array<long>", *(f"{c} long" for c in more)]))


def _set_rows(rows: DataFrame, k: int) -> DataFrame:
    """(id, n, sig1, sig2, shingles) of (id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, w in word_slices(batch.column(1), "space", True):
                h, first = shingle_sets(w, k)
                sig1, sig2 = _signatures(h, first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(np.diff(first).astype(np.int64)), pa.array(sig1), pa.array(sig2),
                     pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(h.view(np.int64)))],
                    names=["id", "n", "sig1", "sig2", "shingles"])

    return rows.mapInArrow(run, "id long, n long, sig1 long, sig2 long, shingles array<long>")


def _class_key() -> Column:
    return F.xxhash64("sig1", "sig2", "n")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (a, b) of ``pairs`` with 100 * intersection >= percent * union of their ``sets`` (cls, shingles)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            one, two = batch.column(2), batch.column(3)
            x, xo = one.values.to_numpy().view(np.uint64), one.offsets.to_numpy()
            y, yo = two.values.to_numpy().view(np.uint64), two.offsets.to_numpy()
            for i in range(batch.num_rows):
                p, q = x[xo[i]: xo[i + 1]], y[yo[i]: yo[i + 1]]
                both = np.concatenate([p, q])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                keep[i] = 100 * common >= percent * (len(both) - common)
            yield batch.select([0, 1]).filter(pa.array(keep))

    with_b = pairs.join(sets.select(F.col("cls").alias("b"), F.col("shingles").alias("of_b")), "b")
    both = with_b.join(sets.select(F.col("cls").alias("a"), F.col("shingles").alias("of_a")), "a").select("a", "b", "of_a", "of_b")
    return both.mapInArrow(run, "a long, b long")


def label_of(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest one that links (a, b) connect it with."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        after = label.copy()
        np.minimum.at(after, a, low)
        np.minimum.at(after, b, low)
        after = after[after]
        if (after == label).all():
            return label
        label = after


def _few_components(links: DataFrame) -> DataFrame:
    """(cls, label) of at most ``ONE_TASK`` links, in one task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches), schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))
        ends = [table.column(c).to_numpy() for c in (0, 1)]
        nodes, at = np.unique(np.concatenate(ends), return_inverse=True)
        label = label_of(len(nodes), at[: len(ends[0])], at[len(ends[0]):])
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[label])], names=["cls", "label"])

    return links.select("a", "b").coalesce(1).mapInArrow(run, "cls long, label long")


def components(links: DataFrame, scratch: Scratch, tag: str) -> DataFrame:
    """(cls, label): the smallest key of each component of the written ``links`` (a, b). Up to ``ONE_TASK`` links are one
    step. More take rounds: each gives a node the smallest label of itself and its neighbours, by one shuffle, and then
    its label's label."""
    if links.count() <= ONE_TASK:
        return scratch.keep(_few_components(links), f"{tag}-labels")
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = scratch.keep(both.distinct(), f"{tag}-edges")
    labels = scratch.keep(edges.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("label")).withColumnRenamed("a", "cls"), f"{tag}-0")
    hint = F.broadcast if labels.count() <= MAX_BROADCAST_KEYS else lambda x: x
    step = 0
    while True:
        step += 1
        of = hint(labels.select(F.col("cls").alias("at"), F.col("label").alias("over")))
        offered = edges.join(of, F.col("b") == F.col("at")).select(F.col("a").alias("cls"), F.col("over").alias("label"), F.lit(None).cast("long").alias("was"))
        lower = offered.union(labels.select("cls", "label", F.col("label").alias("was"))).groupBy("cls").agg(F.min("label").alias("label"), F.max("was").alias("was"))
        moved = scratch.keep(lower.join(of, F.col("label") == F.col("at"), "left").select("cls", "was", F.least("label", F.coalesce("over", "label")).alias("label")),
                             f"{tag}-{step}")
        if step > 1:
            scratch.drop(f"{tag}-{step - 2}")
        if not moved.filter("label < was").limit(1).count():
            scratch.drop(f"{tag}-edges", f"{tag}-{step - 1}")
            return moved.select("cls", "label")
        labels = moved.select("cls", "label")


def with_links(labels: DataFrame, more: DataFrame, scratch: Scratch, tag: str) -> DataFrame:
    """The labels after further written links (a, b): components are searched among labels, not among nodes."""
    of = small(labels)
    ends = more
    for side in ("a", "b"):
        ends = ends.join(of.select(F.col("cls").alias(side), F.col("label").alias(f"of_{side}")), side, "left")
    ends = ends.select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b")).filter("a != b").distinct()
    joined = components(scratch.keep(ends, f"{tag}-ends"), scratch, tag).select(F.col("cls").alias("old"), F.col("label").alias("now"))
    few = small(joined)
    known = labels.join(few, F.col("label") == F.col("old"), "left").select("cls", F.coalesce("now", "label").alias("label"))
    new = joined.join(of, F.col("old") == F.col("cls"), "left_anti").select(F.col("old").alias("cls"), F.col("now").alias("label"))
    return scratch.keep(known.union(new), f"{tag}-all")


def _rare_shingles(sets: DataFrame, left: DataFrame) -> DataFrame:
    """(s, cls): the shingles that at most ``RARE`` of the classes ``left`` have, with those classes."""
    each = sets.join(left.select("cls").distinct(), "cls", "left_semi").select("cls", F.explode("shingles").alias("s"))
    few = each.groupBy("s").agg(F.count("*").alias("c")).filter(F.col("c") <= RARE).select("s")
    return each.join(few, "s")


def find_links(members: DataFrame, meets: DataFrame, sets: DataFrame, scratch: Scratch, percent: int) -> tuple[DataFrame, DataFrame]:
    """(links, labels): links (a, b) between classes that share a bucket, all up to ones inside a component, and the
    components' (cls, label). ``members``: (bucket, cls, n, copies); ``meets``: (cls, meets), how many others a class
    meets over all its buckets."""
    def alike(a: Column, b: Column) -> Column:
        return 100 * F.least(a, b) >= percent * F.greatest(a, b)

    def may_link(common: Column, a: Column, b: Column) -> Column:
        """Whether sets of a and b shingles with at most ``common`` common ones can reach the limit."""
        return (100 + percent) * common >= percent * (a + b)

    # a bucket's centre is the class that meets most others: copies meet their origin more often than each other
    centre = members.join(small(meets.select("cls", "meets")), "cls").groupBy("bucket").agg(F.max(F.struct("meets", "copies", "cls", "n")).alias("c"))
    centres = small(scratch.keep(centre.select("bucket", F.col("c.cls").alias("a"), F.col("c.n").alias("n_a")), "centres"))
    others = members.join(centres, "bucket").filter(F.col("cls") != F.col("a"))
    pairs = others.filter(alike(F.col("n"), F.col("n_a"))).select("a", F.col("cls").alias("b")).distinct()
    links = scratch.keep(verified(small(scratch.keep(pairs, "pairs-0")), sets, percent), "links-0")
    labels, step, left = components(links, scratch, "round-0"), 0, others.select(*members.columns)
    while True:
        # classes in buckets that still hold two components, without those that met all others there; a class whose core
        # is too small for the smallest other one of its bucket is settled there
        now = left.drop("label").join(small(labels), "cls", "left").withColumn("label", F.coalesce("label", "cls"))
        alive = F.lit(True) if "core" not in now.columns else may_link(F.col("core"), F.col("n"), F.col("least_n"))
        now = scratch.keep(_open(now, alive), f"open-{step}")
        if not now.limit(1).count():
            return links, labels
        step += 1
        of_rare = None
        if step == 1:
            # pairs with a rare shingle in common are counted out; all others have at most their cores in common
            rare = scratch.keep(_rare_shingles(sets, now), "rare")
            own = members.groupBy("cls").agg(F.collect_set("bucket").alias("own"))  # as many as there are bands at most
            cores = now.select("cls", "n", "label").distinct().join(small(scratch.keep(rare.groupBy("cls").agg(F.count("*").alias("rare")), "n-rare")), "cls", "left")
            cores = cores.select("cls", "n", "label", (F.col("n") - F.coalesce("rare", F.lit(0))).alias("core")).join(own, "cls")
            cores = scratch.keep(cores, "cores")
            facts = small(cores.drop("own"))
            shared = rare.select("s", F.col("cls").alias("a")).join(rare.select("s", F.col("cls").alias("b")), "s").filter("a < b")
            shared = shared.groupBy("a", "b").agg(F.count("*").alias("both"))
            for side in ("a", "b"):
                shared = shared.join(facts.select(*(F.col(c).alias(f"{c}_{side}" if c != "cls" else side) for c in ("cls", "n", "label", "core"))), side)
            of_rare = shared.filter((F.col("label_a") != F.col("label_b")) & alike(F.col("n_a"), F.col("n_b"))
                                    & may_link(F.col("both") + F.least("core_a", "core_b"), F.col("n_a"), F.col("n_b"))).select("a", "b")
            now = now.join(cores.select("cls", "core", "own"), "cls")
            now = scratch.keep(_open(now, may_link(F.col("core"), F.col("n"), F.col("least_n"))), "left-1")
        # a bucket's first classes, those of small components before others
        size = small(scratch.keep(now.groupBy("bucket", "label").agg(F.count("*").alias("in_bucket")), f"sizes-{step}"))
        order = Window.partitionBy("bucket").orderBy("in_bucket", "n", "label", "cls")
        first = now.join(size, ["bucket", "label"]).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= CENTRES)
        first = scratch.keep(first.select("bucket", F.col("cls").alias("a"), F.col("n").alias("n_a"), F.col("core").alias("core_a"),
                                          F.col("label").alias("label_a"), F.col("own").alias("own_a")), f"centres-{step}")
        pairs = now.join(first, "bucket").filter((F.col("label") != F.col("label_a")) & alike(F.col("n"), F.col("n_a"))
                                                 & may_link(F.least("core", "core_a"), F.col("n"), F.col("n_a"))
                                                 # a pair is met in the least of its common buckets only
                                                 & (F.array_min(F.array_intersect("own", "own_a")) == F.col("bucket")))
        pairs = pairs.select(F.least("a", "cls").alias("a"), F.greatest("a", "cls").alias("b"))
        pairs = scratch.keep((pairs if of_rare is None else pairs.union(of_rare)).distinct(), f"pairs-{step}")
        if pairs.limit(1).count():
            more = scratch.keep(verified(small(pairs), sets, percent), f"links-{step}")
            if more.limit(1).count():
                links = links.union(more)
                labels = with_links(labels, more, scratch, f"round-{step}")
        left = now.join(small(first.select("bucket", F.col("a").alias("cls"))), ["bucket", "cls"], "left_anti")


def _open(now: DataFrame, alive: Column) -> DataFrame:
    """The rows of ``now`` that are ``alive``, in buckets that hold two components; ``alive`` may use the
    bucket's ``least_n``."""
    now = now.drop("least_n", "lo", "hi")
    of_bucket = now.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.min("n").alias("least_n")).filter("lo < hi")
    return now.join(of_bucket, "bucket").filter(alive).drop("least_n", "lo", "hi")


def _id(id_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))


def _text_hash(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def _classes(docs: DataFrame, scratch: Scratch, id_col: str, text_col: str, shingle: int, percent: int,
             hashed: bool = False) -> tuple[DataFrame, DataFrame]:
    """(id, n, cls[, text_hash]) of every row, and (cls, first_id, label): the component of each class."""
    rows = docs.select(_id(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *[_text_hash(text_col).alias("text_hash")] * hashed)
    every = scratch.keep(_sketch_rows(rows, shingle, bands_for(percent)).withColumn("cls", _class_key()), "sketches")
    classes = every.filter("n > 0").groupBy("cls").agg(F.min("id").alias("first_id"), F.first("n").alias("n"), F.count("*").alias("copies"),
                                                       F.first("bands").alias("bands"))
    classes = scratch.keep(classes, "classes")
    keyed = classes.select("cls", "n", "copies", "first_id", F.explode("bands").alias("bucket"))
    shared = scratch.keep(keyed.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1"), "buckets")
    members = scratch.keep(keyed.join(small(shared), "bucket"), "members")
    wanted = scratch.keep(members.groupBy("cls", "first_id").agg(F.sum("size").alias("meets")), "wanted")
    # texts of other classes under a first id, which rows with equal ids give, go again by their class
    text = rows.select("id", "text").join(small(wanted.select(F.col("first_id").alias("id")).distinct()), "id", "left_semi")
    sets = _set_rows(text, shingle).withColumn("cls", _class_key()).join(small(wanted.select("cls")), "cls", "left_semi")
    sets = scratch.keep(sets.dropDuplicates(["cls"]).select("cls", "shingles"), "sets")
    _, labels = find_links(members.drop("size", "first_id"), wanted, sets, scratch, percent)
    named = classes.select("cls", "first_id").join(labels, "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    return every.drop("sig1", "sig2", "bands"), named


def near_duplicates(docs: DataFrame, scratch: Scratch, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id (the smallest id of its component), kept."""
    every, named = _classes(docs, scratch, id_col, text_col, shingle, percent)
    # copies first, so that a component of any size is one small row per class
    first = scratch.keep(named.groupBy("label").agg(F.min("first_id").alias("component")), "components")
    of_class = scratch.keep(named.select("cls", "label").join(first, "label").select("cls", "component"), "class-components")
    out = every.select("id", "n", "cls").join(of_class, "cls", "left").withColumn("component", F.coalesce("component", "id"))
    back = {c: F.when(F.col(c) != NO_ID, F.col(c)) for c in ("id", "component")}
    return out.select(back["id"].alias(id_col), F.col("n").alias("n_shingles"), back["component"].alias("component_id"),
                      (F.col("id") == F.col("component")).alias("kept"))


def one_of_each(docs: DataFrame, scratch: Scratch, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component."""
    every, named = _classes(docs, scratch, id_col, text_col, shingle, percent, hashed=True)
    best = every.filter("n > 0").groupBy("cls").agg(F.min(F.struct("id", "text_hash")).alias("best"), F.count("*").alias("rows"))
    best = scratch.keep(named.select("cls", "label").join(best, "cls"), "best")
    first = best.groupBy("label").agg(F.min("best").alias("first"), F.sum("rows").alias("rows")).filter("rows > 1")
    first = scratch.keep(first.select("label", "first"), "components")
    of_class = scratch.keep(best.select("cls", "label").join(first, "label").select("cls", "first"), "class-components")
    each = every.select("cls", "id", "text_hash").join(of_class, "cls").withColumn("stays", F.struct("id", "text_hash") == F.col("first"))
    # rows with equal ids and texts are one, so that a key of any size is one small row
    each = each.groupBy("id", "text_hash", "stays").agg(F.count("*").alias("copies")).filter("copies > 1 or not stays")
    each = scratch.keep(each.select(F.col("id").alias("__id"), F.col("text_hash").alias("__hash"), F.col("stays").alias("__stays")), "gone")
    same = (_id(id_col) == F.col("__id")) & (_text_hash(text_col) == F.col("__hash"))
    rest = docs.join(small(each), same, "left_anti")
    repeated = docs.join(small(each.filter("__stays")), same, "left_semi").select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__row"))
    least = repeated.groupBy(_id(f"__row.{id_col}").alias("__id"), _text_hash(f"__row.{text_col}").alias("__hash")).agg(F.min("__row").alias("__row"))
    return rest.unionByName(least.select("__row.*"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), Scratch(spark, "near"), shingle=3, percent=85)


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"
QUERIES = {"op8_near_dedup": op8_near_dedup}

ORACLES = {"op8_near_dedup": rf"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
pos AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s FROM pos),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh AS a JOIN sh AS b USING (s) WHERE a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS other FROM d UNION SELECT r.doc_id, e.b FROM reach AS r JOIN edges AS e ON e.a = r.other)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) AS c USING (doc_id)
"""}
