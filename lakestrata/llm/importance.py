"""Operator 7: quality classifier by importance resampling.

Two generative models over hashed word n-grams: one of the target (labelled good texts), one of all raw
texts. A document's log weight is the sum of log(target / raw) over its n-grams; adding Gumbel noise and
keeping the k largest is a draw of k documents without replacement in proportion to the weights.

The raw model counts every n-gram of every document; only the labelled rows are bounded (``MAX_LABELS``,
those with the smallest hash of their id). The models are ``BUCKETS`` sums, whatever the number of
documents: a task sends its counts as ``BUCKETS / CHUNK`` packed rows, which are added up as a stream.

With c target and r raw counts in a bucket and s the target's part of all n-grams, the ratio is
(c + SMOOTHING) / (s * r + SMOOTHING), where c differs from its expectation s * r by more than
``SIGNIFICANT`` standard deviations, and else 1: words that few texts use say nothing.

``HELD_OUT`` percent of the labelled rows are kept from the fit. Unless k is given, it is the number of documents
whose key reaches the one that ``GOOD_KEPT`` percent of the good held-out rows reach. The k-th largest key is found
by narrowing a histogram: each round returns ``BINS`` counts. Documents that are not drawn are rejected.

Defined results: a null or empty text has no n-gram, no weight, and is rejected; rows with equal keys at the
limit are all kept; a label row counts once per id (good only if no row of the id says otherwise); without
labels every document with a word is kept; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.llm.tables import Scratch, documents
from lakestrata.llm.words import Words, mix64, word_slices

BUCKETS, CHUNK = 1 << 20, 1 << 10
MAX_LABELS = 100_000
SMOOTHING, SIGNIFICANT = 1.0, 3.0
HELD_OUT, GOOD_KEPT = 20, 98
TEMPERATURE = 1.0
BINS = 1024
SEED = 7
_U = np.uint64


def ngram_buckets(w: Words, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, document) of every word and every two consecutive words."""
    words = w.hashes()
    doc = w.doc_of_word()
    at, pairs = w.windows(2, words)
    h = np.concatenate([mix64(words), pairs])
    return ((h >> _U(32)) * _U(buckets) >> _U(32)).astype(np.int64), np.concatenate([doc, doc[at]])


def label_sample(labels: DataFrame, limit: int = MAX_LABELS) -> DataFrame:
    """(id, good, held) of at most ``limit`` labelled ids."""
    good = (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    one = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(F.min(good).alias("good"))
    held = F.pmod(F.xxhash64("id", F.lit("held")), F.lit(100)) < HELD_OUT
    return one.orderBy(F.xxhash64("id"), "id").limit(limit).withColumn("held", held)


def count_ngrams(rows: DataFrame, buckets: int) -> DataFrame:
    """(chunk, raw, target): packed sums of ``rows`` (text, good) for each ``CHUNK`` buckets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            good = batch.column(1).fill_null(False).to_numpy(zero_copy_only=False)
            for lo, hi, w in word_slices(batch.column(0)):
                bucket, doc = ngram_buckets(w, buckets)
                raw += np.bincount(bucket, minlength=buckets)
                target += np.bincount(bucket[good[lo:hi][doc]], minlength=buckets)
        parts = [[x.tobytes() for x in np.split(a, range(CHUNK, buckets, CHUNK))] for a in (raw, target)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(parts[0])), pa.int32()), *(pa.array(p, pa.binary()) for p in parts)],
                                         names=["chunk", "raw", "target"])

    def add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(min(CHUNK, buckets), np.int64) for _ in range(2)]
        for batch in batches:
            for name, total in zip(("raw", "target"), sums):
                for x in batch.column(name):
                    total[: len(x.as_buffer()) // 8] += np.frombuffer(x.as_buffer(), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in sums)],
                                         names=["chunk", "raw", "target"])

    schema = "chunk int, raw binary, target binary"
    return rows.mapInArrow(run, schema).groupBy("chunk").applyInArrow(add, schema)


def log_ratio(counts: DataFrame, buckets: int, smoothing: float = SMOOTHING, significant: float = SIGNIFICANT) -> np.ndarray:
    """log(target / raw) per bucket, on the driver: ``buckets`` numbers."""
    rows = sorted(counts.collect(), key=lambda r: r["chunk"])
    raw, target = (np.concatenate([np.frombuffer(r[c], np.int64) for r in rows] or [np.zeros(0, np.int64)])[:buckets].astype(float)
                   for c in ("raw", "target"))
    if not target.sum():
        return np.zeros(buckets)
    s = target.sum() / raw.sum()
    deviation = np.sqrt(np.maximum(raw * s * (1 - s), 1e-9))
    ratio = np.log((target + smoothing) / (raw * s + smoothing))
    return np.where(np.abs(target - s * raw) >= significant * deviation, ratio, 0.0)


def batch_keys(texts: pa.Array, ties: pa.Array, ratio: np.ndarray, seed: int, temperature: float):
    """(words, log weight, key, whether there is a word) of each text of a batch: key is the weight plus
    Gumbel noise from the hash ``ties``."""
    n_words, weight = np.zeros(len(texts), np.int64), np.zeros(len(texts))
    for lo, hi, w in word_slices(texts):
        bucket, doc = ngram_buckets(w, len(ratio))
        order = np.argsort(doc, kind="stable")
        some = w.counts > 0
        n_words[lo:hi] = w.counts
        if some.any():  # each document is summed alone, however the rows are sliced
            first = np.searchsorted(doc[order], np.flatnonzero(some))
            weight[lo:hi][some] = np.add.reduceat(ratio[bucket[order]], first)
    noise = mix64(ties.to_numpy().view(np.uint64) ^ mix64(np.full(len(texts), seed, np.uint64)))
    u = ((noise >> _U(12)).astype(np.float64) + 0.5) / float(1 << 52)
    return n_words, weight, weight - temperature * np.log(-np.log(u)), n_words > 0


def weigh(rows: DataFrame, ratio: np.ndarray, seed: int, temperature: float) -> DataFrame:
    """(id, n_words, log_weight, key) of ``rows`` (id, text, tie); weight and key are null without a word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, weight, key, some = batch_keys(batch.column(1), batch.column(2), ratio, seed, temperature)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words), pa.array(weight, mask=~some), pa.array(key, mask=~some)],
                                             names=["id", "n_words", "log_weight", "key"])

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {id_type}, n_words long, log_weight double, key double")


def kth_largest(keys: DataFrame, k: int) -> float | None:
    """The k-th largest of the column ``key`` (nulls do not count); None if there are fewer."""
    lo, hi, n = keys.agg(F.min("key"), F.max("key"), F.count("key")).first()
    if k <= 0 or n < k:
        return None
    while lo < hi:
        width = (hi - lo) / BINS
        place = F.least(F.floor((F.col("key") - F.lit(lo)) / F.lit(width)), F.lit(BINS - 1)) if width > 0 else F.lit(0)
        bins = keys.filter(F.col("key").between(lo, hi)).groupBy(place.alias("bin")).agg(
            F.count("*").alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi")).orderBy(F.desc("lo")).collect()  # at most BINS rows
        for b in bins:
            if k <= b["n"]:
                break
            k -= b["n"]
        if (b["lo"], b["hi"]) == (lo, hi):  # neighbouring numbers: too close for a histogram
            return _among_two(keys, lo, hi, k)
        lo, hi = b["lo"], b["hi"]
    return lo


def _among_two(keys: DataFrame, lo: float, hi: float, k: int) -> float:
    top = keys.filter(F.col("key") == hi).count()
    return hi if k <= top else lo


@dataclass(frozen=True)
class Draw:
    """A fitted draw: the buckets' log ratios and the smallest key that is kept (None: any)."""

    ratio: np.ndarray
    limit: float | None
    seed: int
    temperature: float


def _tied(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(F.col(id_col), text).alias("tie"))


def fit(docs: DataFrame, labels: DataFrame, scratch: Scratch, *, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS,
        max_labels: int = MAX_LABELS, temperature: float = TEMPERATURE, seed: int = SEED, k: int | None = None) -> tuple[Draw, DataFrame]:
    """The draw, and (id, n_words, log_weight, key) of every row of ``docs``."""
    sample = scratch.keep(label_sample(labels, max_labels), "labels")
    tied = _tied(docs, id_col, text_col)
    # the sample is bounded: at most max_labels rows of three small columns
    counted = tied.join(F.broadcast(sample), "id", "left").select("text", (F.col("good") & ~F.col("held")).alias("good"))
    ratio = log_ratio(count_ngrams(counted, buckets), buckets)
    keys = scratch.keep(weigh(tied, ratio, seed, temperature), "keys")
    held = scratch.keep(keys.join(F.broadcast(sample.filter("held")), "id").filter("key IS NOT NULL"), "held")
    if k is None:
        limit = held.filter("good").agg(F.percentile("key", F.lit(1 - GOOD_KEPT / 100))).first()[0]
    else:
        limit = kth_largest(keys, k)
    return Draw(ratio, limit, seed, temperature), keys


def resample(docs: DataFrame, labels: DataFrame, scratch: Scratch, *, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One row per row of ``docs``: id, n_words, log_weight, key, kept."""
    draw, keys = fit(docs, labels, scratch, id_col=id_col, text_col=text_col, **how)
    kept = F.col("key").isNotNull() if draw.limit is None else F.coalesce(F.col("key") >= F.lit(draw.limit), F.lit(False))
    return keys.withColumn("kept", kept).withColumnRenamed("id", id_col)


def accepted(docs: DataFrame, labels: DataFrame, scratch: Scratch, *, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` that are drawn, unchanged: keys are computed anew beside the rows, so nothing
    is joined or shuffled."""
    draw, _ = fit(docs, labels, scratch, id_col=id_col, text_col=text_col, **how)
    limit = -np.inf if draw.limit is None else draw.limit
    both = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
                       F.xxhash64(F.col(id_col), F.coalesce(F.col(text_col), F.lit(""))).alias("tie"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # the text comes once, inside its row
            _, _, key, some = batch_keys(batch.column(0).field(text_col), batch.column(1), draw.ratio, draw.seed, draw.temperature)
            yield batch.select([0]).filter(pa.array(some & (key >= limit)))

    return both.mapInArrow(run, T.StructType([both.schema["row"]])).select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns))


def op7_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(documents(spark, sf_dir), documents(spark, sf_dir, "labels"), Scratch(spark, "importance"))


QUERIES = {"op7_importance": op7_importance}
ORACLES: dict[str, str] = {}
