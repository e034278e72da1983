"""Operator 13: collocations by top-order marginalisation.

*Words.* Texts are cut into pieces at punctuation and line ends and pieces into words, in numpy. One pass counts the
words of each language; a word's key is a 64-bit hash of language and word. Two words with one key would be seen in
that table, and the keys are then made anew with another seed, so that keys stand for words without error.

*Top-order windows.* A second pass turns each piece into four lead-window columns: the word at a place and the three
that follow it, padded where the piece ends. Only these longest windows are counted, by one aggregate. A word that a
language has less than ``at_least`` times is in no candidate and in no part of one, so a window also ends before such a
word: no count that is used changes. Frequent words are places in the sorted array of their keys, as many bits as that
takes, so that a window is two numbers.

*Marginals.* ``ROLLUP`` adds the counted windows up to their prefixes: phrases of three and two words. There is no pass
over the texts for shorter phrases; single words are known from the first table.

*Scores.* Everything after that works on the phrases with at least ``at_least`` occurrences: their cuts are joined
with the counts of both parts, the lowest score counts (exact decimals), and phrases that a longer one explains go. The
limit of a language's report comes from the counts of its scores (at most 1,000,001 values); only what reaches it
is spelled out and ranked.

Defined results: null and empty texts have no words; a null language is ``und``; ids do not matter, and rows with equal
ids or texts are counted as often as they occur; without candidates the result is empty; other columns do not matter.
Scores of equal value are ordered by a, then by the phrase's bytes, which differ between two phrases of a language.

The keys are given to tasks as one array if there are at most ``MAX_KEYS`` frequent words (32 MB). Beyond it windows hold
the keys themselves, a column each, and do not end before rare words: the counts are the same, the shuffle is larger.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakestrata.llm.tables import Scratch, documents, small
from lakestrata.llm.words import Words, mix64, split, text_slices

ORDER = 4
AT_LEAST, EXPLAINED, TOP = 30, 80, 2000
#: frequent words whose keys tasks get as an array (8 bytes each)
MAX_KEYS = 4_000_000
#: bytes of text that a task splits at once
SLICE = 2 << 20
_U = np.uint64
_W = [f"w{i}" for i in range(1, ORDER + 1)]

_PIECE_ENDS = np.zeros(256, bool)
_PIECE_ENDS[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
#: bytes that no word holds, as spaces for the word splitter
_AS_SPACE = np.arange(256, dtype=np.uint8)
_AS_SPACE[_PIECE_ENDS] = 0x20


def lang_seeds(langs: list[str], seed: int) -> np.ndarray:
    return np.array([int.from_bytes(hashlib.blake2b(f"{seed} {x}".encode(), digest_size=8).digest(), "little") for x in langs], np.uint64)


def pieces_and_words(column, langs, seed: int) -> Iterator[tuple[Words, np.ndarray, np.ndarray, np.ndarray, list[str]]]:
    """(words, their keys, piece number of each word, language of each document, language names) per slice of texts."""
    langs = langs.fill_null("und").dictionary_encode()
    names = langs.dictionary.to_pylist()
    lang = langs.indices.to_numpy(zero_copy_only=False)
    seeds = lang_seeds(names, seed)
    for lo, hi, buf, offsets in text_slices(column, SLICE):
        ends = np.cumsum(_PIECE_ENDS[buf], dtype=np.int64)
        w = split(_AS_SPACE[buf], offsets, "space", True)
        of = w.doc_of_word()
        piece = ends[w.starts] + of  # a later document has a larger number, an earlier piece never
        key = mix64(w.hashes() ^ seeds[lang[lo:hi]][of])
        yield w, key, piece, lang[lo:hi][of], names


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys, where each occurs once, how often)."""
    order = np.argsort(keys)
    keys = keys[order]
    at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[at], order[at], np.diff(np.append(at, len(keys)))


def count_words(docs: DataFrame) -> DataFrame:
    """(lang, word, f) of (text, lang): every word of every language."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w, key, _, lang, langs in pieces_and_words(batch.column(0), batch.column(1), 0):
                if len(key):
                    _, at, count = _runs(key)
                    begin, n = w.starts[at], (w.ends - w.starts)[at]
                    to = np.concatenate([[0], np.cumsum(n)])
                    data = w.buf[np.repeat(begin - to[:-1], n) + np.arange(to[-1])]
                    words = pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(to.astype(np.int64)), pa.py_buffer(data)])
                    yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()).take(pa.array(lang[at])), words.cast(pa.string()), pa.array(count)],
                                                     names=["lang", "word", "f"])

    return docs.mapInArrow(run, "lang string, word string, f long").groupBy("lang", "word").agg(F.sum("f").alias("f"))


def with_keys(words: DataFrame, seed: int) -> DataFrame:
    """(key, lang, word, f) of :func:`count_words`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            seeds = lang_seeds(langs.dictionary.to_pylist(), seed)[langs.indices.to_numpy(zero_copy_only=False)]
            for lo, hi, buf, offsets in text_slices(batch.column(1), SLICE):
                each = Words(buf, offsets, offsets[:-1], offsets[1:], np.arange(len(offsets)))
                key = mix64(each.hashes() ^ seeds[lo:hi])
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), *(c.slice(lo, hi - lo) for c in batch.columns)], names=["key", "lang", "word", "f"])

    return words.select("lang", "word", "f").mapInArrow(run, "key long, lang string, word string, f long")


def lead_windows(ids: np.ndarray, joined: np.ndarray) -> np.ndarray:
    """One row per word that the next one is joined to: the word and the three after it, -1 past a word that is not
    ``joined`` to the one before (``joined[i]``: words i and i + 1)."""
    n = len(ids)
    out = np.full((n, ORDER), -1, np.int64)
    out[:, 0] = ids
    live = np.ones(n, bool)
    for j in range(1, min(ORDER, n)):
        live = live[:-1] & joined[j - 1:]
        out[: n - j, j] = np.where(live, ids[j:], -1)
    return out[out[:, 1] >= 0]


class _Packed:
    """Windows as two columns: words are numbers from 1, of as many bits as ``n`` of them take; 0 is padding."""

    def __init__(self, n: int) -> None:
        self.bits = max(1, (n + 1).bit_length())
        self.first = 3 if 3 * self.bits <= 63 else 2  # words in the first column
        self.names = ["one", "two"]

    def pack(self, windows: np.ndarray) -> list[np.ndarray]:
        out = []
        for words in (windows.T[: self.first], windows.T[self.first:]):
            column = np.zeros(len(windows), np.int64)
            for w in words:
                column = column << self.bits | w + 1
            out.append(column)
        return out

    def word(self, i: int) -> Column:
        """Word i of a window, -1 for padding."""
        column, left = ("one", self.first - 1 - i) if i < self.first else ("two", ORDER - 1 - i)
        return F.shiftright(column, left * self.bits).bitwiseAND(F.lit((1 << self.bits) - 1).cast("long")) - 1

    def pair(self) -> Column:
        return F.shiftright("one", (self.first - 2) * self.bits)

    def of_pair(self, pair: str) -> list[Column]:
        return [F.shiftright(pair, self.bits) - 1, F.col(pair).bitwiseAND(F.lit((1 << self.bits) - 1).cast("long")) - 1]


def _windows(docs: DataFrame, seed: int, keys, packed: _Packed) -> DataFrame:
    """The top-order windows of (text, lang) that hold two words and more, one row for each. With ``keys``, a broadcast
    array of the frequent words' sorted keys, packed places; without it (w1, w2, w3, w4): the words' keys, -1 for padding."""
    names = _W if keys is None else packed.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, key, piece, _, _ in pieces_and_words(batch.column(0), batch.column(1), seed):
                if keys is None:
                    ids = (key >> _U(1)).view(np.int64)
                else:
                    known = keys.value
                    place = np.minimum(np.searchsorted(known, key), len(known) - 1)
                    ids = np.where(known[place] == key, place, -1)
                windows = lead_windows(ids, (piece[1:] == piece[:-1]) & (ids[1:] >= 0) & (ids[:-1] >= 0))
                if len(windows):
                    columns = windows.T if keys is None else packed.pack(windows)
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    return docs.mapInArrow(run, ", ".join(f"{x} long" for x in names))


def phrase_counts(windows: DataFrame, packed: _Packed | None, at_least: int) -> DataFrame:
    """(words, f): the phrases of two to four words that occur ``at_least`` times, beside rows of padded windows, whose
    words are an array with -1 in it."""
    longest = windows.groupBy(*windows.columns).agg(F.count(F.lit(1)).alias("f"))
    if packed is None:
        first, four, two = {w: F.col(w) for w in _W[:2]}, [F.col(w) for w in _W], [F.col(w) for w in _W[:2]]
    else:
        first, four, two = {"pair": packed.pair()}, [packed.word(i) for i in range(ORDER)], packed.of_pair("pair")
    shorter = longest.withColumns(first | {"third": four[2]}).rollup(*first, "third").agg(F.sum("f").alias("f"), F.grouping_id().alias("left_out"))
    often = F.col("f") >= at_least  # a condition on counts alone, so that both branches share the one exchange of windows
    return (longest.where(often).select(F.array(*four).alias("words"), "f")
            .unionByName(shorter.where(often & (F.col("left_out") == 0)).select(F.array(*two, F.col("third")).alias("words"), "f"))
            .unionByName(shorter.where(often & (F.col("left_out") == 1)).select(F.array(*two).alias("words"), "f")))


def _scored(phrases: DataFrame) -> DataFrame:
    """(words, a, l, r, score) of every phrase of two words and more: its lowest-scoring cut."""
    n = F.size("words")
    cuts = phrases.filter(n > 1).select("words", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), n - 1)).alias("k"))
    cuts = cuts.withColumn("left", F.slice("words", F.lit(1), F.col("k"))).withColumn("right", F.slice("words", F.col("k") + 1, F.size("words") - F.col("k")))
    parts = small(phrases)
    cuts = cuts.join(parts.select(F.col("words").alias("left"), F.col("f").alias("l")), "left").join(parts.select(F.col("words").alias("right"), F.col("f").alias("r")), "right")
    # floor of the quotient without a fraction, so that no digit is lost
    score = F.expr("cast(cast(2000000 as decimal(7,0)) * cast(a as decimal(19,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0))) as long)")
    low = cuts.groupBy("words", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("low"))
    return low.select("words", "a", "low.l", "low.r", "low.score")


def _not_explained(scored: DataFrame, percent: int) -> DataFrame:
    """Without phrases inside a longer candidate that has ``percent`` of their occurrences."""
    n = F.size("words")
    inside = scored.filter(n > 2).select("words", F.col("a").alias("of"), F.explode(F.sequence(F.lit(2), n - 1)).alias("m"))
    inside = inside.select("of", "words", "m", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("m") + 1)).alias("at"))
    inside = inside.select(F.slice("words", F.col("at"), F.col("m")).alias("words"), "of").groupBy("words").agg(F.max("of").alias("of"))
    exact = "cast(100 as decimal(3,0)) * cast(of as decimal(19,0)) >= cast({} as decimal(3,0)) * cast(a as decimal(19,0))"
    return scored.join(inside, "words", "left").filter(F.col("of").isNull() | ~F.expr(exact.format(percent))).drop("of")


def collocations(docs: DataFrame, scratch: Scratch, *, text_col: str = "text", lang_col: str = "lang", at_least: int = AT_LEAST,
                 explained: int = EXPLAINED, top: int = TOP, max_keys: int = MAX_KEYS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases."""
    spark = docs.sparkSession
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    counted, seed = scratch.keep(count_words(rows), "counted"), 0
    while True:
        words = scratch.keep(with_keys(counted, seed), f"words-{seed}")
        # keys lose a bit where windows hold them whole
        if not words.groupBy(F.shiftrightunsigned("key", 1)).agg(F.count("*").alias("c")).filter("c > 1").limit(1).count():
            break
        seed += 1
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    often = scratch.keep(words.filter(F.col("f") >= at_least), "often")
    keys = packed = None
    if (n_keys := often.count()) <= max_keys:
        known = np.sort(np.array([r[0] for r in often.select("key").toLocalIterator()], np.int64).view(np.uint64)) if n_keys else np.zeros(1, np.uint64)
        keys, packed = spark.sparkContext.broadcast(known), _Packed(n_keys)
    vocabulary = scratch.keep(_with_ids(often, keys), "vocabulary")
    counts = scratch.keep(phrase_counts(_windows(rows, seed, keys, packed), packed, at_least), "counts")
    counts = counts.filter(~F.array_contains("words", F.lit(-1).cast("long")))
    phrases = scratch.keep(vocabulary.select(F.array("id").alias("words"), "f").unionByName(counts), "phrases")
    scored = scratch.keep(_scored(phrases), "scored")
    lang_of = small(vocabulary)
    left = _not_explained(scored, explained)
    left = scratch.keep(left.join(lang_of.select(F.col("id").alias("__first"), "lang"), F.col("words")[0] == F.col("__first")).drop("__first"), "left")
    upto = Window.partitionBy("lang").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    limits = left.groupBy("lang", "score").agg(F.count("*").alias("c")).withColumn("before", F.coalesce(F.sum("c").over(upto), F.lit(0)))
    limits = limits.filter(F.col("before") < top).groupBy("lang").agg(F.min("score").alias("least"))
    best = left.join(F.broadcast(limits) if limits.count() <= 10_000 else limits, "lang").filter("score >= least").drop("least")
    spelled = best.select("lang", "words", F.posexplode("words").alias("at", "id")).join(lang_of.select("id", "word"), "id")
    spelled = spelled.groupBy("lang", "words").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    ranked = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    out = best.join(spelled, ["lang", "words"]).withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= top)
    out = out.join(totals, "lang")
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _with_ids(often: DataFrame, keys) -> DataFrame:
    """The frequent words with the ids that windows hold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column(0).to_numpy().view(np.uint64)
            ids = (key >> _U(1)).view(np.int64) if keys is None else np.searchsorted(keys.value, key)
            yield pa.RecordBatch.from_arrays([pa.array(ids.astype(np.int64)), *batch.columns[1:]], names=["id", "lang", "word", "f"])

    return often.select("key", "lang", "word", "f").mapInArrow(run, "id long, lang string, word string, f long")


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir), Scratch(spark, "phrases"))


QUERIES = {"op13_phrases": op13_phrases}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_LEADS = ", ".join(f"unnest(list_concat(w[{n}:], [{', '.join(['NULL'] * (n - 1))}])) AS w{n}" for n in range(2, ORDER + 1))
_COUNTS = "\n  UNION ALL ".join(
    f"SELECT lang, {n} AS m, concat_ws(' ', {', '.join(_W[:n])}) AS p, count(*) AS f FROM pos WHERE w{n} IS NOT NULL GROUP BY ALL" for n in range(1, ORDER + 1))
_PARTS = "\n  UNION ALL ".join(
    f"SELECT lang, m, p, f, {k} AS k, array_to_string(string_split(p, ' ')[1:{k}], ' ') AS one, array_to_string(string_split(p, ' ')[{k} + 1:], ' ') AS two FROM cand WHERE m > {k}"
    for k in range(1, ORDER))
ORACLES = {"op13_phrases": rf"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
ws AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
pos AS (SELECT lang, unnest(w) AS w1, {_LEADS} FROM ws WHERE len(w) > 0),
f AS ({_COUNTS}),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang),
often AS MATERIALIZED (SELECT * FROM f WHERE f >= {AT_LEAST}),
cand AS (SELECT * FROM often WHERE m > 1),
cuts AS ({_PARTS}),
scores AS (SELECT c.lang, c.m, c.p, c.f AS a, c.k, x.f AS l, y.f AS r,
    CAST((CAST(2000000 AS HUGEINT) * c.f) // (CAST(x.f AS HUGEINT) + y.f) AS BIGINT) AS score
  FROM cuts AS c JOIN often AS x ON x.lang = c.lang AND x.p = c.one JOIN often AS y ON y.lang = c.lang AND y.p = c.two),
low AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
inside AS (SELECT lang, array_to_string(string_split(p, ' ')[i:i + j - 1], ' ') AS p, max(f) AS f
  FROM (SELECT lang, p, f, m, unnest([1, 2, 3]) AS i FROM cand WHERE m > 2), (SELECT unnest([2, 3]) AS j) WHERE j < m AND i + j - 1 <= m GROUP BY ALL),
kept AS (SELECT low.* FROM low LEFT JOIN inside USING (lang, p) WHERE inside.f IS NULL OR CAST(100 AS HUGEINT) * inside.f < CAST({EXPLAINED} AS HUGEINT) * low.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank, p AS phrase, a, l, r, n, score FROM kept JOIN n USING (lang)
QUALIFY rank <= {TOP}
"""}
