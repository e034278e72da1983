"""Operator 5: removal of repeated passages by de Bruijn compaction.

Windows of ``k`` words are the edges of a de Bruijn graph (its nodes are k - 1 words). Edges that come in
two documents are found, their non-branching paths are compacted, and one join over the paths, not over the
single windows, tells which occurrence belongs to the smallest document id. Every later occurrence is
removed.

Documents are dealt by hash into groups of bounded size; a group is the unit of the exchanges:

1. *Anchors.* Each window's smallest hash of five words: equal windows have equal anchors, and runs of
   windows share one. A group sends its distinct anchors to buckets of the hash space; the bucket sorts all
   it gets once and answers which ones another group has as well.
2. *Edges.* Windows with a shared anchor are candidates. A group sends each distinct one with the words
   before and behind it; the bucket answers whether another group has it, and whether all its
   occurrences have the same word before and behind (no branch).
3. *Paths.* In each text, maximal runs of repeated edges are cut where the graph branches: all occurrences
   of a path are the same words. A group sends each distinct path once, with an independent 128-bit hash of
   its words (the check at the source coordinates) and its smallest id; a window over the path's rows finds
   the smallest id of all.
4. *Removal.* Words covered by paths with a smaller first id go.

What is sent is distinct per group, so a passage in a third of all documents is one row per group, and a
text of any length stays with its group. The exchange of the texts is the same for all four steps, so Spark
runs it once. Buckets grow in number with the groups, not in size, and compare 32 bits of a hash besides the
range that they hold: hashes that meet there by chance make more candidates and cut a path into more parts,
for all its occurrences alike, and remove nothing. Paths are compared by 64 + 128 bits. A pair of group and
bucket is one message, read and written by array operations over all messages of a group or bucket.

Defined results: null and empty texts have no words (kept text empty); texts shorter than a window lose
nothing; rows with equal ids never remove each other's words; null ids count as larger than any other;
ids are integers; other columns do not matter.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakestrata.llm.tables import documents
from lakestrata.llm.words import Words, mix64, split, text_slices

K = 13
ANCHOR = 5
GROUP_BYTES = 8 << 20
NO_ID = (1 << 63) - 1
_U = np.uint64
_REPEATED, _OPEN_BEFORE, _OPEN_BEHIND = 1, 2, 4
#: an edge in a message: part of its hash and the words before and behind
_EDGE = np.dtype([("value", "<u4"), ("before", "<u4"), ("behind", "<u4")])


def _binary(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """One binary value per pair of neighbouring bounds."""
    offsets = (np.asarray(bounds, np.int64) * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values.tobytes())])


def _flat(column: pa.ChunkedArray, dtype) -> tuple[np.ndarray, np.ndarray]:
    """The values of all binaries of a column in one array, and where each binary begins in it, and their end."""
    if not len(column):
        return np.zeros(0, dtype), np.zeros(1, np.int64)
    column = column.combine_chunks()
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int32)[column.offset: column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0]: offsets[-1]]
    return np.frombuffer(data.tobytes(), dtype), (offsets - offsets[0]).astype(np.int64) // np.dtype(dtype).itemsize


class Group:
    """The texts of one group in a fixed order, as one array of words."""

    def __init__(self, table: pa.Table, k: int) -> None:
        order = table.select(["id", "tie"]).combine_chunks()
        self.order = np.lexsort((order.column("tie").to_numpy(), order.column("id").to_numpy()))
        table = table.take(pa.array(self.order))
        self.ids = table.column("id").to_numpy()
        self.nulls = table.column("no_id").to_numpy(zero_copy_only=False)
        (_, _, buf, offsets), = text_slices(table.column("text"), 1 << 62)
        self.w: Words = split(buf, offsets, "space", False)
        self.k = k

    @cached_property
    def hashes(self) -> np.ndarray:
        return self.w.hashes()

    @cached_property
    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """(index of the first word, hash) of each window."""
        return self.w.windows(self.k, self.hashes)

    @cached_property
    def row(self) -> np.ndarray:
        return self.w.doc_of_word()

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs of windows with one anchor, their smallest hash of ANCHOR words: its hash (smallest hashes crowd
        at 0, and buckets are equal ranges), the row and the windows of each run."""
        m = min(ANCHOR, self.k)
        at, g = self.w.windows(m, self.hashes)
        best = np.full(len(self.hashes) + self.k, np.iinfo(np.uint64).max, np.uint64)
        best[at] = g
        first = self.windows[0]
        low = best[first] if len(first) else best[:0]
        for j in range(1, self.k - m + 1):
            low = np.minimum(low, best[first + j])
        row = self.row[first]
        head = np.flatnonzero(np.concatenate([[True], (low[1:] != low[:-1]) | (row[1:] != row[:-1])])) if len(low) else np.zeros(0, np.int64)
        return mix64(low[head]), row[head], np.diff(np.append(head, len(low)))


def _distinct(values: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct values, whether each comes in two rows, the order that sorts, and the first place of
    each in it."""
    order = np.argsort(values)
    ordered = values[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, np.int64)
    if not len(first):
        return ordered, np.zeros(0, bool), order, first
    by_row = rows[order]
    several = np.minimum.reduceat(by_row, first) != np.maximum.reduceat(by_row, first)
    return ordered[first], several, order, first


def _bucket_slices(values: np.ndarray, n_buckets: int) -> np.ndarray:
    """Where each bucket of the hash space begins in the sorted values, and their end."""
    bounds = [(b << 64) // n_buckets for b in range(1, n_buckets)]
    return np.concatenate([[0], np.searchsorted(values, np.array(bounds, np.uint64)), [len(values)]])


def _answers(told: pa.Table, kind: int) -> np.ndarray:
    """The buckets' answers of one kind, in the order of the hashes."""
    own = told.filter(pc.equal(told.column("kind"), kind)).sort_by("bucket")
    return _flat(own.column("answer"), np.uint8)[0]


def _shared_windows(g: Group, told: pa.Table) -> np.ndarray:
    """Which of the group's windows have an anchor that comes in another document."""
    anchors, row, n = g.anchors()
    values, several, order, first = _distinct(anchors, row)
    shared = np.zeros(len(anchors), bool)
    shared[order] = np.repeat(several | (_answers(told, 1) > 0), np.diff(np.append(first, len(order))))
    return np.repeat(shared, n)


def _context(g: Group, at: np.ndarray, order: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """The words before and behind each distinct edge: 0 none, 1 several, else 32 bits of the word's hash."""
    context = []
    for word, ok in ((at - 1, at > g.w.first[g.row[at]]), (at + g.k, at + g.k < g.w.first[g.row[at] + 1])):
        c = np.zeros(len(at), np.uint32)
        c[ok] = (g.hashes[word[ok]] >> _U(32)).astype(np.uint32) | _U(2).astype(np.uint32)
        c = c[order]
        if len(first):
            lo, hi = np.minimum.reduceat(c, first), np.maximum.reduceat(c, first)
            c = np.where(lo == hi, lo, np.uint32(1))
        context.append(c.astype(np.uint32))
    return context


MESSAGE = "bucket int, gid int, body binary"
ANSWER = "gid int, bucket int, kind int, answer binary"


def _message_table(gid: int, values: np.ndarray, bodies: np.ndarray, n_buckets: int) -> pa.Table:
    """One row per bucket of the sorted ``values`` that has any, with the bodies of its values."""
    at = _bucket_slices(values, n_buckets)
    some = np.flatnonzero(np.diff(at))
    return pa.table({"bucket": pa.array(some.astype(np.int32)), "gid": pa.array(np.full(len(some), gid, np.int32)),
                     "body": _binary(bodies, np.append(at[some], len(values)))})


def _send_anchors(k: int, n_buckets: int):
    def send(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        values = np.unique(Group(table, k).anchors()[0])
        return _message_table(key[0].as_py(), values, values.astype(np.uint32), n_buckets)
    return send


def _judge_anchors(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Which hashes of each group's message another group has sent as well."""
    values, bounds = _flat(table.column("body"), np.uint32)
    order = np.argsort(values)
    ordered = values[order]
    same = ordered[1:] == ordered[:-1]
    answer = np.empty(len(values), np.uint8)
    answer[order] = np.append(same, False) | np.append(False, same)
    return _answer_table(key, table, 1, answer, bounds)


def _answer_table(key: tuple[pa.Scalar, ...], table: pa.Table, kind: int, answer: np.ndarray, bounds: np.ndarray) -> pa.Table:
    n = len(table)
    return pa.table({"gid": table.column("gid").cast(pa.int32()), "bucket": pa.array(np.full(n, key[0].as_py(), np.int32)),
                     "kind": pa.array(np.full(n, kind, np.int32)), "answer": _binary(answer, bounds)})


def _send_edges(k: int, n_buckets: int):
    def send(key: tuple[pa.Scalar, ...], table: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(table):
            return _message_table(0, np.zeros(0, np.uint64), np.zeros(0, _EDGE), n_buckets)
        g = Group(table, k)
        shared = _shared_windows(g, answers)
        at, edges = (x[shared] for x in g.windows)
        values, _, order, first = _distinct(edges, g.row[at])
        bodies = np.empty(len(values), _EDGE)
        bodies["value"] = values.astype(np.uint32)
        bodies["before"], bodies["behind"] = _context(g, at, order, first)
        return _message_table(key[0].as_py(), values, bodies, n_buckets)
    return send


def _judge_edges(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    bodies, bounds = _flat(table.column("body"), _EDGE)
    order = np.argsort(bodies["value"])
    ordered = bodies["value"][order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    counts = np.diff(np.append(first, len(ordered)))
    flags = np.where(counts > 1, _REPEATED, 0).astype(np.uint8)
    for c, bit in ((bodies["before"], _OPEN_BEFORE), (bodies["behind"], _OPEN_BEHIND)):
        lo, hi = np.minimum.reduceat(c[order], first), np.maximum.reduceat(c[order], first)
        flags |= np.where((lo != hi) | (lo <= 1), bit, 0).astype(np.uint8)
    answer = np.empty(len(bodies), np.uint8)
    answer[order] = np.repeat(flags, counts)
    return _answer_table(key, table, 2, answer, bounds)


PATHS = "gid int, head long, n_edges int, check1 long, check2 long, first_id long, rows array<int>, starts array<int>"


def _find_paths(k: int):
    def find(key: tuple[pa.Scalar, ...], table: pa.Table, answers: pa.Table) -> pa.Table:
        names = [c.split()[0] for c in PATHS.split(", ")]
        types = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())]
        empty = pa.table([pa.array([], t) for t in types], names=names)
        if not len(table):
            return empty
        g = Group(table, k)
        shared = _shared_windows(g, answers)
        at, edges = (x[shared] for x in g.windows)
        if not len(at):
            return empty
        _, several, order, first = _distinct(edges, g.row[at])
        flags = _answers(answers, 2) | np.where(several, _REPEATED, 0).astype(np.uint8)
        flag = np.empty(len(at), np.uint8)
        flag[order] = np.repeat(flags, np.diff(np.append(first, len(order))))
        live = np.flatnonzero(flag & _REPEATED)
        if not len(live):
            return empty
        at, edges, flag = at[live], edges[live], flag[live]
        row = g.row[at]
        cut = np.ones(len(at), bool)
        cut[1:] = (at[1:] != at[:-1] + 1) | (row[1:] != row[:-1]) | (flag[:-1] & _OPEN_BEHIND > 0) | (flag[1:] & _OPEN_BEFORE > 0)
        head = np.flatnonzero(cut)
        n_edges = np.diff(np.append(head, len(at)))
        check1, check2 = _checks(g, at[head], n_edges + k - 1)
        keys = np.stack([edges[head], n_edges.astype(np.uint64), check1, check2])
        order = np.lexsort(keys)
        keys = keys[:, order]
        first = np.flatnonzero(np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(0)]))
        starts = (at[head] - g.w.first[row[head]])[order]
        rows = row[head][order]
        bounds = pa.array(np.append(first, len(order)).astype(np.int32))
        return pa.table([
            pa.array(np.full(len(first), key[0].as_py(), np.int32)), pa.array(keys[0][first].view(np.int64)),
            pa.array(keys[1][first].astype(np.int32)), pa.array(keys[2][first].view(np.int64)), pa.array(keys[3][first].view(np.int64)),
            pa.array(np.minimum.reduceat(g.ids[rows], first)), pa.ListArray.from_arrays(bounds, pa.array(rows.astype(np.int32))),
            pa.ListArray.from_arrays(bounds, pa.array(starts.astype(np.int32)))], names=names)
    return find


def _checks(g: Group, begin: np.ndarray, n_words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each span's words, by a word hash that the edges do not use."""
    upto = np.cumsum(n_words)
    place = np.arange(upto[-1]) - np.repeat(upto - n_words, n_words)
    word = np.repeat(begin, n_words) + place
    other = Words(g.w.buf[::-1], g.w.offsets, len(g.w.buf) - g.w.ends, len(g.w.buf) - g.w.starts, g.w.first).hashes()[word]
    place = place.astype(np.uint64)
    one = mix64(other + place * _U(0x9E3779B97F4A7C15))
    two = mix64(other * _U(0xD6E8FEB86659FD93) ^ (place * _U(0xCA5A826395121157) + _U(1)))
    first = upto - n_words
    return np.add.reduceat(one, first), np.add.reduceat(two, first)


def kept_words(w: Words, removed: np.ndarray) -> pa.Array:
    """The texts of the words that are not removed, one space between them."""
    keep = ~removed
    counts = np.add.reduceat(np.append(keep, False).astype(np.int64), np.minimum(w.first[:-1], len(keep))) if len(w.counts) else np.zeros(0, np.int64)
    counts[w.counts == 0] = 0
    starts, ends = w.starts[keep], w.ends[keep]
    mask = np.zeros(len(w.buf) + 1, np.int8)
    mask[starts] += 1
    mask[ends] -= 1
    size = ends - starts + 1
    last = np.cumsum(counts)[counts > 0] - 1
    size[last] -= 1  # no space behind a document's last word
    text = np.full(int(size.sum()), 0x20, np.uint8)
    inside = np.ones(len(text), bool)
    place = np.cumsum(size) - size
    spaced = np.ones(len(starts), bool)
    spaced[last] = False
    inside[(place + size - 1)[spaced]] = False
    text[inside] = w.buf[np.cumsum(mask[:-1], dtype=np.int8).view(bool)]
    upto = np.concatenate([[0], np.cumsum(size)])
    offsets = upto[np.concatenate([[0], np.cumsum(counts)])].astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(counts), pa.py_buffer(offsets), pa.py_buffer(text))


RESULT = "id long, n_words long, n_removed long, kept_text string"


def _remove(k: int):
    def remove(key: tuple[pa.Scalar, ...], table: pa.Table, paths: pa.Table) -> pa.Table:
        names = [c.split()[0] for c in RESULT.split(", ")]
        if not len(table):
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.string())], names=names)
        g = Group(table, k)
        change = np.zeros(len(g.w.starts) + 1, np.int64)
        if len(paths):
            paths = paths.combine_chunks()
            rows, starts = paths.column("rows").combine_chunks(), paths.column("starts").combine_chunks()
            n = np.diff(rows.offsets.to_numpy())
            row, start = rows.flatten().to_numpy(), starts.flatten().to_numpy()
            own = np.repeat(paths.column("first_id").to_numpy(), n) < g.ids[row]
            begin = g.w.first[row[own]] + start[own]
            np.add.at(change, begin, 1)
            np.add.at(change, begin + np.repeat(paths.column("n_edges").to_numpy(), n)[own] + k - 1, -1)
        removed = np.cumsum(change[:-1]) > 0
        upto = np.concatenate([[0], np.cumsum(removed)])
        return pa.table([pa.array(g.ids, mask=g.nulls), pa.array(g.w.counts.astype(np.int64)),
                         pa.array(np.diff(upto[g.w.first]).astype(np.int64)), kept_words(g.w, removed).cast(pa.string())], names=names)
    return remove


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = K, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_removed, kept_text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    groups = 1 + total // group_bytes
    buckets = 1 + groups // 2
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.col(id_col).isNull().alias("no_id"),
                       text.alias("text"), F.xxhash64(text).alias("tie"))
    rows = rows.withColumn("gid", F.pmod(F.xxhash64("id", "tie"), F.lit(groups)).cast("int"))
    by_group = rows.groupBy("gid")
    shared = by_group.applyInArrow(_send_anchors(k, buckets), MESSAGE).groupBy("bucket").applyInArrow(_judge_anchors, ANSWER)
    edges = by_group.cogroup(shared.groupBy("gid")).applyInArrow(_send_edges(k, buckets), MESSAGE)
    told = shared.unionByName(edges.groupBy("bucket").applyInArrow(_judge_edges, ANSWER))
    paths = by_group.cogroup(told.groupBy("gid")).applyInArrow(_find_paths(k), PATHS)
    same = Window.partitionBy("head", "n_edges", "check1", "check2")  # a row per group at most
    paths = paths.withColumn("first_id", F.min("first_id").over(same)).select("gid", "n_edges", "first_id", "rows", "starts")
    return by_group.cogroup(paths.groupBy("gid")).applyInArrow(_remove(k), RESULT).withColumnRenamed("id", id_col)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(documents(spark, sf_dir))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


QUERIES = {"op5_substring_dedup": op5_substring_dedup}

ORACLES = {"op5_substring_dedup": rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
pos AS (SELECT doc_id, w, unnest(range(1, len(w) - {K - 2})) AS i FROM d WHERE len(w) >= {K}),
win AS (SELECT doc_id, i, array_to_string(w[i:i + {K - 1}], ' ') AS phrase FROM pos),
firsts AS (SELECT phrase, min(doc_id) AS first_id FROM win GROUP BY phrase),
gone AS (SELECT doc_id, list(DISTINCT p) AS ps
         FROM (SELECT doc_id, unnest(range(i, i + {K})) AS p FROM win JOIN firsts USING (phrase) WHERE first_id < doc_id) GROUP BY doc_id),
r AS (SELECT d.doc_id, w, coalesce(ps, []) AS ps FROM d LEFT JOIN gone USING (doc_id))
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(ps) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(list_filter(w, lambda x, i: NOT list_contains(ps, i)), ' '), '')) AS kept_sha256
FROM r
"""}
