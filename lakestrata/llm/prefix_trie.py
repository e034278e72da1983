"""Operator 12: the prefix trie of conversations, by padded turn-id matrices.

*Paths.* A turn's id is 128 bits of its role and text; a conversation is the ids of its turns one after the other in one
binary, 16 bytes a turn, which sorts by turns. Texts never leave the scan that reads them.

*Range shards.* The paths are range-partitioned and sorted (equal ones by conversation id), so a node's members lie
together, and a group of equal conversations of any size is cut between two ids. A task takes its range in shards of
at most ``SHARD_TURNS`` turns (or one longer conversation).

*Matrices.* A shard's turns become dense ids in a matrix of one row per conversation, padded with -1, ``BLOCK`` columns at
a time and only of the rows that reach them. ``lexsort`` orders the rows, a mask marks where a column changes, and
accumulated by OR along the columns it marks where nodes start: the rows between two marks are a node's members.
``reduceat`` adds them up at every depth, and parents are then added up from the deepest level to the root.

*Boundaries.* A node can go on in a neighbouring shard only if it lies on the path of its shard's first or last
conversation. Such nodes come with what lies below them in their shard alone; they are recombined by a 128-bit key of
their path: members and closed parts are summed, and the few open nodes add up their subtrees by pointer doubling, one
small join per bit of the greatest depth. The ids that end at an open node come as one string per shard and are hashed
in the order of the shards, as a stream.

Defined results: turns are ordered by turn number (null first), then role, then turn id; null roles and texts are empty
ones; rows without a conversation id belong to no conversation and are left out; equal rows are turns of their own; other
columns do not matter; without conversations there is no node, not even a root. A conversation's ids and word counts
(20 bytes a turn) lie in one row: that bounds a single conversation, at about 50 million turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.llm.tables import Scratch, documents, small

SHARD_TURNS = 1 << 17
BLOCK = 16
ID_BYTES = 16
WORD = r"[^\x20\x09-\x0D]+"
ROOT = bytes(ID_BYTES)
NO_ENDS = hashlib.sha256(b"").hexdigest()

_NODE = ("conv_id long, depth int, parent_conv_id long, parent_key binary, n_convs long, n_children long, n_leaves long, saved_tokens long, "
         "ends string, key binary, up array<binary>, words long, part long")


def turn_paths(conversations: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, path, words) of every conversation: its turn ids as one binary, and the words of each turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    turns = conversations.select(F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), role.alias("role"),
                                 F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("id"),
                                 F.regexp_count(text, F.lit(WORD)).alias("words"))
    own = turns.filter(F.col("conv_id").isNotNull()).groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct(F.col("turn").isNotNull().alias("numbered"), "turn", "role", "id", "words"))).alias("own"))
    return own.select("conv_id", F.unhex(F.array_join(F.transform("own", lambda x: x["id"]), "")).alias("path"), F.transform("own", lambda x: x["words"]).alias("words"))


class _Shard:
    """Consecutive paths of the range order: ids (n), the paths' bytes and the words of their turns."""

    def __init__(self, batches: list[pa.RecordBatch]) -> None:
        table = pa.Table.from_batches(batches).combine_chunks()
        self.conv = table.column(0).chunk(0).to_numpy()
        path, words = table.column(1).chunk(0).cast(pa.large_binary()), table.column(2).chunk(0)
        offsets = np.frombuffer(path.buffers()[1], np.int64)[path.offset: path.offset + len(path) + 1]
        data = path.buffers()[2]
        raw = np.frombuffer(data, np.uint8)[offsets[0]: offsets[-1]] if data is not None else np.zeros(0, np.uint8)
        self.turns = raw.reshape(-1, ID_BYTES)
        self.start = (offsets - offsets[0]) // ID_BYTES
        self.length = np.diff(self.start)
        self.words = words.flatten().to_numpy(zero_copy_only=False).astype(np.int64)

    def turn_ids(self) -> np.ndarray:
        """Dense numbers of the turns, in the order of their bytes."""
        halves = np.ascontiguousarray(self.turns).view(">u8").astype(np.uint64).reshape(-1, 2)
        order = np.lexsort((halves[:, 1], halves[:, 0]))
        halves = halves[order]
        new = np.zeros(len(halves), np.int64)
        new[1:] = (halves[1:] != halves[:-1]).any(1)
        ids = np.empty(len(halves), np.int64)
        ids[order] = np.cumsum(new)
        return ids

    def path_keys(self, row: int) -> list[bytes]:
        """Keys of the nodes on a row's path, the root first."""
        keys = [ROOT]
        for turn in self.turns[self.start[row]: self.start[row + 1]]:
            keys.append(hashlib.blake2b(keys[-1] + turn.tobytes(), digest_size=ID_BYTES).digest())
        return keys


class _Nodes:
    """The nodes of a shard, in order of depth: arrays by node number; node 0 is the root."""

    def __init__(self, shard: _Shard) -> None:
        conv, ids = shard.conv, shard.turn_ids()
        self.at_end = at = np.zeros(len(conv), np.int64)  # the deepest node of each row so far
        levels = [(np.array([-1]), np.array([len(conv)]), np.array([conv.min()]), np.array([0]))]
        made = 1
        for d0 in range(0, int(shard.length.max()), BLOCK):
            rows = np.flatnonzero(shard.length > d0)
            matrix = np.full((len(rows), BLOCK), -1, np.int64)
            for j in range(BLOCK):
                has = shard.length[rows] > d0 + j
                matrix[has, j] = ids[shard.start[rows[has]] + d0 + j]
            order = np.lexsort((conv[rows], *matrix.T[::-1], at[rows]))
            rows, matrix = rows[order], matrix[order]
            change = np.ones(matrix.shape, bool)
            change[1:] = matrix[1:] != matrix[:-1]
            change[1:, 0] |= at[rows[1:]] != at[rows[:-1]]
            np.logical_or.accumulate(change, axis=1, out=change)
            for j in range(BLOCK):
                live = np.flatnonzero(matrix[:, j] >= 0)  # an ended row's padding differs from any turn, so a change after it is marked
                if not len(live):
                    break
                starts = np.flatnonzero(change[live, j])
                first, here = rows[live[starts]], rows[live]
                levels.append((at[first], np.diff(np.append(starts, len(live))), np.minimum.reduceat(conv[here], starts),
                               shard.words[shard.start[first] + d0 + j]))
                at[here] = made - 1 + np.cumsum(change[live, j])
                made += len(starts)
        self.parent, self.n, self.conv, self.words = (np.concatenate(x) for x in zip(*levels))
        self.bounds = np.cumsum([0, *(len(x[0]) for x in levels)])
        self.depth = np.repeat(np.arange(len(levels)), np.diff(self.bounds))

    def path(self, node: int) -> list[int]:
        """The nodes from the root to ``node``."""
        out = [node]
        while out[-1]:
            out.append(int(self.parent[out[-1]]))
        return out[::-1]

    def add_up(self, closed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(children, leaves, saved tokens): of closed nodes in full; of others what their closed children have."""
        children = np.bincount(self.parent[1:][closed[1:]], minlength=len(self.n))
        childless = np.bincount(self.parent[1:], minlength=len(self.n)) == 0
        leaves = (childless & closed).astype(np.int64)
        saved = np.where(closed, (self.n - 1) * self.words, 0)
        for lo, hi in zip(self.bounds[-2:0:-1], self.bounds[:0:-1]):
            some = np.arange(lo, hi)[closed[lo:hi]]
            np.add.at(leaves, self.parent[some], leaves[some])
            np.add.at(saved, self.parent[some], saved[some])
        return children, leaves, saved

    def ends(self, conv: np.ndarray) -> dict[int, str]:
        """The ids that end at each node, ascending and comma-joined."""
        order = np.lexsort((conv, self.at_end))
        node = self.at_end[order]
        names = conv[order].astype(str).tolist()
        at = np.flatnonzero(np.append(True, node[1:] != node[:-1])).tolist()
        return {int(node[lo]): ",".join(names[lo:hi]) for lo, hi in zip(at, [*at[1:], len(names)])}


def _shard_nodes(shard: _Shard, part: int) -> pa.RecordBatch:
    nodes = _Nodes(shard)
    keys: dict[int, bytes] = {}
    up: dict[int, list[bytes]] = {}
    for row in {0, len(shard.conv) - 1}:
        path_keys, path = shard.path_keys(row), nodes.path(int(nodes.at_end[row]))
        for d, node in enumerate(path):
            if node not in keys:
                keys[node] = path_keys[d]
                up[node] = [path_keys[d - (1 << k)] for k in range(d.bit_length())]
    opened = list(keys)
    closed = np.ones(len(nodes.n), bool)
    closed[opened] = False
    children, leaves, saved = nodes.add_up(closed)
    ends = nodes.ends(shard.conv)
    text = [NO_ENDS] * len(nodes.n)
    for node, of in ends.items():
        text[node] = hashlib.sha256(of.encode()).hexdigest() if closed[node] else of
    for node in opened:
        text[node] = ends.get(node)
    parent = np.maximum(nodes.parent, 0)
    known = closed & closed[parent]
    lone = [None] * len(nodes.n)
    parent_key, key, ups = lone.copy(), lone.copy(), lone.copy()
    for i in np.flatnonzero(closed & ~closed[parent]).tolist():
        parent_key[i] = keys[int(parent[i])]
    for node in opened:
        key[node], ups[node] = keys[node], up[node]
    names = [x.split()[0] for x in _NODE.split(", ")]
    return pa.RecordBatch.from_arrays([
        pa.array(nodes.conv), pa.array(nodes.depth.astype(np.int32)), pa.array(nodes.conv[parent], mask=~known), pa.array(parent_key, pa.binary()),
        pa.array(nodes.n.astype(np.int64)), pa.array(children.astype(np.int64)), pa.array(leaves), pa.array(saved), pa.array(text, pa.string()),
        pa.array(key, pa.binary()), pa.array(ups, pa.list_(pa.binary())), pa.array(nodes.words.astype(np.int64)),
        pa.array(np.full(len(nodes.n), part, np.int64))], names=names)


def _local_nodes(paths: DataFrame, shard_turns: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, held, turns, shards = TaskContext.get().partitionId(), [], 0, 0
        for batch in batches:
            lo = 0
            for i, n in enumerate((pc.binary_length(batch.column(1)).to_numpy() // ID_BYTES).tolist()):
                if turns and turns + n > shard_turns:
                    held.append(batch.slice(lo, i - lo))
                    yield _shard_nodes(_Shard(held), task << 32 | shards)
                    held, turns, lo, shards = [], 0, i, shards + 1
                turns += max(n, 1)
            held.append(batch.slice(lo))
        if turns:
            yield _shard_nodes(_Shard(held), task << 32 | shards)

    return paths.mapInArrow(run, _NODE)


def _hashed_in_order(parts: DataFrame) -> DataFrame:
    """(key, ends_sha256) of (key, part, ends): the parts' strings in order, joined by commas, as a stream."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([digest.hexdigest()])], names=["key", "ends_sha256"])

        key = digest = None
        for batch in batches:
            for now, ends in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if now == key:
                    digest.update(b",")
                else:
                    if key is not None:
                        yield row()
                    key, digest = now, hashlib.sha256()
                digest.update(ends.encode())
        if key is not None:
            yield row()

    return parts.repartition("key").sortWithinPartitions("key", "part").mapInArrow(run, "key binary, ends_sha256 string")


def prefix_trie(paths: DataFrame, scratch: Scratch, *, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node of the trie of ``paths`` (conv_id, path, words), conv_id unique and not null: conv_id (the
    smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    paths = scratch.keep(paths, "paths")  # the range partitioning looks at them twice
    sorted_paths = paths.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    local = scratch.keep(_local_nodes(sorted_paths, shard_turns), "local")
    of_open = local.filter(F.col("key").isNotNull())
    joined = of_open.groupBy("key").agg(F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("up").alias("up"), F.first("words").alias("words"),
                                        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")))
    joined = scratch.keep(joined.withColumn("parent_key", F.get("up", F.lit(0))), "open")
    below = joined.filter(F.col("parent_key").isNotNull()).groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("open_children"))
    joined = joined.join(below, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("open_children", F.lit(0))).drop("open_children")
    joined = joined.withColumns({"n_leaves": F.col("n_leaves") + (F.col("n_children") == 0).cast("long"),
                                 "saved_tokens": F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("words")})
    joined = scratch.keep(joined, "sums-0")
    rounds = (joined.agg(F.max("depth")).first()[0] or 0).bit_length()
    for k in range(rounds):
        # nodes hold the sums of their subtree to the depth 2^k: add those of the nodes 2^k below them
        lower = joined.filter(F.size("up") > k).groupBy(F.col("up")[k].alias("key")).agg(F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
        joined = joined.join(small(lower), "key", "left").withColumns({
            "n_leaves": F.col("n_leaves") + F.coalesce("leaves", F.lit(0)), "saved_tokens": F.col("saved_tokens") + F.coalesce("saved", F.lit(0))})
        joined = scratch.keep(joined.drop("leaves", "saved"), f"sums-{k + 1}")
        scratch.drop(f"sums-{k}")
    parents = small(joined.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent")))
    ends = _hashed_in_order(of_open.filter(F.col("ends").isNotNull()).select("key", "part", "ends"))
    columns = ["conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    whole = local.filter(F.col("key").isNull()).withColumnRenamed("ends", "ends_sha256").join(parents, "parent_key", "left")
    whole = whole.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "parent"))
    recombined = joined.join(parents, "parent_key", "left").join(ends, "key", "left").withColumn("parent_conv_id", F.col("parent"))
    recombined = recombined.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS)))
    return whole.select(*columns).unionByName(recombined.select(*columns))


def branched(paths: DataFrame, scratch: Scratch) -> DataFrame:
    """Paths that share heads: the first h turns of conversation c - c % 20, then c's own turns after its first h,
    with h = crc32(c) % 4."""
    own = scratch.keep(paths, "own")
    heads = own.filter("conv_id % 20 = 0").select(F.col("conv_id").alias("base"), F.expr(f"substring(path, 1, {3 * ID_BYTES})").alias("head"),
                                                  F.slice("words", 1, 3).alias("head_words"))
    all_rows = own.withColumns({"base": F.expr("conv_id - conv_id % 20"), "h": F.expr("cast(crc32(cast(cast(conv_id as string) as binary)) % 4 as int)")})
    joined = all_rows.join(heads, "base", "left").withColumns({"head": F.coalesce("head", F.lit(b"")), "head_words": F.coalesce("head_words", F.array().cast("array<int>"))})
    return joined.select("conv_id", F.expr(f"concat(substring(head, 1, {ID_BYTES} * h), substring(path, {ID_BYTES} * h + 1))").alias("path"),
                         F.expr("concat(slice(head_words, 1, h), slice(words, h + 1, size(words)))").alias("words"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "trie")
    return prefix_trie(branched(turn_paths(documents(spark, sf_dir, "conversations")), scratch), scratch)


QUERIES = {"op12_prefix_trie": op12_prefix_trie}

#: crc32 as a fold: a byte is mixed in, then eight shifts
_CRC = """xor(list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
    lambda x: [CAST(ascii(x) AS UBIGINT), 1000, 1000, 1000, 1000, 1000, 1000, 1000, 1000]))),
  lambda s, y: CASE WHEN y < 1000 THEN xor(s, y) WHEN s & 1 = 1 THEN xor(s >> 1, 3988292384) ELSE s >> 1 END), 4294967295)"""
ORACLES = {"op12_prefix_trie": rf"""
WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list({{'r': r, 'x': x}} ORDER BY turn NULLS FIRST, r, md5(concat(length(r), ':', r, x))) AS own FROM turns GROUP BY conv_id),
h AS (SELECT conv_id, own, {_CRC} % 4 AS h FROM own),
seq AS (SELECT h.conv_id, list_concat(coalesce(b.own, [])[1:CAST(h AS INTEGER)], h.own[CAST(h AS INTEGER) + 1:]) AS s FROM h LEFT JOIN own AS b ON b.conv_id = h.conv_id - h.conv_id % 20),
members AS (SELECT conv_id AS c, len(s) AS size, unnest(range(0, len(s) + 1)) AS d, s FROM seq),
keyed AS (SELECT c, d, size, md5(CAST(s[1:d] AS VARCHAR)) AS k, s[1:d] AS prefix, CASE WHEN d > 0 THEN len(regexp_extract_all(s[d]['x'], '[^\x20\x09-\x0D]+')) ELSE 0 END AS w FROM members),
nodes AS (SELECT d, prefix, min(c) AS c, count(*) AS n, max(w) AS w, count(DISTINCT CASE WHEN size > d THEN c END) AS deeper,
    coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (size = d), '') AS ends FROM keyed GROUP BY d, prefix),
placed AS (SELECT k.c AS via, k.d, n.c, n.n, n.w, n.ends, n.deeper FROM keyed AS k JOIN nodes AS n ON n.d = k.d AND n.prefix = k.prefix),
up AS (SELECT n.c, n.d, p.c AS above, p.d AS above_d, n.n, n.w, n.deeper FROM nodes AS n JOIN placed AS p ON p.via = n.c AND p.d <= n.d),
sums AS (SELECT above AS c, above_d AS d, count(*) FILTER (d = above_d + 1) AS n_children, count(*) FILTER (deeper = 0) AS n_leaves,
    sum((n - 1) * w) AS saved FROM up GROUP BY ALL)
SELECT n.c AS conv_id, n.d AS depth, p.above AS parent_conv_id, n.n AS n_convs, s.n_children, s.n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM nodes AS n JOIN sums AS s USING (c, d) LEFT JOIN up AS p ON p.c = n.c AND p.d = n.d AND p.above_d = n.d - 1
"""}
