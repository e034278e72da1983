"""Operator 1: token-id output.

Texts become rows of a Parquet table with one list column of token ids, in ascending document order.
The list column is dictionary encoded (ids repeat), the ascending columns are delta encoded (data
pages v2), row groups and pages have set sizes, and Parquet's page indexes let a reader fetch a few
documents or the metadata columns alone without touching the token pages.

Layout: the documents are range-partitioned by id; each partition is one *shard* (one file part) whose
rows carry their start inside the shard, and a small table has one row per shard with the ids of all
shards before it. The global start of a document is the sum of both, so no task ever counts more than
its own shard.

Defined results: a null text is an empty text (only the end id); rows with equal ids stay separate rows,
ordered by the hash of their text; null ids come last; other columns of the input are ignored unless
named in ``metadata``; an empty table gives an empty token table.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.llm.tables import Scratch, documents
from lakestrata.llm.words import Words, text_slices

END_ID = 0
#: pieces that a worker remembers before it starts anew
CACHE_ENTRIES = 1_500_000
PARQUET = {
    "compression": "zstd",
    "parquet.writer.version": "v2",              # delta encoding where there is no dictionary
    "parquet.block.size": str(32 << 20),         # row group
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",      # granularity of the page index
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#local_start": "false",
    "parquet.enable.dictionary#doc_id": "false",
}

_PLAIN = re.compile(r" ?\S+")
_LETTER, _MARK, _SPACE = (np.zeros(256, bool) for _ in range(3))
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_MARK[list(b".,!?;:")] = True
_SPACE[list(b"\t\n\x0b\x0c\r ")] = True


def cuts_at_space(tokenizer_json: str) -> bool:
    """Whether the tokenizer's pieces can be encoded on their own: a byte-level one without
    normaliser, prefix space or tokens that take spaces."""
    j = json.loads(tokenizer_json)
    pre = j.get("pre_tokenizer") or {}
    return (j.get("normalizer") is None and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space", True)
            and pre.get("use_regex", True) and not j["model"].get("dropout")
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"[\s.,!?;:]", t["content"])
                        for t in j.get("added_tokens", [])))


def cut(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Piece starts of a slice of texts. A byte-level pre-tokenizer always cuts before a run of white
    space that follows something else, and between a letter and a mark, so pieces cut there can be
    encoded on their own. Where it is not plain (after white space beyond ASCII) nothing is cut."""
    begin = np.zeros(len(buf), bool)
    if len(buf):
        space = _SPACE[buf]
        begin[1:] = space[1:] & ~space[:-1] | _MARK[buf[1:]] & _LETTER[buf[:-1]]
        at = np.flatnonzero(begin[1:] & (buf[:-1] >= 0x80)) + 1  # may follow white space of two or three bytes
        two, three = buf[np.maximum(at - 2, 0)], buf[np.maximum(at - 3, 0)]
        odd = (two == 0xC2) | (three == 0xE1) & (two == 0x9A) | (three == 0xE2) & ((two == 0x80) | (two == 0x81)) | (three == 0xE3) & (two == 0x80)
        begin[at[odd]] = False
        begin[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    return np.flatnonzero(begin)


class Encoder:
    """The tokenizers library behind a bounded memory of pieces: words repeat, so most pieces of a text
    have been encoded before. Pieces are looked up by 64-bit hash; new ones go to the library, whose ids
    are kept. A tokenizer whose pieces depend on their neighbours gets whole texts."""

    def __init__(self, path: str, encode_special: bool = False) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = encode_special
        with open(path, encoding="utf-8") as f:
            self.by_piece = cuts_at_space(f.read())
        feed = self.tok.encode("\n", add_special_tokens=False).ids
        self.by_piece &= len(feed) == 1
        self.feed = feed[0] if feed else -1
        self.forget()

    def forget(self) -> None:
        self.keys, self.codes = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.start, self.length, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def _library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = [e.ids for lo in range(0, len(texts), 4096) for e in self.tok.encode_batch_fast(texts[lo: lo + 4096], add_special_tokens=False)]
        sizes = np.fromiter(map(len, got), np.int64, len(got))
        return np.fromiter(chain.from_iterable(got), np.int32, int(sizes.sum())), sizes

    def _pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As ``_library``, with fewer calls: plain pieces go as lines of longer texts, as a line feed
        between two of them is always an id of its own."""
        plain = np.fromiter((_PLAIN.fullmatch(p) is not None for p in pieces), bool, len(pieces))
        lines = [p for p, ok in zip(pieces, plain) if ok]
        others = self._library([p for p, ok in zip(pieces, plain) if not ok])
        flat, _ = self._library(["\n".join(lines[lo: lo + 256]) + "\n" for lo in range(0, len(lines), 256)])
        feeds = np.flatnonzero(flat == self.feed)
        sizes = np.empty(len(pieces), np.int64)
        sizes[plain], sizes[~plain] = np.diff(feeds, prepend=-1) - 1, others[1]
        ids = np.empty(int(sizes.sum()), np.int32)
        of_plain = np.repeat(plain, sizes)
        ids[of_plain], ids[~of_plain] = flat[flat != self.feed], others[0]
        return ids, sizes

    def encode(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number of ids of each)."""
        raw = buf.tobytes()
        if not self.by_piece:
            return self._library([raw[lo:hi].decode() for lo, hi in zip(offsets[:-1], offsets[1:])])
        starts = cut(buf, offsets)
        ends = np.append(starts[1:], len(buf))
        first = np.searchsorted(starts, offsets)
        local, keys = pd.factorize(Words(buf, offsets, starts, ends, first).hashes())
        keys = np.asarray(keys, np.uint64)
        at = np.searchsorted(self.keys, keys)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == keys[known]
        if not known.all():
            if len(self.keys) > CACHE_ENTRIES:
                self.forget()
                known[:] = False
            seen_at = np.empty(len(keys), np.int64)
            seen_at[local[::-1]] = np.arange(len(local))[::-1]
            new = np.flatnonzero(~known)
            ids, sizes = self._pieces([raw[starts[i]: ends[i]].decode() for i in seen_at[new]])
            base, n = len(self.ids), len(self.length)
            order = np.argsort(keys[new])
            where = np.searchsorted(self.keys, keys[new][order])
            self.codes = np.insert(self.codes, where, (n + np.arange(len(new), dtype=np.int32))[order])
            self.keys = np.insert(self.keys, where, keys[new][order])
            self.start = np.concatenate([self.start, base + np.cumsum(sizes) - sizes])
            self.length = np.concatenate([self.length, sizes])
            self.ids = np.concatenate([self.ids, ids])
            at = np.searchsorted(self.keys, keys)
        code = self.codes[at][local]
        length = self.length[code]
        upto = np.concatenate([[0], np.cumsum(length)])
        ids = self.ids[np.repeat(self.start[code] - upto[:-1], length) + np.arange(upto[-1])]
        return ids, np.diff(upto[first])


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def _encoder(path: str, encode_special: bool) -> Encoder:
    key = (path, encode_special)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, encode_special)
    return _ENCODERS[key]


def write_tokens(docs: DataFrame, path: str, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text",
                 metadata: tuple[str, ...] = (), end_id: int | None = END_ID, encode_special: bool = False) -> None:
    """Write ``{path}/tokens`` (rows: id, metadata, shard, local_start, n_tokens, tokens) and
    ``{path}/shards`` (shard, base)."""
    keep = [id_col, *metadata]
    source = docs.select(*keep, F.coalesce(F.col(text_col), F.lit("")).alias("__text")).withColumn("__tie", F.xxhash64("__text"))
    ordered = (source.repartitionByRange(F.col(id_col).asc_nulls_last(), F.col("__tie"))
               .sortWithinPartitions(F.col(id_col).asc_nulls_last(), F.col("__tie")).drop("__tie"))
    out = T.StructType([*(source.schema[c] for c in keep), T.StructField("shard", T.IntegerType()), T.StructField("local_start", T.LongType()),
                        T.StructField("n_tokens", T.LongType()), T.StructField("tokens", T.ArrayType(T.IntegerType(), False))])
    tail = [] if end_id is None else [end_id]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, shard, start = _encoder(tokenizer, encode_special), TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = batch.column(len(keep))
            for lo, hi, buf, offsets in text_slices(texts):
                ids, n = enc.encode(buf, offsets)
                if tail:  # the end id goes behind each document's ids
                    ids = np.insert(ids, np.cumsum(n), tail[0])
                    n = n + 1
                upto = np.concatenate([[0], np.cumsum(n)])
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(lo, hi - lo) for i in range(len(keep))), pa.array(np.full(hi - lo, shard, np.int32)),
                     pa.array(start + upto[:-1]), pa.array(n), pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), pa.array(ids))],
                    names=out.names)
                start += int(upto[-1])

    ordered.mapInArrow(encode, out).write.mode("overwrite").options(**PARQUET).parquet(f"{path}/tokens")
    spark = docs.sparkSession
    # one row per shard; the metadata columns are read without the token pages
    sizes = spark.read.schema(out).parquet(f"{path}/tokens").groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    (sizes.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")).alias("base"))
     .coalesce(1).write.mode("overwrite").parquet(f"{path}/shards"))


def read_tokens(spark: SparkSession, path: str, id_type: str = "long", id_col: str = "doc_id",
                metadata: str = "", where: Column | None = None) -> DataFrame:
    """The token table with the global ``start`` of each row. A filter on the id reads only the row
    groups and pages that can hold it; columns that are not used are not read. ``metadata``: names and types
    of the metadata columns."""
    more = [c.split()[0] for c in metadata.split(",") if c.strip()]
    schema = f"`{id_col}` {id_type}, {metadata + ',' if more else ''} shard int, local_start long, n_tokens long, tokens array<int>"
    rows = spark.read.schema(schema).parquet(f"{path}/tokens")
    rows = rows if where is None else rows.filter(where)
    shards = spark.read.schema("shard int, base long").parquet(f"{path}/shards")
    return rows.join(shards, "shard").select(id_col, *more, (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "tokens")


def digest(tokens: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """id, start, n_tokens and the unsigned crc32 of each row's ids as little-endian 32-bit integers."""
    schema = f"`{id_col}` {tokens.schema[id_col].dataType.simpleString()}, start long, n_tokens long, ids_crc32 long"

    def crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(3)
            values = memoryview(lists.values.to_numpy(zero_copy_only=False).astype("<u4").tobytes())
            at = lists.offsets.to_numpy()
            sums = [zlib.crc32(values[4 * lo: 4 * hi]) for lo, hi in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(np.diff(at).astype(np.int64)), pa.array(sums, pa.int64())],
                                             names=[id_col, "start", "n_tokens", "ids_crc32"])

    return tokens.select(id_col, "start", "n_tokens", "tokens").mapInArrow(crc, schema)


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = documents(spark, sf_dir)
    scratch = Scratch(spark, "tokens")
    write_tokens(docs, scratch.path("out"), public_tokenizers.path("byte_bpe_50k.json"))
    return digest(read_tokens(spark, scratch.path("out"), docs.schema["doc_id"].dataType.simpleString()))


QUERIES = {"op1_token_output": op1_token_output}
ORACLES: dict[str, str] = {}
