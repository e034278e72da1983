import glob
import struct
import zlib

import public_tokenizers
import pyarrow.parquet as pq
import pytest
from llm_fixtures import clash, corpus, frame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakestrata.llm import token_output as op

PATH = public_tokenizers.path("byte_bpe_50k.json")


def expected(rows):
    tok, start, out = Tokenizer.from_file(PATH), 0, []
    for i, text in sorted(rows, key=lambda r: r[0]):
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((i, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return out


def run(docs, scratch):
    s = scratch()
    op.write_tokens(docs, s.path("out"), PATH)
    return s, op.digest(op.read_tokens(docs.sparkSession, s.path("out")))


def test_equals_the_library(spark, llm_scratch):
    odd = ["x\xa0 y", "a  b\n\n c", "don't we'll  't", "3.14,15 a.b", "<|endoftext|> z", "\x1c\x1d!\x1c?", "日本 語。", "a　 b", "é ½ Ⅷ"]
    rows = corpus(40) + [(1000 + i, t) for i, t in enumerate(odd)]
    _, got = run(clash(frame(spark, rows)), llm_scratch)
    assert sorted(map(tuple, got.collect())) == expected(rows)


def test_repeated_rows_null_ids_and_empty_table(spark, llm_scratch):
    rows = [(5, "b c"), (5, "b c"), (5, "a"), (None, "z"), (1, None)]
    _, got = run(frame(spark, rows), llm_scratch)
    got = sorted(map(tuple, got.collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [1, 5, 5, 5, None]
    assert [r[1] for r in got] == [0, *(sum(x[2] for x in got[:i]) for i in range(1, 5))]
    _, none = run(frame(spark, rows).limit(0), llm_scratch)
    assert none.collect() == []


def test_layout(spark, llm_scratch):
    s, _ = run(frame(spark, corpus(40)), llm_scratch)
    for f in glob.glob(s.path("out").replace("file:", "") + "/tokens/part-*"):
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            columns = {meta.row_group(g).column(c).path_in_schema: meta.row_group(g).column(c) for c in range(meta.num_columns)}
            assert "DELTA_BINARY_PACKED" in columns["local_start"].encodings
            assert any("DICTIONARY" in e for e in next(v for k, v in columns.items() if k.startswith("tokens")).encodings)
            assert all(c.has_offset_index and c.has_column_index for c in columns.values())
    plan = op.read_tokens(spark, s.path("out")).select("doc_id", "n_tokens")._jdf.queryExecution().toString()
    assert "tokens:array" not in plan.split("ReadSchema")[1].split("\n")[0]
    some = op.read_tokens(spark, s.path("out"), where=F.col("doc_id") == 4)
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,4)" in some._jdf.queryExecution().toString()
    assert some.count() == 1


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_round_trip(spark, llm_scratch, name):
    """Other tokenizers get whole texts."""
    s, path = llm_scratch(), public_tokenizers.path(name)
    rows = [(1, "some words here."), (2, "and more"), (3, None)]
    op.write_tokens(frame(spark, rows), s.path("out"), path, end_id=None, metadata=("source",))
    tok = Tokenizer.from_file(path)
    got = {r["doc_id"]: r for r in op.read_tokens(spark, s.path("out"), metadata="source string").collect()}
    assert {i: list(r["tokens"]) for i, r in got.items()} == {i: tok.encode(t or "", add_special_tokens=False).ids for i, t in rows}
    assert got[2]["source"] == "s2"
