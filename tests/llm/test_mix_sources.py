from collections import Counter, defaultdict

import pytest
from llm_fixtures import clash, corpus, frame, words
from pyspark.sql import functions as F

from lakestrata.llm import mix_sources as op


def targets(sizes):
    """Reshare the excess by weight until nothing is above three times its size."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, free, out = float(sum(sizes.values())), set(order), {}
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        full = {s for s in free if share[s] > 3 * sizes[s]}
        if not full:
            return out | share
        for s in full:
            out[s] = 3.0 * sizes[s]
        left, free = left - sum(out[s] for s in full), free - full
    return out


def rows_of(n=80, seed=5):
    names = ["a", "B", "é", "zz", "c", None]
    return [(i, t, names[(i * i + i // 3) % 6]) for i, t in corpus(n, seed, long=1500)]


@pytest.mark.parametrize("blocks", [4, 4096])
def test_targets_and_taken(spark, llm_scratch, monkeypatch, blocks):
    monkeypatch.setattr(op, "BLOCKS", blocks)
    monkeypatch.setattr(op, "SHARD_WORDS", 500)
    rows = rows_of()
    out = op.draw(clash(frame(spark, rows)), llm_scratch())
    got = [r.asDict(recursive=True) for r in out.collect()]
    assert len(got) == len(rows)
    size = {i: len(words(t)) for i, t, _ in rows}
    assert all(r["size"] == size[r["row"]["doc_id"]] for r in got)
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in got:
        sizes[r["row"]["source"]] += r["size"]
        taken[r["row"]["source"]] += sum(d["words"] for d in r["draws"])
        assert sum(d["words"] for d in r["draws"]) <= 3 * r["size"]
    want = targets(dict(sizes))
    for r in got:
        assert r["source_size"] == sizes[r["row"]["source"]]
        assert r["target"] == pytest.approx(want[r["row"]["source"]])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 0.5
    again = op.draw(frame(spark, rows, 5), llm_scratch()).select("row.doc_id", "draws")
    assert {r["doc_id"]: r["draws"] for r in again.collect()} == {r["doc_id"]: r["draws"] for r in out.select("row.doc_id", "draws").collect()}


def test_splitting_tree(spark):
    quotas = {0: 700, 1: 250, 2: 1, 3: 0, 4: 73}
    df = spark.createDataFrame(list(quotas.items()), "rank int, n long")
    got = op.split_quotas(df, 4, 11).collect()
    by_source, by_shard = Counter(), Counter()
    for r in got:
        by_source[r["rank"]] += r["n"]
        by_shard[r["shard"]] += r["n"]
    assert by_source == Counter(quotas) and sorted(by_shard) == list(range(16))
    assert max(by_shard.values()) - min(by_shard.values()) <= 1
    # shares follow the quotas: 700 of 1024 of each shard's 64 blocks, standard deviation 3.7
    assert all(abs(r["n"] - 64 * 700 / 1024) < 18 for r in got if r["rank"] == 0)


def test_tree_law(spark):
    """Left counts of many roots have the mean and variance of the hypergeometric law."""
    counts = []
    df = spark.createDataFrame([(0, 12), (1, 8)], "rank int, n long")
    for seed in range(60):
        counts.append(next(r["n"] for r in op.split_quotas(df, 1, seed).collect() if r["shard"] == 0 and r["rank"] == 0))
    mean = sum(counts) / len(counts)
    assert abs(mean - 6) < 0.6
    assert 0.5 < sum((c - mean) ** 2 for c in counts) / len(counts) < 2.3  # 1.26 expected


def test_draws_are_disjoint_and_rows_repeat(spark, llm_scratch, monkeypatch):
    monkeypatch.setattr(op, "SHARD_WORDS", 300)
    rows = rows_of()
    docs = frame(spark, rows)
    passes = op.draw(docs, llm_scratch()).select("row.doc_id", F.explode("draws").alias("d")).select("doc_id", "d.pass").collect()
    assert max(Counter(map(tuple, passes)).values()) == 1
    whole = op.mixed_documents(docs, llm_scratch())
    assert whole.columns == docs.columns and set(r["text"] for r in whole.collect()) <= {t for _, t, _ in rows}
    cut = op.mixed_documents(docs, llm_scratch(), whole=False)
    got, size = defaultdict(int), defaultdict(int)
    for r in cut.collect():
        got[r["source"]] += len(words(r["text"]))
    for i, t, s in rows:
        size[s] += len(words(t))
    want = targets(dict(size))
    assert all(abs(got[s] - want[s]) <= 0.5 for s in size)


def test_empty_and_wordless(spark, llm_scratch):
    assert op.draw(frame(spark, rows_of()).limit(0), llm_scratch()).collect() == []
    got = op.draw(frame(spark, [(1, None, "a"), (1, None, "a"), (2, " ", None)]), llm_scratch()).collect()
    assert [(r["size"], r["target"], r["draws"]) for r in got] == [(0, 0.0, [])] * 3
