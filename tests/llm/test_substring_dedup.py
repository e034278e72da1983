import random
import time

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from llm_fixtures import clash, corpus, frame, words

from lakestrata.llm import substring_dedup as op


def brute(rows, k):
    first = {}
    for i, t in rows:
        w = words(t)
        for j in range(len(w) - k + 1):
            key = tuple(w[j: j + k])
            first[key] = min(first.get(key, op.NO_ID + 1), op.NO_ID if i is None else i)
    out = []
    for i, t in rows:
        w = words(t)
        gone = {p for j in range(len(w) - k + 1) if first[tuple(w[j: j + k])] < (op.NO_ID if i is None else i) for p in range(j, j + k)}
        out.append((i, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return sorted(out, key=str)


@pytest.mark.parametrize("group_bytes", [1 << 20, 1500])
def test_equals_brute_force(spark, llm_scratch, group_bytes):
    llm_scratch()
    rows = corpus(60) + [(1, corpus(60)[9][1]), (None, corpus(60)[5][1]), (None, corpus(60)[5][1])]
    got = op.remove_repeats(clash(frame(spark, rows)), group_bytes=group_bytes).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 13)


@pytest.mark.parametrize("k,seed", [(3, 1), (5, 2), (13, 3)])
def test_branching_graphs(spark, llm_scratch, k, seed):
    """Few different words: windows repeat inside and across texts, and the graph branches everywhere."""
    llm_scratch()
    rnd = random.Random(seed)
    base = [rnd.choice("abc") for _ in range(200)]
    rows = []
    for i in range(40):
        lo = rnd.randrange(150)
        w = base[lo: lo + rnd.randrange(60)] + [rnd.choice("abcd") for _ in range(rnd.randrange(12))] + base[:rnd.randrange(40)]
        rows.append((rnd.randrange(60), " ".join(w)))
    got = op.remove_repeats(frame(spark, rows), k=k, group_bytes=200).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, k)


def test_hot_passage_and_empty_table(spark, llm_scratch):
    llm_scratch()
    passage = " ".join(f"w{i}" for i in range(60))
    rows = [(i, f"x{i} y{i} {passage} z{i}") for i in range(300)]
    got = {r[0]: r for r in op.remove_repeats(frame(spark, rows), group_bytes=2000).collect()}
    assert got[0]["n_removed"] == 0 and all(got[i]["n_removed"] == 60 for i in range(1, 300))
    assert got[7]["kept_text"] == "x7 y7 z7"
    assert op.remove_repeats(frame(spark, rows).limit(0)).collect() == []


def test_text_exchange_runs_once(spark, llm_scratch):
    llm_scratch()
    df = op.remove_repeats(frame(spark, corpus(20)))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    texts = [x for x in plan.split("\n") if "Exchange hashpartitioning(gid" in x and "ReusedExchange" in x]
    assert len(texts) >= 3


def group_table(rows):
    ids = [op.NO_ID if i is None else i for i, _ in rows]
    return pa.table({"id": pa.array(ids, pa.int64()), "no_id": pa.array([i is None for i, _ in rows]),
                     "text": pa.array([t or "" for _, t in rows]), "tie": pa.array(range(len(rows)), pa.int64())})


def test_judging_grows_with_the_hashes():
    """Many groups that share their passages: a bucket sorts what it gets once, not once per group."""
    texts = [" ".join(f"p{i}w{j}" for j in range(1500)) for i in range(700)]
    began = time.perf_counter()
    sent = pa.concat_tables([op._send_anchors(13, 1)((pa.scalar(g),), group_table([(g, texts[g // 2])])) for g in range(1400)])
    sending = time.perf_counter() - began
    began = time.perf_counter()
    told = op._judge_anchors((pa.scalar(0),), sent)
    assert time.perf_counter() - began < sending
    assert told.column("gid").to_pylist() == list(range(1400))
    assert all(set(a.as_py()) == {1} for a in told.column("answer"))


def in_groups(rows, k, n_groups, n_buckets):
    """The steps of the operator without Spark."""
    groups = {g: group_table(rows[g::n_groups]) for g in range(n_groups)}

    def of(table, column, value):
        return table.filter(pc.equal(table.column(column), value))

    def judged(judge, sent):
        return pa.concat_tables([judge((pa.scalar(b),), of(sent, "bucket", b)) for b in sorted(set(sent.column("bucket").to_pylist()))])

    shared = judged(op._judge_anchors, pa.concat_tables([op._send_anchors(k, n_buckets)((pa.scalar(g),), t) for g, t in groups.items()]))
    edges = pa.concat_tables([op._send_edges(k, n_buckets)((pa.scalar(g),), t, of(shared, "gid", g)) for g, t in groups.items()])
    told = pa.concat_tables([shared, judged(op._judge_edges, edges)])
    paths = pa.concat_tables([op._find_paths(k)((pa.scalar(g),), t, of(told, "gid", g)) for g, t in groups.items()])
    keys = list(zip(*(paths.column(c).to_pylist() for c in ("head", "n_edges", "check1", "check2")), strict=True))
    first = {}
    for key, i in zip(keys, paths.column("first_id").to_pylist(), strict=True):
        first[key] = min(first.get(key, i), i)
    paths = paths.set_column(paths.column_names.index("first_id"), "first_id", pa.array([first[key] for key in keys], pa.int64()))
    out = [r for g, t in groups.items() for r in op._remove(k)((pa.scalar(g),), t, of(paths, "gid", g)).to_pylist()]
    return sorted(((r["id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in out), key=str)


@pytest.mark.parametrize("bits", [3, 8, 32])
@pytest.mark.parametrize("k", [3, 13])
def test_hashes_that_meet_by_chance(monkeypatch, bits, k):
    """Few bits in the messages: strangers meet in a bucket, and nothing else is removed."""
    whole = op._message_table

    def few(gid, values, bodies, n_buckets):
        bodies = bodies.copy()
        part = bodies if bodies.dtype == np.uint32 else bodies["value"]
        part &= np.uint32((1 << bits) - 1)
        return whole(gid, values, bodies, n_buckets)

    monkeypatch.setattr(op, "_message_table", few)
    rnd = random.Random(k)
    base = [rnd.choice("abc") for _ in range(200)]
    rows = corpus(60) + [(None, corpus(60)[5][1])]
    rows += [(rnd.randrange(60), " ".join(base[lo: lo + rnd.randrange(60)] + base[:rnd.randrange(40)])) for lo in range(0, 150, 5)]
    assert in_groups(rows, k, 7, 3) == brute(rows, k)
