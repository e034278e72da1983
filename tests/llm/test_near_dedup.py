import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import clash, corpus, frame, lower_az, words

from lakestrata.llm import near_dedup as op
from lakestrata.llm.words import word_slices


def shingles(text, k):
    w = words(lower_az(text))
    return {tuple(w[i: i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def brute(rows, k, percent):
    sets = [shingles(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            parent[find(a)] = find(b)
    key = [op.NO_ID if i is None else i for i, _ in rows]
    low = {}
    for x in range(len(rows)):
        low[find(x)] = min(low.get(find(x), op.NO_ID), key[x])
    none = lambda v: None if v == op.NO_ID else v
    return sorted(((i, len(s), none(low[find(x)]), key[x] == low[find(x)]) for x, ((i, _), s) in enumerate(zip(rows, sets))), key=str)


def near_copies(n, seed, length=60):
    """Random edits of one text: some linked with the origin, some only with each other, some with none."""
    rnd = random.Random(seed)
    origin = [f"w{rnd.randrange(500)}" for _ in range(length)]
    rows = []
    for i in range(n):
        w = list(origin)
        for _ in range(rnd.choice([0, 1, 1, 2, 2, 3, 4, 6])):
            w[rnd.randrange(length)] = rnd.choice(["alpha", "beta", f"u{i}"])
        rows.append((1000 - i, " ".join(w)))
    return rows


def run(spark, rows, scratch, **how):
    got = op.near_duplicates(clash(frame(spark, rows)), scratch(), **how).collect()
    return sorted(map(tuple, got), key=str)


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_equals_brute_force(spark, llm_scratch, k, percent):
    rows = corpus(40) + [(2, corpus(40)[1][1]), (2, "other words with the same id"), (None, corpus(40)[1][1]), (None, None)]
    assert run(spark, rows, llm_scratch, shingle=k, percent=percent) == brute(rows, k, percent)


@pytest.mark.parametrize("centres,seed", [(1, 1), (32, 2)])
def test_large_group_of_near_copies(spark, llm_scratch, monkeypatch, centres, seed):
    """No link is lost in a bucket, however few classes meet the others at a time."""
    monkeypatch.setattr(op, "CENTRES", centres)
    rows = near_copies(70, seed)
    assert run(spark, rows, llm_scratch, shingle=3, percent=85) == brute(rows, 3, 85)


def test_chain(spark, llm_scratch):
    """Neighbours are linked, the ends are not alike: one component."""
    w = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(w[8 * i: 8 * i + 200])) for i in range(20)]
    truth = brute(rows, 3, 85)
    assert {r[2] for r in truth} == {0}
    assert run(spark, rows, llm_scratch, shingle=3, percent=85) == truth


def test_sketch_fills_and_estimates():
    """Every coordinate fills for sets of any size, and equal coordinates estimate the similarity."""
    rnd = random.Random(4)
    for n in (1, 2, 5, 60, 3000):
        both, own = [f"b{rnd.random()}" for _ in range(n)], [f"o{rnd.random()}" for _ in range(max(1, n // 4))]
        texts = [" ".join(both), " ".join(both + own)]
        (_, _, w), = word_slices(pa.array(texts), "space", True)
        h, first = op.shingle_sets(w, 1)
        s = op.sketches(h, first, 128)
        assert (s != np.iinfo(np.uint64).max).all()
        true = n / (n + len(own))
        assert abs((s[0] == s[1]).mean() - true) < 0.17


def test_one_of_each_and_empty_table(spark, llm_scratch):
    rows = near_copies(30, 5) + corpus(10)
    docs = clash(frame(spark, rows))
    kept = op.one_of_each(docs, llm_scratch())
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r[0] for r in brute(rows, 5, 80) if r[3])
    assert op.near_duplicates(docs.limit(0), llm_scratch()).collect() == []


def test_one_of_each_with_null_and_repeated_ids(spark, llm_scratch):
    """Exactly one row of a component stays, whatever its ids; no other document goes."""
    text = lambda name: " ".join(f"{name}{i}" for i in range(60))
    near = text("c").replace("c7 ", "x ")
    rows = [(1, text("a")), (None, text("a")), (None, text("b")), (None, text("c")), (None, near), (None, text("c")),  # c: only null ids
            (2, text("a")), (2, text("d")), (3, text("e")), (3, text("e")), (3, text("f")), (4, text("f")), (None, None), (None, None), (None, "")]
    docs = clash(frame(spark, rows))
    kept = op.one_of_each(docs, llm_scratch())
    assert kept.columns == docs.columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    of_c = [r for r in got if r[0] is None and r[1] in (text("c"), near)]
    assert len(of_c) == 1
    want = [(1, text("a")), (None, text("b")), (2, text("d")), (3, text("e")), (3, text("f")), (None, None), (None, None), (None, "")]
    assert got == sorted(want + of_c, key=str)
    again = op.one_of_each(docs.repartition(7), llm_scratch()).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in again), key=str) == got
