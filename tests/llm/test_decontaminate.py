import hashlib

import pytest
from llm_fixtures import alnum_words, clash, corpus, frame

from lakestrata.llm import decontaminate as op

ITEMS = "item_id long, text string"


def items_of(rows):
    passage = " ".join((rows[0][1] or "").split()[-30:])
    return [(10, passage), (9, passage + " tail"), (2, "One"), (3, "changed"), (4, None), (5, " ."), (None, "É É"), (7, rows[-2][1]),
            (10, "one two"), (11, "nothing of this kind is anywhere in here at all really")]


def brute(rows, items):
    wins = {}
    for item, t in items:
        w = alnum_words(t)
        n = min(len(w), 10)
        for j in range(len(w) - n + 1 if w else 0):
            wins.setdefault(tuple(w[j: j + n]), set()).add("null" if item is None else str(item))
    out = []
    for i, t in rows:
        w, hit, found = alnum_words(t), set(), set()
        for n in {len(x) for x in wins}:
            for j in range(len(w) - n + 1):
                if tuple(w[j: j + n]) in wins:
                    hit |= set(range(j, j + n))
                    found |= wins[tuple(w[j: j + n])]
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), hit))
    return out


@pytest.mark.parametrize("bound", [500_000, 0])
def test_equals_brute_force(spark, llm_scratch, monkeypatch, bound):
    """With the broadcast and, beyond its bound, with the shuffle."""
    monkeypatch.setattr(op, "MAX_BROADCAST_WINDOWS", bound)
    rows = corpus(40) + [(4, corpus(40)[1][1]), (None, "a one two b"), (None, None)]
    items = items_of(rows)
    got = op.contamination(clash(frame(spark, rows)), spark.createDataFrame(items, ITEMS), llm_scratch()).collect()
    sha = lambda r: hashlib.sha256(",".join(r["items"]).encode()).hexdigest()
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], sha(r)) for r in got), key=str) == \
        sorted((x[:5] for x in brute(rows, items)), key=str)
    for r in got:
        assert all(a["end"] < b["start"] for a, b in zip(r["spans"], r["spans"][1:]))


def test_drop_and_cut(spark, llm_scratch):
    rows = corpus(40)
    items = items_of(rows)
    docs, bench = clash(frame(spark, rows)), spark.createDataFrame(items, ITEMS)
    truth = {x[0]: x for x in brute(rows, items)}
    kept = op.drop_contaminated(docs, bench, llm_scratch())
    assert kept.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in kept.collect()} == {i: t for i, t in rows if not truth[i][2]}
    cut = {r["doc_id"]: r["text"] for r in op.cut_spans(docs, bench, llm_scratch()).collect()}
    for i, t in rows:
        w = alnum_words(t)
        assert alnum_words(cut[i]) == [x for j, x in enumerate(w) if j not in truth[i][5]]
        if not truth[i][2]:
            assert cut[i] == t


def test_no_items_and_empty_table(spark, llm_scratch):
    rows = corpus(8)
    none = spark.createDataFrame([(1, None)], ITEMS)
    got = op.contamination(frame(spark, rows), none, llm_scratch()).collect()
    assert len(got) == len(rows) and not any(r["n_hit"] for r in got)
    assert op.drop_contaminated(frame(spark, rows), none.limit(0), llm_scratch()).count() == len(rows)
    assert op.contamination(frame(spark, rows).limit(0), spark.createDataFrame([(1, "a")], ITEMS), llm_scratch()).collect() == []


def test_no_python_in_the_plan(spark, llm_scratch):
    df = op.contamination(frame(spark, corpus(5)), spark.createDataFrame([(1, "a b c")], ITEMS), llm_scratch())
    assert not any(x in df._jdf.queryExecution().executedPlan().toString() for x in ("Python", "Arrow", "Pandas"))
