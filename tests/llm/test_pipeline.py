"""The stages on the small tables, each against what brute force or the operator's query says of its input."""

import sys
from collections import defaultdict
from pathlib import Path

import public_tokenizers
import pytest
from llm_fixtures import alnum_words, words
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from test_decontaminate import brute as brute_hits  # noqa: E402
from test_mix_sources import targets  # noqa: E402
from test_near_dedup import brute as brute_near  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """name -> (rows in, rows out) of every stage."""
    import corpus_pipeline
    from lakestrata.llm.tables import Scratch, documents

    docs, out, scratch = documents(spark, SF), {}, Scratch(spark, "test-pipeline")
    for name, stage in corpus_pipeline.STAGES:
        result = scratch.keep(stage(spark, docs, SF), name)
        out[name] = (docs, result)
        docs = result
    return out


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_columns(spark, steps):
    columns = spark.read.parquet(f"{SF}/documents.parquet").columns
    assert [name for name in steps] == ["quality", "near_dedup", "decontaminate", "mix", "tokens"]
    assert all(out.columns == columns for name, (_, out) in steps.items() if name != "tokens")


def test_quality(spark, steps):
    from lakestrata.llm.importance import op7_importance
    before, after = steps["quality"]
    kept = {r["doc_id"] for r in op7_importance(spark, SF).filter("kept").collect()}
    assert sorted(rows(after)) == sorted(r for r in rows(before) if r[0] in kept)


def test_near_dedup(steps):
    before, after = steps["near_dedup"]
    assert sorted(r[0] for r in rows(after)) == sorted(r[0] for r in brute_near(rows(before), 5, 80) if r[3])


def test_decontaminate(spark, steps):
    before, after = steps["decontaminate"]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hits = brute_hits(rows(before), items)
    assert sorted(r[0] for r in rows(after)) == sorted(h[0] for h in hits if not h[2])
    assert all(alnum_words(t) for _, t in rows(after))


def test_mix(steps):
    before, after = steps["mix"]
    size, longest, got = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in before.collect():
        n = len(words(r["text"]))
        size[r["source"]] += n
        longest[r["source"]] = max(longest[r["source"]], n)
    for r in after.collect():
        got[r["source"]] += len(words(r["text"]))
    want = targets(dict(size))
    assert all(abs(got[s] - want[s]) <= longest[s] / 2 + 1 for s in size)


def test_tokens_and_run(spark, steps):
    import corpus_pipeline
    before, after = steps["tokens"]
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sorted((i, [*tok.encode(t or "", add_special_tokens=False).ids, 0]) for i, t in rows(before))
    got = after.orderBy("start").collect()
    assert sorted((r["doc_id"], list(r["tokens"])) for r in got) == want
    assert [r["doc_id"] for r in got] == [i for i, _ in want]
    total = 0
    for r in got:
        assert r["start"] == total and r["n_tokens"] == len(r["tokens"])
        total += r["n_tokens"]
    whole = corpus_pipeline.run(spark, SF)
    key = lambda df: sorted((r["doc_id"], r["start"], tuple(r["tokens"])) for r in df.collect())
    assert key(whole) == key(after)


# ------------------------------------------------------------------ odd tables through the whole chain

def odd_tables(spark, at, empty=False):
    """Documents with null and repeated ids, null and empty texts, copies, repeated rows, a very long text and columns named
    as the operators' own; labels and benchmark with nulls."""
    import random

    from llm_fixtures import clash, corpus

    rnd = random.Random(7)
    rows = [(i, t, rnd.choice(["en", None]), rnd.choice(["s0", "s1", None])) for i, t in corpus(80, 11)]
    rows += [(None, rows[3][1], "en", None), (None, "an only text under no id at all, of a few more words", None, "s0"), (None, None, None, None), rows[8], rows[8],
             (rows[5][0], "another text under an id that is there already, long enough", "en", "s1")]
    docs = spark.createDataFrame([(i, t, lang, s, len(t or "")) for i, t, lang, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 0, 1, None])) for i, *_ in rows]
    items = [("b1", " ".join(words(rows[0][1])[:14])), (None, "x y"), ("b2", None), ("b3", "")]
    docs = clash(docs)
    for name, df in (("documents", docs), ("labels", spark.createDataFrame(labels, "doc_id long, quality int, toxic int")),
                     ("benchmark", spark.createDataFrame(items, "item_id string, text string"))):
        (df.limit(0) if empty else df).coalesce(2).write.parquet(f"{at}/{name}.parquet")
    return rows


def chain(spark, at):
    import corpus_pipeline
    from lakestrata.llm.tables import Scratch, documents

    docs, out, scratch = documents(spark, at), [], Scratch(spark, "test-odd")
    for name, stage in corpus_pipeline.STAGES:
        after = scratch.keep(stage(spark, docs, at), name)
        out.append((name, docs, after))
        docs = after
    return out


def test_odd_rows_through_all_stages(spark, scratch):
    odd_tables(spark, scratch)
    for name, before, after in chain(spark, scratch):
        full = lambda df: [tuple(r) for r in df.collect()]
        if name == "tokens":
            assert after.count() == before.count()
            continue
        assert after.columns == before.columns
        old, new = full(before), full(after)
        if name != "mix":
            assert all(new.count(r) <= old.count(r) for r in set(new))
        assert set(new) <= set(old)
        if name == "near_dedup":
            kept = [r[1] for r in new if words(r[1])]
            assert len(kept) == len(set(kept))  # one row of exact copies, whatever their ids
            groups = {frozenset([(" ".join(words(r[1].lower())))]) for r in old if r[1] and words(r[1])}
            assert groups and len(kept) <= len(groups)
            assert {r for r in old if not words(r[1])} <= set(new)  # texts without words are linked with nothing


def test_empty_tables_through_all_stages(spark, scratch):
    odd_tables(spark, scratch, empty=True)
    for name, before, after in chain(spark, scratch):
        assert after.count() == 0 and (name == "tokens" or after.columns == before.columns)
