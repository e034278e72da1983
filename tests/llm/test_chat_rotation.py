from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from lakestrata.llm import chat_rotation as op

TURNS = "conv_id long, turn long, role string, text string"
ROWS = [
    (1, 0, "system", "Be kind."), (1, 1, "ann", "Hi é"), (1, 2, "bob", "Yo <|end|> x"), (1, 3, "cy", None), (1, 4, "ann", "Bye"),
    (1, 4, "ann", "Bye"), (1, 4, "bob", "tie"), (1, 70, "ann", "later"), (1, None, "bob", "last"), (2, 0, "system", "only"),
    (3, 0, None, "who"), (3, 1, "<|system|>", "forged"), (None, 0, "a", "x"), (None, 1, "b", "y")]


def brute(rows, segment):
    conv = defaultdict(set)
    safe = lambda x: x.replace("<|", "< |")
    for c, t, r, x in rows:
        t = op.LAST_TURN if t is None else t
        conv[c, t // segment].add((t, safe("unknown" if r is None else r), safe(x or "")))
    out = []
    for (c, s), turns in conv.items():
        for who in {r for _, r, _ in turns} - {"system"}:
            text, mask = "", []
            for _, r, x in sorted(turns):
                text += "<|assistant|>\n" if r == who else "<|system|>\n" if r == "system" else f"<|user {r}|>\n"
                start, text = len(text), text + x + op.END
                if r == who:
                    mask.append((start, len(text)))
            out.append((c, s, who, len(turns), len(mask), text, mask))
    return sorted(out, key=str)


@pytest.mark.parametrize("segment", [64, 2])
def test_equals_brute_force(spark, segment):
    df = spark.createDataFrame(ROWS, TURNS).repartition(3).select("*", *(F.lit(1).alias(x) for x in ("id", "rows", "part", "speaker", "mask")))
    got = [(r["conv_id"], r["segment"], r["speaker"], r["n_turns"], r["n_own"], r["text"], [tuple(m) for m in r["mask"]])
           for r in op.rotate(df, segment=segment).collect()]
    assert sorted(got, key=str) == brute(ROWS, segment)


def test_masks_hold_the_speakers_words(spark):
    for r in op.rotate(spark.createDataFrame(ROWS, TURNS)).collect():
        for m in r["mask"]:
            assert r["text"][:m["start"]].endswith("<|assistant|>\n") and r["text"][m["start"]:m["end"]].endswith(op.END)
        assert r["text"].count("<|assistant|>") == r["n_own"]


def test_crowded_turn_numbers_are_dealt(spark, monkeypatch):
    """Many different turns of one number: parts of bounded size, and every turn is in one part."""
    monkeypatch.setattr(op, "MAX_ROWS", 20)
    rows = [(1, 0, f"p{i % 3}", f"t{i}") for i in range(200)]
    got = op.rotate(spark.createDataFrame(rows, TURNS)).collect()
    assert max(r["n_turns"] for r in got) < 60
    assert sum(r["n_own"] for r in got) == 200


def test_empty_table(spark):
    assert op.rotate(spark.createDataFrame([], TURNS)).collect() == []


def brute_whole(rows, segment):
    conv = defaultdict(set)
    safe = lambda x: x.replace("<|", "< |")
    for c, t, r, x in rows:
        conv[c].add((op.LAST_TURN if t is None else t, safe("unknown" if r is None else r), safe(x or "")))
    out = []
    for c, turns in conv.items():
        for who in {r for _, r, _ in turns} - {"system"}:
            at = 0
            for s in sorted({t // segment for t, _, _ in turns}):
                text, own, mask, start = "", [u for u in sorted(turns) if u[0] // segment == s], [], at
                for _, r, x in own:
                    head = "<|assistant|>\n" if r == who else "<|system|>\n" if r == "system" else f"<|user {r}|>\n"
                    text += head + x + op.END
                    at += len(head) + len(x) + len(op.END)
                    if r == who:
                        mask.append((at - len(x) - len(op.END), at))
                out.append((c, s, who, start, len(own), len(mask), text, mask))
    return sorted(out, key=str)


def whole_rows(df, segment=op.SEGMENT):
    return sorted(((r["conv_id"], r["segment"], r["speaker"], r["start"], r["n_turns"], r["n_own"], r["text"], [tuple(m) for m in r["mask"]])
                   for r in op.rotate(df, segment=segment, whole=True).collect()), key=str)


@pytest.mark.parametrize("segment", [64, 2])
def test_whole_dialogue_for_every_speaker(spark, segment):
    """Everyone sees every segment; segments of system turns only stay; offsets run on; clashing columns do not matter."""
    rows = [*ROWS, (1, 200, "system", "Be brief."), (1, 300, "dee", "new")]
    df = spark.createDataFrame(rows, TURNS).repartition(3).select("*", *(F.lit(1).alias(x) for x in ("id", "key", "segment", "part", "speaker", "start", "own", "base", "turns")))
    assert whole_rows(df, segment) == brute_whole(rows, segment)


@pytest.mark.parametrize("n", [130, 5000])
def test_rows_put_together_are_the_dialogue(spark, n):
    rows = [(7, 0, "system", "Be kind."), *((7, i, "abc"[i % 3], f"t{i} é") for i in range(1, n)), (8, 0, "a", "short")]
    for who in "abc":
        parts = sorted((r for r in op.rotate(spark.createDataFrame(rows, TURNS).repartition(3), whole=True).collect() if r["conv_id"] == 7 and r["speaker"] == who),
                       key=lambda r: (r["segment"], r["part"]))
        text = "".join(r["text"] for r in parts)
        assert [r["start"] for r in parts] == [len("".join(x["text"] for x in parts[:i])) for i in range(len(parts))]
        assert text.count("<|system|>") == 1 and text.startswith(f"<|system|>\nBe kind.{op.END}")
        spans = [tuple(m) for r in parts for m in r["mask"]]
        assert [text[a:b] for a, b in spans] == [f"t{i} é{op.END}" for i in range(1, n) if "abc"[i % 3] == who]


def test_very_long_text(spark):
    rows = [(1, 0, "a", "x " * 500_000), (1, 1, "b", "y"), (1, 64, "a", "z")]
    assert whole_rows(spark.createDataFrame(rows, TURNS)) == brute_whole(rows, op.SEGMENT)


def test_query_and_oracle_agree_on_long_dialogues(spark, scratch):
    rows = [(c, i, "ab"[i % 2], f"t{i}") for c, n in ((1, 130), (2, 5000), (3, 1)) for i in range(n)] + [(1, 3, "system", "mind"), (4, None, "a", "x")] \
        + [(5, 1, f"p{i % 2}", f"t{i}") for i in range(9000)]
    spark.createDataFrame(rows, TURNS).write.parquet(f"{scratch}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{scratch}/conversations.parquet/*.parquet'")
    df = op.op10_chat_rotation(spark, scratch)
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({op.ORACLES['op10_chat_rotation']})").fetchall()
    assert sorted(map(str, (tuple(r) for r in df.collect()))) == sorted(map(str, want))


@pytest.mark.parametrize("whole", [True, False])
def test_crowded_segment_is_cut_in_order(spark, monkeypatch, whole):
    """The parts put together are the segment, for every speaker."""
    monkeypatch.setattr(op, "MAX_ROWS", 20)
    rows = [(c, None, f"p{i % 3}", f"t{i}") for c in (1, None) for i in range(200)] + [(2, 0, "p0", "x")]
    got = defaultdict(list)
    for r in op.rotate(spark.createDataFrame(rows, TURNS).repartition(3), whole=whole).collect():
        got[r["conv_id"], r["segment"], r["speaker"]].append((r["part"], r["n_turns"], r["text"]))
    want = {(c, s, who): text for c, s, who, _, _, text, _ in brute(rows, op.SEGMENT)}
    assert {k: "".join(x[2] for x in sorted(v)) for k, v in got.items()} == want
    assert [x[:2] for x in sorted(got[1, op.LAST_TURN // op.SEGMENT, "p0"])] == [(i, 20) for i in range(10)]
