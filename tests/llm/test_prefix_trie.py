import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from lakestrata.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def sequences(rows):
    """conv_id -> its (role, text) in order."""
    def key(r):
        role, text = r[2] or "", r[3] or ""
        return (r[1] is not None, r[1] or 0, role, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest())

    out = {}
    for r in sorted((r for r in rows if r[0] is not None), key=key):
        out.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    return out


def rebuilt(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = int(c / 20) * 20 if abs(c) < 2 ** 50 else c - c % 20
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def brute(seqs):
    nodes = {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            nodes.setdefault(tuple(s[:d]), []).append(c)
    out = []
    for p, members in nodes.items():
        below = [q for q in nodes if q[: len(p)] == p]
        children = [q for q in below if len(q) == len(p) + 1]
        leaves = sum(not any(len(r) == len(q) + 1 and r[: len(q)] == q for r in below) for q in below)
        saved = sum((len(nodes[q]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", q[-1][1])) for q in below if q)
        ends = ",".join(str(c) for c in sorted(members) if len(seqs[c]) == len(p))
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), len(children), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def collect(df):
    assert df.columns == list(COLUMNS)
    return sorted((tuple(r) for r in df.collect()), key=str)


def talks(n=120, seed=1):
    rnd = random.Random(seed)
    texts = ["hi", "hello there", "", None, "a b\tc", "ok fine", "what", " "]
    rows = []
    for c in range(n):
        for t in range(rnd.choice([1, 1, 2, 3, 4, 6])):
            rows.append((c * rnd.choice([1, 1, 1, 7]), t, rnd.choice(["user", "user", "assistant", None]), rnd.choice(texts)))
    copies = [(t, "user", f"copied {t} words") for t in range(4)]
    rows += [(c, *x) for c in range(1000, 1040) for x in copies]
    rows += [(5000, t, "user", f"long {t}") for t in range(150)] + [(5020, t, "user", f"long {t}") for t in range(149)]
    rows += [(None, 0, "user", "lost"), (-45, None, "user", "before"), (-45, 1, "user", "after"), (-45, 1, "user", "after"), (77777, 2, None, None), (-40, 0, "user", "negative")]
    rnd.shuffle(rows)
    return rows


def df_of(spark, rows, parts=3):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


@pytest.mark.parametrize("shard_turns", [prefix_trie.SHARD_TURNS, 40, 1], ids=["one", "some", "each"])
@pytest.mark.parametrize("branch", [True, False], ids=["branched", "own"])
def test_brute_force(spark, llm_scratch, shard_turns, branch):
    rows = talks()
    scratch = llm_scratch()
    paths = prefix_trie.turn_paths(df_of(spark, rows))
    got = collect(prefix_trie.prefix_trie(prefix_trie.branched(paths, scratch) if branch else paths, scratch, shard_turns=shard_turns))
    own = sequences(rows)
    assert got == brute(rebuilt(own) if branch else own)


def test_copies_over_many_shards(spark, llm_scratch):
    rows = [(c, t, "user", f"turn {t}") for c in range(3000, 3400) for t in range(3)] + [(c, 0, "user", f"turn {c % 2}") for c in range(50)]
    scratch = llm_scratch()
    got = collect(prefix_trie.prefix_trie(prefix_trie.turn_paths(df_of(spark, rows)), scratch, shard_turns=25))
    assert got == brute(sequences(rows))


def test_blocks_of_columns(spark, llm_scratch, monkeypatch):
    rows = talks(40, 8)
    monkeypatch.setattr(prefix_trie, "BLOCK", 3)
    assert collect(prefix_trie.prefix_trie(prefix_trie.turn_paths(df_of(spark, rows)), llm_scratch(), shard_turns=60)) == brute(sequences(rows))


def test_turnless_clashing_and_empty(spark, llm_scratch):
    # the only turn goes, and conversation 0 is not there
    c = next(i for i in range(1, 20) if zlib.crc32(str(i).encode()) % 4)
    rows = [(c, 0, "user", "x")]
    df = df_of(spark, rows).withColumns({x: F.lit(3) for x in ("path", "words", "id", "own", "base", "h", "key", "depth", "part", "numbered")})
    scratch = llm_scratch()
    got = collect(prefix_trie.prefix_trie(prefix_trie.branched(prefix_trie.turn_paths(df), scratch), scratch))
    assert got == brute(rebuilt(sequences(rows))) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]
    scratch = llm_scratch()
    assert collect(prefix_trie.prefix_trie(prefix_trie.branched(prefix_trie.turn_paths(df.limit(0)), scratch), scratch)) == []


def test_long_text_and_repeated_rows(spark, llm_scratch):
    rows = [(1, 0, "user", "word " * 200_000), (2, 0, "user", "word " * 200_000), (2, 0, "user", "word " * 200_000), (2, 0, "user", "word " * 200_000)]
    assert collect(prefix_trie.prefix_trie(prefix_trie.turn_paths(df_of(spark, rows)), llm_scratch())) == brute(sequences(rows))
