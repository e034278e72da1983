import random
import re
from collections import Counter

import pytest
from llm_fixtures import clash, frame, lower_az
from pyspark.sql import functions as F

from lakestrata.llm import phrases

COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def brute(rows, at_least, explained, top):
    """Rows of (text, lang) by counting every phrase."""
    counts, totals = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        f = counts.setdefault(lang, Counter())
        for piece in re.split("[.,;:!?\n-\r]", lower_az(text)):
            w = re.findall("[^ \t]+", piece)
            totals[lang] += len(w)
            for n in range(1, 5):
                f.update(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
    out = []
    for lang, f in counts.items():
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= at_least}
        kept = []
        for p, a in cand.items():
            if any(100 * b >= explained * a for q, b in cand.items() if len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))):
                continue
            score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for i, (s, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, i, p.decode(), -a, left, right, totals[lang], -s))
    return sorted(out)


def texts(n=150, seed=5):
    rnd = random.Random(seed)
    vocab = ["der", "die", "x-y", "é", "Haus", "haus", "#1", "(a)", "ÉA", "日本", "a b"] + [f"w{i}" for i in range(30)]
    fixed = ["new york city hall", "ad hoc", "as well as"]
    out = []
    for i in range(n):
        parts = [rnd.choice([rnd.choice(vocab), rnd.choice(fixed)]) + rnd.choice(["", "", "", ".", ", ", "\n", "\t", "\r\n", "\x0b"]) for _ in range(rnd.randint(0, 60))]
        out.append((" ".join(parts), rnd.choice(["en", "en", "de", None, ""])))
    out += [(None, "en"), ("", None), (" \t ", "de"), ("...", "de"), ("ha " * 3000, "en"), ("one", "und"), ("a b c d e f. " * 40, "de")]
    return out + out[:10]


def documents(spark, rows, parts=3):
    df = frame(spark, [(i % 50, t) for i, (t, _) in enumerate(rows)], 1)
    langs = spark.createDataFrame([(t, x) for t, x in rows], "text string, lang string")
    return langs.repartition(parts) if rows else df


def collect(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


@pytest.mark.parametrize("max_keys", [phrases.MAX_KEYS, 0], ids=["places", "keys"])
def test_brute_force(spark, llm_scratch, max_keys):
    rows = texts()
    got = phrases.collocations(documents(spark, rows), llm_scratch(), at_least=5, top=40, max_keys=max_keys)
    assert got.columns == list(COLUMNS)
    assert collect(got) == brute(rows, 5, 80, 40)


def test_explained_and_ties(spark, llm_scratch):
    rows = [("p q r. " * 10 + "p q. " * 2, "en"), ("s t. u v. " * 6, "en"), ("z y. " * 6, None)]
    got = collect(phrases.collocations(documents(spark, rows), llm_scratch(), at_least=5, top=3))
    assert got == brute(rows, 5, 80, 3)
    assert [r[2] for r in got if r[0] == "en"] == ["s t", "u v", "p q r"]  # "p q" is explained; equal scores by bytes


def test_slices_do_not_matter(spark, llm_scratch, monkeypatch):
    rows = texts(60, 9)
    monkeypatch.setattr(phrases, "SLICE", 64)
    assert collect(phrases.collocations(documents(spark, rows, 1), llm_scratch(), at_least=4, top=100)) == brute(rows, 4, 80, 100)


def test_clashing_columns_and_empty_table(spark, llm_scratch):
    rows = texts(30, 2)
    docs = clash(documents(spark, rows)).withColumns({c: F.lit(7) for c in ("w1", "c", "f", "key", "words", "word", "left", "rank", "a", "score")})
    assert collect(phrases.collocations(docs, llm_scratch(), at_least=4, top=50)) == brute(rows, 4, 80, 50)
    assert collect(phrases.collocations(docs.limit(0), llm_scratch())) == []
    assert collect(phrases.collocations(docs.withColumn("text", F.lit(None).cast("string")), llm_scratch())) == []


def test_one_language_holds_most_and_one_phrase_is_everywhere(spark, llm_scratch):
    rows = [("very common pair indeed " * 200, "en")] * 5 + texts(20, 4)
    assert collect(phrases.collocations(documents(spark, rows), llm_scratch(), at_least=4, top=30)) == brute(rows, 4, 80, 30)


def test_scores_pass_64_bits(spark):
    big = 9 * 10 ** 18 // 2
    rows = [([1], big), ([2], big - 7), ([1, 2], big - 9)]
    df = spark.createDataFrame(rows, "words array<long>, f long")
    assert phrases._scored(df).first()["score"] == 2000000 * (big - 9) // (2 * big - 7)
