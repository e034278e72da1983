"""Rows and brute-force helpers that the operator tests share."""

import random
import re

WS = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def lower_az(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return WS.findall(text or "")


def alnum_words(text):
    return ALNUM.findall(lower_az(text))


def corpus(n=60, seed=3, vocabulary=400, long=4000):
    """(doc_id, text): prose with shared passages, exact and near copies, odd characters, null, empty, one
    word, white space only and one very long text."""
    rnd = random.Random(seed)
    vocab = ["".join(rnd.choice("abcdeéßñ") for _ in range(rnd.randint(1, 7))) for _ in range(vocabulary)]
    passage = " ".join(rnd.choice(vocab) for _ in range(60))
    texts = []
    for i in range(n):
        t = " ".join(rnd.choice(vocab) + rnd.choice(["", "", "", ".", ",", "\n"]) for _ in range(rnd.randint(5, 150)))
        if i % 5 == 0:
            t += "\n" + passage + " " + rnd.choice(vocab)
        if i % 7 == 3:
            t = texts[rnd.randrange(len(texts))] or ""
        if i % 7 == 5:
            w = (texts[rnd.randrange(len(texts))] or "").split(" ")
            w[rnd.randrange(len(w))] = "changed"
            t = " ".join(w)
        texts.append(t)
    texts += [None, "", " \t\n", "One", "one two", "A\x0bB\x1fC D", " ".join(rnd.choice(vocab) for _ in range(long)), "É É é É"]
    return [(3 * i + 1, t) for i, t in enumerate(texts)]


def frame(spark, rows, parts=3):
    """Documents of (doc_id, text[, source]) over several partitions."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else f"s{(r[0] or 0) % 4}", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOCS).repartition(parts)


def clash(df):
    """The frame with more columns, named as the operators' own ones."""
    from pyspark.sql import functions as F
    names = ("id", "row", "words", "n", "gid", "tie", "size", "block", "place", "key", "kept", "n_words", "spans", "cls", "__words", "text_hash")
    return df.select("*", *(F.lit(1).alias(x) for x in names))
