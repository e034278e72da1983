import random

import pytest
import regex
from llm_fixtures import alnum_words, clash, corpus, frame

from lakestrata.llm import license_scan as op

LINES = ["Licensed under CC BY-NC 4.0.", "All Rights Reserved.", "this work is licensed under the GNU General Public License, version 3.",
         "Released under the MIT license.", "cc by cc by", "CC, by", "all rights\nreserved", "ccby", "acc by", "cc byé"]


def base(text):
    w, out = alnum_words(text), []
    for phrase, label in op.BASE_PHRASES.items():
        p = phrase.split()
        out += [(i, label) for i in range(len(w) - len(p) + 1) if w[i: i + len(p)] == p]
    return len(w), out


def fuzzy(text):
    t = " ".join(alnum_words(text))
    return {n.label for n in map(lambda x: op.Notice(*x), op.NOTICES) if regex.search(f"(?:{n.text}){{e<={n.edits}}}", t)}


def edited(rnd, text, n):
    for _ in range(n):
        i = rnd.randrange(len(text))
        text = rnd.choice([text[:i] + text[i + 1:], text[:i] + "x" + text[i:], text[:i] + "q" + text[i + 1:]])
    return text


def texts():
    rnd = random.Random(8)
    plain = [t for _, t in corpus(30)]
    out = plain + LINES + [f"{a or ''}\n{LINES[i % len(LINES)]}\n{a or ''}" for i, a in enumerate(plain[:12])]
    for n in op.NOTICES:
        for k in range(7):
            out.append(f"{rnd.choice(plain[:20])} {edited(rnd, n[0], k)} {rnd.choice(plain[:20])}")
    return out


def test_equals_brute_force(spark, llm_scratch):
    llm_scratch()
    rows = list(enumerate(texts()))
    got = {r["doc_id"]: r for r in op.scan_licenses(clash(frame(spark, rows))).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        n, places = base(t)
        r = got[i]
        assert (r["n_words"], r["n_base"]) == (n, len(places))
        assert (r["first_word"], r["last_word"]) == ((min(p for p, _ in places), max(p for p, _ in places)) if places else (None, None))
        own = {x for _, x in places}
        assert r["base_labels"] == ",".join(sorted(own))
        assert r["labels"] == ",".join(sorted(own | fuzzy(t))), t
        assert 0 <= r["score"] <= 1 and (r["score"] == 1 if places else (r["score"] > 0) == bool(r["labels"]))


def test_spans_cover_the_notice(spark, llm_scratch):
    llm_scratch()
    rows = [(1, "a b Released, under the MIT licence. c d"), (2, "x " * 3000 + "relaesed under the mit license" + " y" * 3000)]
    got = {r["doc_id"]: r["spans"] for r in op.scan_licenses(frame(spark, rows)).collect()}
    assert [(s["label"], s["first_word"], s["end_word"], s["edits"]) for s in got[1]] == [("mit", 2, 7, 1)]
    assert [(s["label"], s["first_word"], s["end_word"], s["edits"]) for s in got[2]] == [("mit", 3000, 3005, 2)]


def test_seeds_meet_every_edit():
    """With at most `edits` edits, one seed of the notice is untouched."""
    rnd = random.Random(1)
    for n in map(lambda x: op.Notice(*x), op.NOTICES):
        assert "".join(s for _, s in n.seeds()) == n.text and len(n.seeds()) == n.edits + 1
        for _ in range(200):
            t = edited(rnd, n.text, n.edits)
            assert any(s in t for _, s in n.seeds())


@pytest.mark.parametrize("rows", [[], [(None, None), (None, None)]])
def test_empty(spark, llm_scratch, rows):
    llm_scratch()
    got = op.scan_licenses(frame(spark, rows or [(1, "a")]).limit(len(rows))).collect()
    assert [(r["n_words"], r["labels"], r["score"]) for r in got] == [(0, "", 0.0)] * len(rows)


def best_first(text):
    """(label, first word, end word, edits): the best match in the text, then in what is left and right of it."""
    t, out = " ".join(alnum_words(text)), set()
    word = lambda i: t.count(" ", 0, i)

    def search(n, p, lo, hi):
        if m := p.search(t, lo, hi):
            out.add((n.label, word(m.start()), word(max(m.end() - 1, m.start())) + 1, sum(m.fuzzy_counts)))
            search(n, p, lo, m.start())
            search(n, p, m.end(), hi)

    for n in map(lambda x: op.Notice(*x), op.NOTICES):
        search(n, regex.compile(f"(?b)(?:{n.text}){{e<={n.edits}}}"), 0, len(t))
    return out


def test_spans_of_several_notices(spark, llm_scratch):
    """An edited notice is reported beside a better copy, wherever they stand."""
    llm_scratch()
    rnd = random.Random(12)
    rows = ["released under the mxt license and also released under the mit license", "released under the mit licen released under the mit license"]
    for n in op.NOTICES:
        for _ in range(4):
            edits = [rnd.randint(0, op.Notice(*n).edits) for _ in range(rnd.randint(2, 6))]
            rows.append(rnd.choice([" ", " and also "]).join(edited(rnd, n[0], k) for k in edits))
    got = {r["doc_id"]: r["spans"] for r in op.scan_licenses(frame(spark, list(enumerate(rows)))).collect()}
    assert [(s["first_word"], s["end_word"], s["edits"]) for s in got[0]] == [(0, 5, 1), (7, 12, 0)]
    for i, t in enumerate(rows):
        assert {(s["label"], s["first_word"], s["end_word"], s["edits"]) for s in got[i]} == best_first(t), t
