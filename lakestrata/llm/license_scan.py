"""Operator 3: license scan with fuzzy search for short notices.

A notice that may have k edits is split into k + 1 seeds: at least one of them is in the text without an
edit. One automaton over all seeds finds the candidate places in a pass over the normalised text (words
lower-cased, one space between them); there the regex library's bounded-error matching looks for the whole
notice with at most k edits and reports the span and the number of edits. Where matches overlap, the one with
the fewest edits counts, then the first; every other one is reported, however near a better one is. Base phrases
are exact sequences of words.

Texts are scanned in slices inside the scan's own tasks: nothing is shuffled, and a task holds one slice.

Defined results: null and empty texts have no words, empty labels and the score 0; matches never cross a
document border; repeated rows are scanned alike; other columns do not matter.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lakestrata.llm.tables import documents
from lakestrata.llm.words import Words, word_slices

BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: (normalised notice, label) for the fuzzy search
NOTICES = (
    ("licensed under cc by", "cc-by"),
    ("licensed under a creative commons attribution", "cc-by"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("licensed under the gnu general public license version", "gpl"),
    ("redistribution and use in source and binary forms with or without modification", "bsd"),
    ("released into the public domain", "public-domain"),
    ("all rights reserved", "reserved"),
)
SPAN = T.StructType([T.StructField("label", T.StringType()), T.StructField("first_word", T.LongType()),
                     T.StructField("end_word", T.LongType()), T.StructField("edits", T.IntegerType())])


@dataclass(frozen=True)
class Notice:
    text: str
    label: str

    @property
    def edits(self) -> int:
        return max(1, len(self.text) // 10 - 1)

    def seeds(self) -> list[tuple[int, str]]:
        """The notice in ``edits + 1`` parts of nearly equal length, with their places."""
        at = [len(self.text) * i // (self.edits + 1) for i in range(self.edits + 2)]
        return [(lo, self.text[lo:hi]) for lo, hi in zip(at, at[1:])]


class Scanner:
    def __init__(self, phrases: dict[str, str], notices: tuple[tuple[str, str], ...]) -> None:
        import ahocorasick
        import regex

        self.phrases = []
        for phrase, label in phrases.items():
            _, _, w = next(word_slices(pa.array([phrase]), "alnum", True))
            self.phrases.append((w.hashes(), label))
        self.notices = [Notice(*n) for n in notices]
        self.leftmost, self.best = ([regex.compile(f"{how}(?:{regex.escape(n.text)}){{e<={n.edits}}}") for n in self.notices] for how in ("", "(?b)"))
        seeds: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for k, n in enumerate(self.notices):
            for lo, seed in n.seeds():
                seeds[seed.encode().decode("latin-1")].append((k, lo))
        self.automaton = ahocorasick.Automaton()
        for seed, uses in seeds.items():
            self.automaton.add_word(seed, (len(seed), uses))
        self.automaton.make_automaton()

    def matches(self, k: int, text: str) -> Iterator:
        """The matches of notice k, from left to right. A match can lose its place only to one with fewer edits
        that overlaps it, and that one to the next: so many notices' lengths from its start decide on it."""
        notice, at = self.notices[k], 0
        reach = (notice.edits + 2) * (len(notice.text) + notice.edits)
        while m := self.leftmost[k].search(text, at):
            at, end = m.start(), min(m.start() + reach, len(text))
            while better := self.best[k].search(text, at, end):
                m, end = better, better.start()
            yield m
            at = m.end()

    def base(self, w: Words) -> dict[int, list[tuple[int, str]]]:
        """document -> (word, label) of each place of a base phrase."""
        h, found = w.hashes(), defaultdict(list)
        doc_end = np.repeat(w.first[1:], w.counts)
        for phrase, label in self.phrases:
            at = np.flatnonzero(h == phrase[0])
            at = at[at + len(phrase) <= doc_end[at]] if len(at) else at
            for j in range(1, len(phrase)):
                at = at[h[at + j] == phrase[j]]
            docs = np.searchsorted(w.first, at, side="right") - 1
            for d, i in zip(docs.tolist(), at.tolist()):
                found[d].append((i - int(w.first[d]), label))
        return found

    def fuzzy(self, w: Words) -> dict[int, list[tuple[str, int, int, int]]]:
        """document -> (label, first word, end word, edits) of each notice found."""
        found: dict[int, list[tuple[str, int, int, int]]] = defaultdict(list)
        if not len(w.starts):
            return found
        size = w.ends - w.starts + 1
        place = np.cumsum(size) - size  # of each word in the normalised text
        mask = np.zeros(len(w.buf) + 1, np.int8)
        mask[w.starts] += 1
        mask[w.ends] -= 1
        text = np.full(int(size.sum()), 0x20, np.uint8)
        inside = np.ones(len(text), bool)
        inside[place + size - 1] = False
        text[inside] = w.buf[np.cumsum(mask[:-1]).astype(bool)]
        last = w.first[1:][w.counts > 0] - 1
        text[place[last] + size[last] - 1] = 0x0A  # documents end in a line feed
        raw = text.tobytes()
        near: dict[int, list[int]] = defaultdict(list)
        for end, (n, uses) in self.automaton.iter(raw.decode("latin-1")):
            for k, lo in uses:
                near[k].append(end + 1 - n - lo)
        for k, starts in near.items():
            notice, margin = self.notices[k], 4 * self.notices[k].edits + 4
            for lo, hi in _windows(sorted(starts), margin, len(notice.text) + margin):
                docs_from = raw.rfind(b"\n", 0, max(lo, 0)) + 1 if lo > 0 else 0
                for part_lo, part in _lines(raw, max(lo, docs_from, 0), hi):
                    end, end_char = part_lo, 0
                    for m in self.matches(k, part.decode("utf-8", "ignore")):
                        begin = end + len(m.string[end_char:m.start()].encode())
                        end, end_char = begin + len(m.group().encode()), m.end()
                        first = int(np.searchsorted(place, begin, side="right")) - 1
                        stop = int(np.searchsorted(place, max(end - 1, begin), side="right"))
                        d = int(np.searchsorted(w.first, first, side="right")) - 1
                        found[d].append((notice.label, first - int(w.first[d]), stop - int(w.first[d]), sum(m.fuzzy_counts)))
        return found


def _windows(starts: list[int], before: int, after: int) -> Iterator[tuple[int, int]]:
    """Ranges around the candidate starts; overlapping ones are one."""
    lo = hi = None
    for s in starts:
        if hi is None or s - before > hi:
            if hi is not None:
                yield lo, hi
            lo = s - before
        hi = s + after
    if hi is not None:
        yield lo, hi


def _lines(raw: bytes, lo: int, hi: int) -> Iterator[tuple[int, bytes]]:
    """The parts of ``raw[lo:hi]`` between line feeds; cut characters at the ends are left out."""
    while lo < len(raw) and lo < hi and raw[lo] & 0xC0 == 0x80:
        lo += 1
    for part in raw[lo:hi].split(b"\n"):
        if part:
            yield lo, part
        lo += len(part) + 1


def scan_licenses(docs: DataFrame, *, phrases: dict[str, str] | None = None, notices: tuple[tuple[str, str], ...] = NOTICES,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_base, first_word, last_word, base_labels, labels, score
    (1 for a base phrase, else 1 - edits / length of the best notice, else 0) and the notices' spans."""
    phrases = BASE_PHRASES if phrases is None else phrases
    out = T.StructType([
        docs.schema[id_col], T.StructField("n_words", T.LongType()), T.StructField("n_base", T.LongType()),
        T.StructField("first_word", T.LongType()), T.StructField("last_word", T.LongType()), T.StructField("base_labels", T.StringType()),
        T.StructField("labels", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("spans", T.ArrayType(SPAN))])
    lengths: dict[str, int] = {}
    for text, label in notices:
        lengths[label] = min(len(text), lengths.get(label, len(text)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(phrases, notices)
        for batch in batches:
            for lo, hi, w in word_slices(batch.column(1), "alnum", True):
                base, fuzzy = scanner.base(w), scanner.fuzzy(w)
                n = hi - lo
                n_base, first, last = np.zeros(n, np.int64), [None] * n, [None] * n
                base_labels, labels, score, spans = [""] * n, [""] * n, [0.0] * n, [[] for _ in range(n)]
                for d in base.keys() | fuzzy.keys():
                    at, own = [i for i, _ in base[d]], {x for _, x in base[d]}
                    n_base[d] = len(at)
                    first[d], last[d] = (min(at), max(at)) if at else (None, None)
                    best = sorted(set(fuzzy[d]), key=lambda x: (x[1], x[2], x[0], x[3]))
                    base_labels[d] = ",".join(sorted(own))
                    labels[d] = ",".join(sorted(own | {x[0] for x in best}))
                    score[d] = 1.0 if at else max(1 - x[3] / lengths[x[0]] for x in best)
                    spans[d] = [dict(zip(SPAN.names, x)) for x in best]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, n), pa.array(w.counts.astype(np.int64)), pa.array(n_base), pa.array(first, pa.int64()),
                     pa.array(last, pa.int64()), pa.array(base_labels), pa.array(labels), pa.array(score, pa.float64()),
                     pa.array(spans, pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("end_word", pa.int64()),
                                                         ("edits", pa.int32())])))], names=out.names)

    return docs.select(id_col, text_col).mapInArrow(scan, out)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(documents(spark, sf_dir))


QUERIES = {"op3_license_scan": op3_license_scan}
ORACLES: dict[str, str] = {}
